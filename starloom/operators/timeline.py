"""Versions and facts as one stream per key, in the order of time.

Both operators look at a row's neighbours in its key's timeline, so their work grows with the rows
of both sides together, however many versions a key has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.hashing import row_hash_sql
from starloom.functions.names import quoted
from starloom.operators.joins import BUCKETS
from starloom.operators.scd2 import OPEN_END, surrogate_sql

_BEFORE = (Window.unboundedPreceding, -1)
_SO_FAR = (Window.unboundedPreceding, Window.currentRow)


def lookup_as_of(
    facts: DataFrame,
    versions: DataFrame,
    on: Mapping[str, str],
    at: str,
    start: str,
    end: str,
    take: Mapping[str, str],
    *,
    start_included: bool,
    how: str = "left",
    slices: str = "day",
) -> DataFrame:
    """Add columns of the one version that is valid at ``at``; the end is included.

    Same arguments and, where a key's versions do not overlap, same rows as ``lookup_in_range``; the
    job fails if two versions of a key overlap. Facts and versions are put in one stream per key,
    sorted by time, and the last version seen is carried forward to the facts, so no fact meets
    more than one version.

    A key's time is cut into slices (day, month or year), each a stream by itself, so a key
    with very many facts is spread over its slices. What is valid when a slice begins is found
    first, from the versions and the slices in which a key has facts at all; that is little
    beside the facts. Facts without a key or a moment have no version and are spread evenly.

    The facts are shuffled by key and slice and sorted. A dimension that is small enough to be
    broadcast and has few versions per key costs less with ``lookup_in_range``.
    """
    keys = [f"__key_{i}" for i in range(len(on))]
    named = [F.col(k) for k in keys]

    def slice_of(moment: str) -> str:
        return f"cast(unix_date({BUCKETS[slices].format(moment)}) AS bigint)"

    known = " AND ".join(f"{k} IS NOT NULL" for k in [*keys, "__moment"])
    # Below all days there are.
    nowhere = f"-1000000000000L - pmod(xxhash64(__moment, {', '.join(keys)}), 4096)"
    seen = facts.selectExpr(
        *[f"{quoted(c)} AS {k}" for k, c in zip(keys, on)],
        f"{at} AS __moment",
        "struct(*) AS __fact",
    ).selectExpr(
        "*",
        f"if({known}, {slice_of('__moment')}, {nowhere}) AS __slice",
        f"{1 if start_included else 0} AS __kind",
    )
    holds = "__start <= __end" if start_included else "__start < __end"
    starts = (
        versions.selectExpr(
            *[f"{e} AS {k}" for k, e in zip(keys, on.values())],
            f"{start} AS __start",
            f"{end} AS __end",
            f"struct({', '.join(f'{e} AS {quoted(n)}' for n, e in take.items())}) AS __taken",
        )
        .where(f"{holds} AND {' AND '.join(f'{k} IS NOT NULL' for k in keys)}")
        .selectExpr(
            *keys,
            "__start AS __moment",
            f"{slice_of('__start')} AS __slice",
            f"{0 if start_included else 1} AS __kind",
            "struct(__start, __end, __taken) AS __version",
        )
    )

    # What is valid when a slice begins: the last version that starts in an earlier one.
    begun = seen.where("__slice > -1000000000000L").select(*keys, "__slice").distinct()
    marks = starts.selectExpr(*keys, "__slice", "__version", "1 AS __mark").unionByName(
        begun.selectExpr(*keys, "__slice", "0 AS __mark"), allowMissingColumns=True
    )
    in_time = Window.partitionBy(*named).orderBy(
        "__slice", "__mark", "__version.__start", "__version.__end"
    )
    meets = ">=" if start_included else ">"
    overlap = "cast(raise_error('two versions of one key overlap') AS boolean)"
    carried = (
        marks.withColumn(
            "__before", F.last("__version", True).over(in_time.rowsBetween(*_BEFORE))
        )
        .where(
            f"CASE WHEN __mark = 0 THEN __before IS NOT NULL"
            f" WHEN __before.__end {meets} __version.__start THEN {overlap} ELSE false END"
        )
        .selectExpr(*keys, "__slice", f"{0 if start_included else 1} AS __kind",
                    "__before AS __version")
    )

    stream = seen.unionByName(starts, allowMissingColumns=True).unionByName(
        carried, allowMissingColumns=True
    )
    in_slice = Window.partitionBy(*named, F.col("__slice")).orderBy(
        F.asc_nulls_first("__moment"), "__kind", "__version.__end"
    )
    found = stream.withColumn(
        "__found", F.last("__version", True).over(in_slice.rowsBetween(*_SO_FAR))
    ).where("__fact IS NOT NULL")
    valid = "coalesce(__moment <= __found.__end, false)"
    if how == "inner":
        found = found.where(valid)
    return found.selectExpr(
        "__fact.*",
        *[f"if({valid}, {quoted('__found', '__taken', n)}, NULL) AS {quoted(n)}" for n in take],
    )


def rebuild_versions(
    dimension: DataFrame,
    changes: DataFrame,
    key: str,
    tracked: Sequence[str],
    surrogate: str,
    changed_at: str,
    sequence: str | None = None,
    end: str = OPEN_END,
) -> DataFrame:
    """The type 2 dimension after a load with any number of changes per key, late ones too.

    ``changes`` has the dimension's source columns and ``changed_at``; columns it lacks are null.
    A key's versions and changes form one timeline. A change holds from its moment to the next
    entry, so one that is dated before the open version, or before all, is put between those
    that are there. At one moment a change replaces a version, and of several changes the one with
    the largest ``sequence`` counts (then the largest row hash). An entry equal to the one before it is
    no version. Each version ends where the next one starts, the last one is open.

    Keys without changes keep their rows as they are. Changes without a moment or a key fail the job.
    A key's timeline is one sorted stream; all but one change of a key at one moment go before it is
    shuffled.
    """
    types = {f.name: f.dataType.simpleString() for f in dimension.schema.fields}
    hashed = row_hash_sql(*map(quoted, tracked))
    name = quoted(key)
    missing = "raise_error('a change has no key or no moment')"
    placed = f"if({name} IS NULL OR {changed_at} IS NULL, {missing}, {{0}})"
    source = [c for c in changes.columns if c in types]
    entries = (
        changes.selectExpr(
            f"cast({placed.format(name)} AS {types[key]}) AS __key",
            f"cast({changed_at} AS {types['scd_start']}) AS __start",
            f"struct({sequence or 'NULL'} AS a, {hashed} AS b) AS __order",
            f"struct({', '.join(map(quoted, source))}) AS __row",
        )
        .groupBy("__key", "__start")
        .agg(F.max_by("__row", "__order").alias("__row"))
    )
    made = {
        surrogate: surrogate_sql(name, "scd_start"),
        "scd_end": f"timestamp'{end}'",
        "md5": hashed,
        "current": "true",
    }
    added = entries.selectExpr("__row.*", "__start AS scd_start").selectExpr(
        *[
            f"cast({made.get(c) or (quoted(c) if c in (*source, 'scd_start') else 'NULL')}"
            f" AS {kind}) AS {quoted(c)}"
            for c, kind in types.items()
        ],
        "true AS __change",
    )
    keyed = dimension.where(f"{name} IS NOT NULL").selectExpr("*", "false AS __change")
    timeline = keyed.unionByName(added)

    whole = Window.partitionBy(key)
    one_moment = Window.partitionBy(key, "scd_start").orderBy(F.desc("__change"))
    in_time = Window.partitionBy(key).orderBy("scd_start")
    told = (
        timeline.withColumn("__changed", F.max("__change").over(whole))
        .withColumn("__first", F.row_number().over(one_moment))
        .where("NOT __changed OR __first = 1")
        .withColumn("__before", F.lag(F.struct("md5")).over(in_time))
        .where("NOT __changed OR __before IS NULL OR NOT (__before.md5 <=> md5)")
        .withColumn("__next", F.lead("scd_start").over(in_time))
    )
    rebuilt = {
        "scd_end": f"coalesce(__next, timestamp'{end}')",
        "current": "__next IS NULL",
    }
    columns = [
        f"cast(if(__changed, {rebuilt[c]}, {quoted(c)}) AS {kind}) AS {quoted(c)}"
        if c in rebuilt
        else quoted(c)
        for c, kind in types.items()
    ]
    return told.selectExpr(*columns).unionByName(dimension.where(f"{name} IS NULL"))
