"""Lookup joins of facts with dimensions.

Nothing is broadcast by order. Catalyst and AQE broadcast
a dimension whose measured size is within ``spark.sql.autoBroadcastJoinThreshold``; beyond
that the join is a sort-merge join, and AQE splits the partition of a hot fact key, which it
can because the facts are always the left side of an inner or left join.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.names import quoted

# The unit of a bucket and the bucket of a date or timestamp.
BUCKETS = {
    "day": "to_date({0})",
    "month": "trunc({0}, 'month')",
    "year": "trunc({0}, 'year')",
}


def _side(dimension: DataFrame, keys: list[str], take: Mapping[str, str]) -> DataFrame:
    """Only the keys and the columns to take, under names that cannot collide."""
    named = [f"{key} AS __key_{i}" for i, key in enumerate(keys)]
    return dimension.selectExpr(*named, *[f"{e} AS {quoted(n)}" for n, e in take.items()])


def lookup(
    facts: DataFrame,
    dimension: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    how: str = "left",
) -> DataFrame:
    """Add columns of ``dimension`` to ``facts`` by an equality join.

    ``on`` maps fact columns to dimension columns, ``take`` maps new column names to
    dimension columns; a dimension column may be any SQL expression. The same dimension can
    be looked up once per role (start station, end station) with other names. ``how`` is
    'left' to keep facts without a match and 'inner' to drop them.
    """
    side = _side(dimension, list(on.values()), take)
    equal = " AND ".join(f"{quoted('f', c)} = d.__key_{i}" for i, c in enumerate(on))
    joined = facts.alias("f").join(side.alias("d"), F.expr(equal), how)
    return joined.selectExpr("f.*", *[quoted("d", n) for n in take])


def lookup_day(
    facts: DataFrame, calendar: DataFrame, day: str, calendar_day: str, take: Mapping[str, str]
) -> DataFrame:
    """``lookup`` in a calendar, by day.

    Catalyst broadcasts it if it is small; a stored calendar has a size that it can tell.
    """
    return lookup(facts, calendar, {day: calendar_day}, take)


def lookup_in_range(
    facts: DataFrame,
    dimension: DataFrame,
    on: Mapping[str, str],
    at: str,
    start: str,
    end: str,
    take: Mapping[str, str],
    *,
    start_included: bool,
    how: str = "left",
    bucket: str | None = None,
) -> DataFrame:
    """Add columns of the dimension rows that are valid at ``at``; the end is included.

    ``start_included=False`` is the (start, end] rule of a type 2 dimension,
    ``start_included=True`` the closed range of a subscription. A fact that lies in several
    ranges comes out once per range.

    The key equality is what the join hashes on, the range is checked per candidate. That
    is right while a key has a handful of ranges. If one key may have very many, pass a
    ``bucket`` unit near the usual length of a range: every range is then listed once per
    day, month or year it touches, and a fact only meets the ranges of its own bucket. A
    fact has exactly one bucket, so the result is the same. Open ranges are listed up to
    their end too, so take a unit that is not too short for them.
    """
    taken = {**take, "__start": start, "__end": end}
    conditions = [f"{quoted('f', c)} = d.__key_{i}" for i, c in enumerate(on)]
    conditions += [f"f.__at {'>=' if start_included else '>'} d.__start", "f.__at <= d.__end"]
    if bucket is not None:
        of = BUCKETS[bucket].format
        listed = f"explode(sequence({of(start)}, {of(end)}, interval 1 {bucket})) AS __bucket"
        dimension = dimension.where(f"{start} <= {end}").selectExpr("*", listed)
        taken["__bucket"] = "__bucket"
        conditions.append(f"{of('f.__at')} = d.__bucket")
    side = _side(dimension, list(on.values()), taken)
    moments = facts.selectExpr("*", f"{at} AS __at")
    joined = moments.alias("f").join(side.alias("d"), F.expr(" AND ".join(conditions)), how)
    return joined.selectExpr(
        *[quoted("f", c) for c in facts.columns], *[quoted("d", n) for n in take]
    )


def detect_changes(
    source: DataFrame, open_versions: DataFrame, key: str, row_hash: str
) -> DataFrame:
    """Source rows that are new or whose hash is not that of the open version.

    Columns of the open version follow the source columns under the prefix ``dwh_`` and are
    null for a new row.
    """
    versions = open_versions.selectExpr(
        *[f"{quoted(c)} AS {quoted(f'dwh_{c}')}" for c in open_versions.columns]
    )
    old_key, old_hash = quoted("dwh", f"dwh_{key}"), quoted("dwh", f"dwh_{row_hash}")
    return (
        source.alias("s")
        .join(versions.alias("dwh"), F.expr(f"{quoted('s', key)} = {old_key}"), "left")
        .where(f"{old_key} IS NULL OR NOT ({old_hash} <=> {quoted('s', row_hash)})")
    )
