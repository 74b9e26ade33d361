"""Update, delete and merge as functions from the old table to the new one.

Conditions and values are SQL text, as in the statements they stand for. Each function can
mark what happened to a row in the column ``ACTION``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.names import quoted

ACTION = "__action"
KEPT, UPDATED, INSERTED, DELETED = "kept", "updated", "inserted", "deleted"


def _holds(condition: str) -> str:
    """A condition that is null does not hold."""
    return f"coalesce({condition}, false)"


def _finish(df: DataFrame, marked: bool) -> DataFrame:
    return df if marked else df.drop(ACTION)


def _types(df: DataFrame) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema.fields}


def update_where(
    df: DataFrame, condition: str, assignments: Mapping[str, str], marked: bool = False
) -> DataFrame:
    """Rows that meet the condition get the assigned values, which may use old values."""
    hit = _holds(condition)
    columns = [
        f"cast(if({hit}, {assignments[c]}, {quoted(c)}) AS {kind}) AS {quoted(c)}"
        if c in assignments
        else quoted(c)
        for c, kind in _types(df).items()
    ]
    action = f"if({hit}, '{UPDATED}', '{KEPT}') AS {ACTION}"
    return _finish(df.selectExpr(*columns, action), marked)


def delete_where(df: DataFrame, condition: str, marked: bool = False) -> DataFrame:
    """Rows that meet the condition go; with ``marked`` they stay and are only marked."""
    hit = _holds(condition)
    if marked:
        return df.selectExpr("*", f"if({hit}, '{DELETED}', '{KEPT}') AS {ACTION}")
    return df.where(f"NOT {hit}")


def rows_not_in(rows: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key ``existing`` lacks; a key with a null is never found.

    The keys of ``existing`` are made distinct first, so copies of one key collapse ahead
    of the shuffle, and nothing but keys is shuffled.
    """
    known = existing.select(*keys).dropna().distinct()
    return rows.join(known, list(keys), "left_anti").select(*rows.columns)


def merge(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    *,
    update: Mapping[str, str] | str = "all",
    when: str = "true",
    target_matches: str = "true",
    source_matches: str = "true",
    insert: bool = True,
    marked: bool = False,
) -> DataFrame:
    """Merge ``source`` into ``target`` on equal ``on`` columns.

    * ``update``: new values of a matched row, or 'all' for all source columns. Values and
      ``when`` name the sides ``target.x`` and ``source.x``.
    * ``when``: further condition of the update; a matched row without it stays as it is.
    * ``target_matches`` / ``source_matches``: conditions over the bare columns of one side
      that a row needs to match at all.
    * ``insert``: add the source rows that matched nothing. Null keys match nothing.

    The job fails if two source rows match one target row.

    Each side is used twice: the target for the update and, as distinct keys, for the insert,
    the source likewise. The update is a left join with the target on the left, so AQE can
    split a hot target key; copies of a source key are counted over the partitioning that the join
    needs anyway. Rows without a key or barred by a condition stay in the joins, whose
    conditions they fail.
    """
    keys = list(on)
    types = _types(target)

    of_target = target.selectExpr("*", f"{_holds(target_matches)} AS __may_match")
    of_source = source.selectExpr("*", f"{_holds(source_matches)} AS __can_match")
    same_key = ", ".join([*map(quoted, keys), "__can_match"])
    counted = of_source.selectExpr("*", f"count(1) OVER (PARTITION BY {same_key}) AS __copies")
    equal = " AND ".join(f"{quoted('target', k)} = {quoted('source', k)}" for k in keys)
    both = f"{equal} AND target.__may_match AND source.__can_match"
    several = "cast(raise_error('two source rows match one target row') AS boolean)"
    joined = (
        of_target.alias("target")
        .join(counted.where("__can_match").alias("source"), F.expr(both), "left")
        .where(f"CASE WHEN source.__copies > 1 THEN {several} ELSE true END")
    )
    hit = f"source.__copies IS NOT NULL AND {_holds(when)}"
    assigned = (
        {c: quoted("source", c) for c in source.columns} if update == "all" else dict(update)
    )
    result = joined.selectExpr(
        *[
            f"cast(if({hit}, {assigned[c]}, {quoted('target', c)}) AS {kind}) AS {quoted(c)}"
            if c in assigned
            else quoted("target", c)
            for c, kind in types.items()
        ],
        f"if({hit}, '{UPDATED}', '{KEPT}') AS {ACTION}",
    )
    if insert:
        known = of_target.where("__may_match").select(*keys).dropna().distinct()
        fresh = of_source.alias("source").join(
            known.alias("target"), F.expr(f"{equal} AND source.__can_match"), "left_anti"
        )
        result = result.unionByName(
            fresh.selectExpr(
                *[
                    f"cast({quoted(c) if c in source.columns else 'NULL'} AS {kind})"
                    f" AS {quoted(c)}"
                    for c, kind in types.items()
                ],
                f"'{INSERTED}' AS {ACTION}",
            )
        )
    return _finish(result, marked)
