"""Slowly changing dimensions, type 2.

A dimension has the surrogate key, all source columns, ``scd_start``, ``scd_end``, ``md5``
over the tracked columns and ``current``. Rows that vanish from the source stay open.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.hashing import row_hash_sql
from starloom.functions.names import quoted

# Validity of the first versions and of every open version.
FIRST_START = "1999-01-01 00:00:00"
OPEN_END = "2100-12-12 00:00:00"


def surrogate_sql(key: str, start: str) -> str:
    """A key that is the same on every run, unlike a random or a counted one."""
    return row_hash_sql(key, f"date_format({start}, 'yyyy-MM-dd HH:mm:ss.SSSSSS')")


def scd2_initial(
    source: DataFrame,
    key: str,
    tracked: Sequence[str],
    surrogate: str,
    start: str = FIRST_START,
    end: str = OPEN_END,
) -> DataFrame:
    """The first load: every source row becomes an open version."""
    begin = f"timestamp'{start}'"
    return source.selectExpr(
        f"{surrogate_sql(quoted(key), begin)} AS {quoted(surrogate)}",
        "*",
        f"{begin} AS scd_start",
        f"timestamp'{end}' AS scd_end",
        f"{row_hash_sql(*map(quoted, tracked))} AS md5",
        "true AS current",
    )


def unique_by(df: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` that have a key; its job fails if two rows share one.

    Copies are counted over the partitioning by the key, which a following join on it reuses.
    """
    name = quoted(key)
    several = f"raise_error(concat('{key} occurs twice: ', cast({name} AS string)))"
    return (
        df.where(f"{name} IS NOT NULL")
        .selectExpr("*", f"count(1) OVER (PARTITION BY {name}) AS __copies")
        .where(f"CASE WHEN __copies > 1 THEN cast({several} AS boolean) ELSE true END")
        .select(*df.columns)
    )


def scd2_apply(
    dimension: DataFrame,
    source: DataFrame,
    key: str,
    tracked: Sequence[str],
    surrogate: str,
    run_at: str,
    end: str = OPEN_END,
) -> DataFrame:
    """The dimension after a load: changed versions closed at ``run_at``, new ones opened.

    Only open versions with a key take part in the join, and both they and the source have
    one row per key: neither a key with a very long history nor many rows without a key are
    a hot spot. One full outer join decides everything; a matched pair gives the version as
    it was, or the closed and the new version. A source row without a key is always new. The
    job fails if the source or the open versions have a key twice, or if a version that is to be closed
    starts after ``run_at``.
    """
    moment = f"timestamp'{run_at}'"
    columns = [(f.name, f.dataType.simpleString()) for f in dimension.schema.fields]

    def version(values: dict[str, str], side: str) -> str:
        fields = [
            f"'{c}', cast({values.get(c, quoted(side, c))} AS {kind})" for c, kind in columns
        ]
        return f"named_struct({', '.join(fields)})"

    opened = version(
        {
            surrogate: surrogate_sql(quoted("new", key), moment),
            "scd_start": moment,
            "scd_end": f"timestamp'{end}'",
            "md5": "new.__md5",
            "current": "true",
        },
        "new",
    )
    same = version({}, "old")
    late = f"concat('a version starts after the run: ', cast({quoted('old', key)} AS string))"
    ends = f"if(old.scd_start > {moment}, cast(raise_error({late}) AS timestamp), {moment})"
    closed = version({"scd_end": ends, "current": "false"}, "old")
    versions = (
        f"CASE WHEN old.__old IS NULL THEN array({opened})"
        f" WHEN new.__new IS NULL OR old.md5 <=> new.__md5 THEN array({same})"
        f" ELSE array({closed}, {opened}) END"
    )
    new_columns = (
        "*",
        f"{row_hash_sql(*map(quoted, tracked))} AS __md5",
        "true AS __new",
    )
    joins = f"current AND {quoted(key)} IS NOT NULL"
    old = unique_by(dimension.where(joins), key).selectExpr("*", "true AS __old").alias("old")
    new = unique_by(source, key).selectExpr(*new_columns).alias("new")
    live = old.join(
        new, F.expr(f"{quoted('old', key)} = {quoted('new', key)}"), "full"
    ).selectExpr(f"inline({versions})")
    keyless = (
        source.where(f"{quoted(key)} IS NULL")
        .selectExpr(*new_columns)
        .alias("new")
        .selectExpr(f"inline(array({opened}))")
    )
    return dimension.where(f"NOT ({joins})").unionByName(live).unionByName(keyless)
