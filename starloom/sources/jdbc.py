"""Relational databases.

A connection is a dict of JDBC options from the caller (url, driver, user, password, ...);
nothing about a database is kept in the library.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, DataFrameReader, SparkSession


@dataclass(frozen=True)
class Split:
    """Parallel read of a table in ``parts`` ranges of a numeric, date or timestamp column.

    The bounds only set the stride, rows outside still load, but in the first or last
    range. Bounds far from the real ones therefore put most of a table into one task:
    leave them out to have the database tell the real ones.
    """

    column: str
    lower: str | int | None = None
    upper: str | int | None = None
    parts: int = 4


def jdbc_reader(spark: SparkSession, connection: Mapping[str, str]) -> DataFrameReader:
    return spark.read.format("jdbc").options(**connection)


def _bound(value: object, whole: Callable[[object], int]) -> str:
    """A bound as the reader takes it: it reads numbers as whole ones only."""
    return str(whole(value) if isinstance(value, (Decimal, float)) else value)


def split_options(split: Split, lower: object, upper: object) -> dict[str, str]:
    """The reader options of a parallel read."""
    return {
        "partitionColumn": split.column,
        "lowerBound": _bound(lower, math.floor),
        "upperBound": _bound(upper, math.ceil),
        "numPartitions": str(split.parts),
    }


def read_table(
    spark: SparkSession, name: str, connection: Mapping[str, str], split: Split | None = None
) -> DataFrame:
    """A table, or a derived table given as ``(select ...) as alias``.

    Filters and column selections on the result reach the database. Without ``split`` one
    task reads everything, which suits small dimension tables only.
    """
    reader = jdbc_reader(spark, connection).option("dbtable", name)
    if split is None:
        return reader.load()
    lower, upper = split.lower, split.upper
    if lower is None or upper is None:
        lower, upper = read_query(spark, bounds_query(name, split.column), connection).first()
        if lower is None:
            return reader.load()
    return reader.options(**split_options(split, lower, upper)).load()


def read_parts(
    spark: SparkSession, name: str, connection: Mapping[str, str], parts: Sequence[str]
) -> DataFrame:
    """A table read by one task per condition of ``parts``, which must not overlap and together
    hold for every row. For keys that lie dense in places, where equal ranges would not do."""
    return spark.read.jdbc(connection["url"], name, predicates=list(parts), properties={
        key: value for key, value in connection.items() if key != "url"
    })


def bounds_query(name: str, column: str) -> str:
    return f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {name}"


def read_query(spark: SparkSession, query: str, connection: Mapping[str, str]) -> DataFrame:
    """The result of a query that the database runs (one task: the result should be small)."""
    return jdbc_reader(spark, connection).option("query", query).load()
