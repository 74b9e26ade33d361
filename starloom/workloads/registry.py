"""Collects queries and their SQL twins by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starloom.workloads.relations import Relations

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function from the relations to a result; ``sql`` must give the same rows."""

    def register(function: Callable[[Relations], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(Relations(spark, folder))

        run.__name__ = name
        run.__doc__ = function.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register
