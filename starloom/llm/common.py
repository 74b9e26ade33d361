"""What the operators of this package share."""

from __future__ import annotations

import functools
import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.workspace import new_folder

#: Bytes of the rows that Python gets at once while ``stored`` writes. At Spark's own 64 MB, each task would
#: hold several such batches in the JVM and in its worker.
BATCH_BYTES = 3 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the session and the folder of the tables under ``name``."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        @functools.wraps(function)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            on_workers(spark)
            return function(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def on_workers(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, for sessions that run
    elsewhere; a cluster gets it by --py-files or has it installed."""
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *known]))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text with '' for null, and the columns named; all others are left out at once, so
    none of them can clash with a column of an operator."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *more)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Batches of ``BATCH_BYTES`` for what runs inside, unless the session has its own limit."""
    if spark.conf.get(_BATCH_SETTING, None) is not None:
        yield
        return
    spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(_BATCH_SETTING)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, and safe from lost
    executors."""
    spark = df.sparkSession
    folder = new_folder(spark, purpose)
    with small_batches(spark):
        df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def by_batch(
    function: Callable[[pa.RecordBatch], pa.RecordBatch | dict],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``: one batch or dict of columns per batch, without state between them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = function(batch)
            yield made if isinstance(made, pa.RecordBatch) else pa.RecordBatch.from_pydict(made)

    return run
