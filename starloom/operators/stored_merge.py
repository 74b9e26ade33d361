"""Merges into tables that are stored by partition: only partitions with changes are written."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starloom.functions.names import quoted
from starloom.operators.merge import ACTION, KEPT, merge
from starloom.sinks.files import rebalanced
from starloom.workspace import new_folder


def _is_one_of(partitions: list, by: Sequence[str]):
    """Rows of those partitions, as a condition that prunes the folders to read."""
    if len(by) == 1:
        values = [row[0] for row in partitions]
        some = F.col(by[0]).isin([v for v in values if v is not None])
        return some | F.col(by[0]).isNull() if None in values else some
    each = (
        reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(by, row)))
        for row in partitions
    )
    return reduce(lambda a, b: a | b, each, F.lit(False))


def merge_into(
    path: str,
    schema: StructType,
    source: DataFrame,
    on: Sequence[str],
    by: Sequence[str],
    **how,
) -> int:
    """``merge`` of ``source`` into the Parquet table of ``schema`` that is stored at ``path`` by the
    columns ``by``; returns the number of partitions written.

    ``by`` must be among the ``on`` columns, so that a row only meets rows of its own partition
    (add the day to the key of an event, for example); ``how`` are the settings of ``merge``.

    Partitions that the source has no rows for are not read. Of the others, keys and what decides the
    merge are read to find out where a row is updated or inserted, and those partitions alone are
    merged and replaced; files of all others stay as they are. The new content is written to the shared
    folder first, so a job that fails before the replacement leaves the table as it was, and one that
    fails within it can be repeated: merging the same source again gives the same table. The
    driver sees the names of partitions, as it does whenever it reads such a table.
    """
    if not set(by) <= set(on):
        raise ValueError(f"the partition columns {list(by)} must be among the keys {list(on)}")
    spark = source.sparkSession
    named = sorted(by)
    source = source.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in by else F.col(quoted(f.name))
          for f in schema.fields if f.name in source.columns],
        *[c for c in source.columns if c not in schema.names],
    )
    offered = source.select(*named).distinct().collect()
    if not offered:
        return 0
    target = spark.read.schema(schema).parquet(path).where(_is_one_of(offered, named))
    marked = merge(target, source, on, marked=True, **how)
    changed = marked.where(F.col(ACTION) != KEPT).select(*named).distinct().collect()
    if not changed:
        return 0
    touched = _is_one_of(changed, named)
    merged = merge(target.where(touched), source.where(touched), on, **how)
    staged = new_folder(spark, "merge")
    merged.write.parquet(staged)
    (
        rebalanced(spark.read.schema(merged.schema).parquet(staged), by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )
    return len(changed)
