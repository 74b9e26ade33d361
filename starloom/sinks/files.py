"""Text, JSON and Parquet folders and catalog tables."""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_text(df: DataFrame, path: str, separator: str = "\t") -> None:
    """One line per row, fields joined by ``separator``, one file per partition."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    df.select(F.concat_ws(separator, *fields).alias("value")).write.mode("overwrite").option(
        "lineSep", "\n"
    ).text(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per line; ``path`` becomes a folder."""
    df.write.mode("overwrite").json(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def rebalanced(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of one value of ``by`` together, so that a partitioned write makes few files per folder;
    AQE splits a value with far more rows than others over several tasks."""
    return df.hint("rebalance", *by)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Parquet with a folder per value of ``by``, in place of what is at ``path``."""
    rebalanced(df, by).write.mode("overwrite").partitionBy(*by).parquet(path)


def write_table(
    df: DataFrame,
    name: str,
    path: str | None = None,
    file_format: str = "parquet",
    buckets: int | None = None,
    bucket_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
) -> None:
    """A catalog table, replaced if it exists; with ``path`` the data lives there.

    ``file_format`` may name any table format whose jar the session has. With ``buckets`` rows are
    stored by the hash of ``bucket_by``, sorted by it: two tables with the same buckets are joined and
    grouped by these columns without a shuffle of either. Rows are dealt to the buckets before
    they are written, so each bucket is one file (per partition). A bucket holds all rows of its keys, so do
    not bucket by a column of which one value has a large share of the rows.
    """
    if buckets is not None:
        df = df.repartition(buckets, *bucket_by)
    writer = df.write.format(file_format).mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets is not None:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def stored_in(
    base: str, compact: Collection[str] = ()
) -> Callable[[str, DataFrame], DataFrame]:
    """A store for named tables: writes them as Parquet below ``base`` and reads them back.

    Those named in ``compact`` are written with Zstandard, which takes less room. The others keep
    the default codec: a dimension's stored size decides whether it is broadcast, and it must not
    look much smaller than it is in memory.
    """

    def store(name: str, df: DataFrame) -> DataFrame:
        folder = f"{base.rstrip('/')}/{name}"
        if name in compact:
            df.write.mode("overwrite").option("compression", "zstd").parquet(folder)
        else:
            write_parquet(df, folder)
        return df.sparkSession.read.schema(df.schema).parquet(folder)

    return store


def export_tables(
    names: Iterable[str], read: Callable[[str], DataFrame], base: str
) -> dict[str, str]:
    """Copy every named table to a Parquet folder of the same name below ``base``."""
    folders = {name: f"{base.rstrip('/')}/{name}" for name in names}
    for name, folder in folders.items():
        write_parquet(read(name), folder)
    return folders
