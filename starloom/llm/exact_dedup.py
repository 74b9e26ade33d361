"""Exact duplicates by an extendible-hash index on shared files.

The 64-bit hash of a text is its key. The leading bits of a key lead through a directory to a
bucket. The directory starts with as many bits as even buckets of ``capacity`` keys take and is
doubled where a bucket is overfull, six times at most, which no even hash needs; beyond them a
bucket keeps all its keys. Owner tasks take ranges of (bucket, key), compare the texts of keys that
several rows have and chain those that differ. Every row finds its entry through the directory: its
slot names the bucket, bucket and key name the chain. Texts decide within chains of several.

Copies are combined before they are shuffled, so a text that fills a third of the table is a few
rows in the owner's task; a key that occurs once is an entry without a look at its text.

Null texts count as empty, and empty texts are equal to each other. A null doc_id is smaller than
any other. Rows that repeat doc_id and text are one document, counted as often as it occurs and
kept as often as it occurs. Rows of one doc_id with different texts are judged text by text. An
empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import query, stored, table, texts


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def depths(keys: int, capacity: int, max_depth: int | None = None) -> tuple[int, int]:
    """The bits of a directory at first, and after all doublings."""
    least = math.ceil(math.log2(keys / capacity)) if keys > capacity else 0
    most = least + 6 if max_depth is None else max_depth
    return min(least, most), most


def slot(most: int) -> Column:
    return F.shiftrightunsigned("key", 64 - most)


def directory(entries: DataFrame, capacity: int, max_depth: int, least: int = 0) -> DataFrame:
    """(slot, depth, bucket): the bucket of each combination of ``max_depth`` leading bits that
    occurs, so at most 2 ** max_depth rows. A bucket is named by its depth and its bits."""
    slots = entries.groupBy("slot").agg(F.count("*").alias("n"))
    paths = slots.select(
        "slot", "n", F.explode(F.sequence(F.lit(least), F.lit(max_depth))).alias("depth")
    ).withColumn("bits", F.expr(f"slot div cast(pow(2, {max_depth} - depth) as bigint)"))
    load = paths.groupBy("depth", "bits").agg(F.sum("n").alias("load"))
    return (
        paths.join(load, ["depth", "bits"])
        .groupBy("slot")
        .agg(F.min(F.when(F.col("load") <= capacity, F.col("depth"))).alias("depth"))
        .select("slot", F.coalesce("depth", F.lit(max_depth)).alias("depth"))
        .withColumn(
            "bucket",
            F.expr(
                f"slot div cast(pow(2, {max_depth} - depth) as bigint)"
                " + cast(pow(2, depth) as bigint)"
            ),
        )
    )


def keyed(docs: DataFrame, key: Callable[[Column], Column]) -> DataFrame:
    return texts(docs).select("doc_id", "text", key(F.col("text")).alias("key"))


def _built(
    docs: DataFrame, capacity: int, max_depth: int | None, key: Callable[[Column], Column]
) -> tuple[DataFrame, int, DataFrame]:
    """The stored directory, its bits and the stored entries."""
    rows = keyed(docs, key)
    keys = stored(
        rows.groupBy("key").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")),
        "dedup-keys",
    )
    least, most = depths(keys.count(), capacity, max_depth)
    slots = stored(
        directory(keys.select(slot(most).alias("slot")), capacity, most, least), "dedup-directory"
    )
    routed = stored(
        keys.withColumn("slot", slot(most)).join(slots, "slot").drop("slot"), "dedup-routed"
    )
    # Grouped by the text alone, which has one key: so copies are combined in the tasks of the join,
    # and the tasks of a hot key can be split.
    contents = (
        rows.join(routed.where("group_size > 1").select("bucket", "depth", "key"), "key")
        .groupBy("text")
        .agg(
            F.max("bucket").alias("bucket"),
            F.max("depth").alias("depth"),
            F.max("key").alias("key"),
            F.max("doc_id").alias("keep_id"),
            F.count("*").alias("group_size"),
        )
    )
    one_key = Window.partitionBy("bucket", "key")
    chains = (
        contents.repartitionByRange("bucket", "key")
        .withColumn("chain", F.dense_rank().over(one_key.orderBy("text")) - 1)
        .withColumn("links", F.count("*").over(one_key))
        .withColumn("text", F.when(F.col("links") > 1, F.col("text")))
    )
    single = routed.where("group_size = 1").select(
        "*",
        F.lit(0).alias("chain"),
        F.lit(1).cast("bigint").alias("links"),
        F.lit(None).cast("string").alias("text"),
    )
    return slots, most, stored(chains.unionByName(single), "dedup-index")


def build_index(
    docs: DataFrame,
    capacity: int = 4096,
    max_depth: int | None = None,
    key: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """The stored index, a row per content: bucket, depth, key, chain (place in its chain), links
    (length of the chain), keep_id, group_size, and the text in chains of several."""
    return _built(docs, capacity, max_depth, key)[2]


def exact_duplicates(
    docs: DataFrame,
    capacity: int = 4096,
    max_depth: int | None = None,
    key: Callable[[Column], Column] = F.xxhash64,
) -> DataFrame:
    """Per row of ``docs``: doc_id, keep_id, group_size, kept and text_sha256.

    ``key`` is only given to test what happens when keys collide.
    """
    slots, most, index = _built(docs, capacity, max_depth, key)
    located = (
        keyed(docs, key)
        .withColumn("text_sha256", sha256(F.col("text")))
        .withColumn("slot", slot(most))
        .join(slots.select("slot", "bucket"), "slot")
    )
    alone = index.where("links = 1").select("bucket", "key", "keep_id", "group_size")
    columns = ["doc_id", "keep_id", "group_size", "text_sha256"]
    found = located.join(alone, ["bucket", "key"]).select(columns)
    chained = index.where("links > 1").select("bucket", "key", "text", "keep_id", "group_size")
    if not chained.isEmpty():
        # Else no text is needed to find an entry, and none has to be shuffled.
        found = found.unionByName(located.join(chained, ["bucket", "key", "text"]).select(columns))
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    kept = (
        exact_duplicates(docs)
        .where("kept")
        .select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_text"))
        .distinct()
    )
    text = F.coalesce(docs["text"], F.lit(""))
    same = docs["doc_id"].eqNullSafe(kept["kept_id"]) & (sha256(text) == kept["kept_text"])
    return docs.join(kept, same, "left_semi")


@query(
    "op8_exact_dedup",
    """SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
)
def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(table(spark, folder, "documents"))
