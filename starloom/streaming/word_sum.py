"""Sums per word and ten-second window over a stream of events.

An event is a message with a JSON value {"event_time": ..., "word": ..., "count": ...}.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from starloom.operators.stored_merge import merge_into
from starloom.sinks.files import write_parquet
from starloom.sources.files import scan_parquet
from starloom.workspace import new_folder

# Messages, events, and the lengths of a window and of the watermark.
MESSAGE_SCHEMA = "key string, value string"
EVENT_FIELDS = ("event_time", "word", "count")
WINDOW = "10 seconds"
WATERMARK = "10 seconds"


def kafka_messages(
    spark: SparkSession, servers: str, topic: str, starting_offsets: str | None = None
) -> DataFrame:
    """Messages of a topic (needs the Kafka connector on the session's class path)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
    )
    if starting_offsets is not None:
        reader = reader.option("startingOffsets", starting_offsets)
    return reader.load()


def file_messages(
    spark: SparkSession,
    path: str,
    schema: StructType | str = MESSAGE_SCHEMA,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Messages from Parquet files as they appear."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def json_fields(messages: DataFrame, fields: tuple[str, str, str] = EVENT_FIELDS) -> DataFrame:
    """The JSON fields of the value as text columns c0, c1, c2."""
    return messages.select(F.json_tuple(F.col("value").cast("string"), *fields))


def typed_events(messages: DataFrame, fields: tuple[str, str, str] = EVENT_FIELDS) -> DataFrame:
    """(eventtime, key, value) from the JSON fields named; what cannot be read as its type is null."""
    schema = StructType([StructField(name, StringType()) for name in fields])
    event = F.from_json(F.col("value").cast("string"), schema)
    at, key, value = (F.col("event").getField(name) for name in fields)
    return messages.select(event.alias("event")).select(
        at.try_cast("timestamp").alias("eventtime"),
        key.alias("key"),
        value.try_cast("int").alias("value"),
    )


def window_sums(
    events: DataFrame, window: str = WINDOW, watermark: str = WATERMARK
) -> DataFrame:
    """Sum of ``value`` per tumbling window and key, in the column ``count``.

    State is partial sums, so a hot key adds one row per task and window to the shuffle.
    """
    return (
        events.withWatermark("eventtime", watermark)
        .groupBy(F.window("eventtime", window), "key")
        .agg(F.sum("value").alias("count"))
    )


def append_to_files(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    file_format: str = "parquet",
) -> StreamingQuery:
    """Append finished rows to a folder of a format, or a table format whose jar the session has.

    Windows stay in the state store until the watermark has passed them; for many keys the session
    should set the RocksDB state store, which keeps them off the heap.

    With ``available_now`` the query takes what is there and ends, otherwise it runs until
    it is stopped.
    """
    writer = (
        stream.writeStream.format(file_format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def write_updates(
    stream: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Write the changed rows of every micro-batch to a folder of its own.

    A batch that is repeated after a failure replaces its folder, so nothing counts twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


#: Columns of stored sums; ``batch`` is the micro-batch that a sum was last changed in.
SUMS_SCHEMA = "window_start timestamp, key string, count bigint, batch bigint, day date"


def upsert_sums(
    sums: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Keep the latest sum of every window of ``window_sums`` in a table stored by day at ``path``.

    In update mode a micro-batch holds the windows it changed, with their whole sums. They replace
    those in the table, or are added; only days with changed windows are written. A sum
    is replaced by one of a later micro-batch only: a micro-batch that is repeated after a failure, even
    one that had replaced some days already, changes nothing twice.
    """
    spark = sums.sparkSession
    schema = StructType.fromDDL(SUMS_SCHEMA)
    spark.createDataFrame([], schema).write.mode("ignore").partitionBy("day").parquet(path)

    def write(batch: DataFrame, number: int) -> None:
        changed = batch.selectExpr(
            "window.start AS window_start", "key", "count", f"{number}L AS batch",
            "to_date(window.start) AS day",
        )
        folder = new_folder(batch.sparkSession, "changed-sums")
        write_parquet(changed, folder)  # state is read once, however often the merge reads this
        merge_into(
            path,
            schema,
            scan_parquet(batch.sparkSession, folder, changed.schema),
            ["window_start", "key", "day"],
            ["day"],
            when="source.batch > target.batch",
        )

    writer = (
        sums.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
