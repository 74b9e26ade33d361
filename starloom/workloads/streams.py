"""The events as a stream of messages, taken from files until nothing is left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.sources.files import scan_parquet
from starloom.streaming.replay import arrive, replay, stop_after
from starloom.streaming.word_sum import (
    SUMS_SCHEMA,
    append_to_files,
    file_messages,
    json_fields,
    typed_events,
    upsert_sums,
    window_sums,
    write_updates,
)
from starloom.workloads.registry import query
from starloom.workloads.relations import SCHEMAS, Relations
from starloom.workspace import new_folder


def _messages(r: Relations) -> DataFrame:
    """The events table read as a stream; every row becomes a message with a JSON value.

    The pattern finds the table whether it is one file or a folder of files, which a plain
    path of a file stream does not.
    """
    return _as_messages(
        file_messages(r.spark, f"{r.folder}/events.parquet*", SCHEMAS["events"], 1)
    )


def _as_messages(events: DataFrame) -> DataFrame:
    value = F.to_json(
        F.struct(
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("event_time"),
            F.col("event_type").alias("word"),
            F.floor("value").cast("int").alias("count"),
        )
    )
    return events.select(
        F.col("event_type").alias("key"), value.cast("binary").alias("value")
    )


@query(
    "stream_word_sum",
    """SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, key, count FROM (
  SELECT time_bucket(INTERVAL 10 SECOND, ts) AS w, event_type AS key,
         CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS count
  FROM events GROUP BY 1, 2)
WHERE w + INTERVAL 10 SECOND <= (SELECT max(ts) - INTERVAL 10 SECOND FROM events)""",
)
def stream_word_sum(r: Relations) -> DataFrame:
    """Sums of the windows that the watermark has closed."""
    folder = new_folder(r.spark, "word-sums")
    sums = window_sums(typed_events(_messages(r))).select(
        F.col("window.start").alias("window_start"), "key", "count"
    )
    append_to_files(sums, folder, new_folder(r.spark, "checkpoint"), True).awaitTermination()
    return scan_parquet(r.spark, folder, sums.schema).withColumn(
        "window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")
    )


@query(
    "stream_updates",
    """SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS eventtime, event_type AS key,
       CAST(floor(value) AS INTEGER) AS value FROM events""",
)
def stream_updates(r: Relations) -> DataFrame:
    """The typed events themselves in update mode."""
    folder = new_folder(r.spark, "updates")
    events = typed_events(_messages(r))
    write_updates(events, folder, new_folder(r.spark, "checkpoint"), True).awaitTermination()
    return scan_parquet(r.spark, folder).select(
        F.date_format("eventtime", "yyyy-MM-dd HH:mm:ss").alias("eventtime"), "key", "value"
    )


@query(
    "stream_json_fields",
    """SELECT strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS c0, event_type AS c1,
       CAST(CAST(floor(value) AS INTEGER) AS VARCHAR) AS c2 FROM events""",
)
def stream_json_fields(r: Relations) -> DataFrame:
    """The JSON fields of the messages as text."""
    folder = new_folder(r.spark, "json-fields")
    fields = json_fields(_messages(r))
    append_to_files(fields, folder, new_folder(r.spark, "checkpoint"), True).awaitTermination()
    return scan_parquet(r.spark, folder, fields.schema)


#: Errors are reported five days late. Three deliveries, by the day of arrival.
_ARRIVAL = "if(event_type = 'error', ts + interval 5 days, ts)"
_DELIVERIES = ("2024-01-11", "2024-01-21")


def _delivery(arrival: str) -> str:
    first, second = _DELIVERIES
    return (
        f"CASE WHEN {arrival} < timestamp '{first} 00:00:00' THEN 0"
        f" WHEN {arrival} < timestamp '{second} 00:00:00' THEN 1 ELSE 2 END"
    )


def _deliveries(r: Relations, arrival: str) -> list[DataFrame]:
    """The events as messages, one frame per delivery."""
    dealt = r.table("events").withColumn("delivery", F.expr(_delivery(arrival)))
    return [_as_messages(dealt.where(f"delivery = {n}")) for n in range(len(_DELIVERIES) + 1)]


_SUMS_OF_KEPT = """SELECT time_bucket(INTERVAL 10 SECOND, ts) AS w, event_type AS key,
         CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS count FROM kept GROUP BY 1, 2"""


@query(
    "stream_late_rows",
    f"""WITH dealt AS (SELECT *, {_delivery(
        "CASE WHEN event_type = 'error' THEN ts + INTERVAL 5 DAY ELSE ts END")} AS delivery FROM events),
marks AS (SELECT delivery, max(max(ts)) OVER (ORDER BY delivery ROWS BETWEEN UNBOUNDED PRECEDING
  AND 1 PRECEDING) - INTERVAL 10 SECOND AS mark FROM dealt GROUP BY delivery),
kept AS (SELECT d.* FROM dealt d JOIN marks m USING (delivery) WHERE mark IS NULL
  OR time_bucket(INTERVAL 10 SECOND, ts) + INTERVAL 10 SECOND > mark)
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, key, count FROM ({_SUMS_OF_KEPT})
WHERE w + INTERVAL 10 SECOND <= (SELECT max(ts) - INTERVAL 10 SECOND FROM events)""",
)
def stream_late_rows(r: Relations) -> DataFrame:
    """Three deliveries, of which errors come late: rows behind the watermark do not count."""
    arrivals, out, checkpoint = (new_folder(r.spark, f"late-{n}") for n in ("in", "out", "checkpoint"))
    parts = _deliveries(r, _ARRIVAL)
    arrive(parts[0].limit(0), arrivals)
    messages = file_messages(r.spark, arrivals, parts[0].schema)
    sums = window_sums(typed_events(messages)).select(
        F.col("window.start").alias("window_start"), "key", "count"
    )
    replay(parts, arrivals, lambda: append_to_files(sums, out, checkpoint, True))
    return scan_parquet(r.spark, out, sums.schema).withColumn(
        "window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")
    )


@query(
    "stream_restart",
    f"""WITH kept AS (SELECT * FROM events)
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, key, count FROM ({_SUMS_OF_KEPT})
WHERE w + INTERVAL 10 SECOND <= (SELECT max(ts) - INTERVAL 10 SECOND FROM events)""",
)
def stream_restart(r: Relations) -> DataFrame:
    """A run that is stopped after its first micro-batch, wherever it is in the second, and another
    one that goes on from its checkpoint: no row is lost or counts twice."""
    arrivals, out, checkpoint = (
        new_folder(r.spark, f"restart-{n}") for n in ("in", "out", "checkpoint")
    )
    parts = _deliveries(r, "ts")
    for part in parts:
        arrive(part.coalesce(1), arrivals)
    messages = file_messages(r.spark, arrivals, parts[0].schema, 1)
    sums = window_sums(typed_events(messages)).select(
        F.col("window.start").alias("window_start"), "key", "count"
    )
    stop_after(append_to_files(sums, out, checkpoint))
    append_to_files(sums, out, checkpoint, True).awaitTermination()
    return scan_parquet(r.spark, out, sums.schema).withColumn(
        "window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")
    )


@query(
    "stream_window_upserts",
    """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       event_type AS key, CAST(sum(CAST(floor(value) AS BIGINT)) AS BIGINT) AS count
FROM events GROUP BY 1, 2""",
)
def stream_window_upserts(r: Relations) -> DataFrame:
    """Hourly sums in a stored table, changed by every delivery; the events of every third user
    arrive five days late, within the watermark."""
    arrivals, out, checkpoint = (
        new_folder(r.spark, f"upsert-{n}") for n in ("in", "out", "checkpoint")
    )
    parts = _deliveries(r, "if(user_id % 3 = 0, ts + interval 5 days, ts)")
    arrive(parts[0].limit(0), arrivals)
    messages = file_messages(r.spark, arrivals, parts[0].schema)
    sums = window_sums(typed_events(messages), "1 hour", "10 days")
    replay(parts, arrivals, lambda: upsert_sums(sums, out, checkpoint, True))
    return scan_parquet(r.spark, out, SUMS_SCHEMA).select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "key", "count"
    )
