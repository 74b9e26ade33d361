from __future__ import annotations

import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starloom.streaming.replay import arrive, replay, stop_after
from starloom.streaming.word_sum import (
    SUMS_SCHEMA,
    append_to_files,
    file_messages,
    typed_events,
    upsert_sums,
    window_sums,
)

SCHEMA = "key string, value binary"


@pytest.fixture
def messages(spark):
    """Messages from (hh:mm:ss, word, count)."""

    def make(*events):
        rows = [
            (word, json.dumps({"event_time": f"2024-01-01 {at}", "word": word, "count": n}).encode())
            for at, word, n in events
        ]
        return spark.createDataFrame(rows, SCHEMA).coalesce(1)

    return make


def sums_of(spark, folder, files_per_batch=None, watermark="10 seconds"):
    frame = file_messages(spark, str(folder), SCHEMA, files_per_batch)
    return window_sums(typed_events(frame), watermark=watermark)


def appended(frame, tmp_path):
    flat = frame.selectExpr("window.start AS w", "key", "count")
    return append_to_files(flat, str(tmp_path / "out"), str(tmp_path / "checkpoint"), True)


def closed(spark, tmp_path):
    df = spark.read.schema("w timestamp, key string, count bigint").parquet(str(tmp_path / "out"))
    return sorted((str(r.w)[11:], r.key, r["count"]) for r in df.collect())


def test_rows_behind_the_watermark_are_dropped(spark, messages, tmp_path):
    path = tmp_path / "in"
    parts = [
        messages(("00:00:01", "a", 1), ("00:01:00", "a", 2)),
        # Late, behind the mark of 00:00:50; not late; on time.
        messages(("00:00:02", "a", 100), ("00:00:49", "b", 50), ("00:00:55", "a", 3), ("00:03:00", "a", 4)),
        messages(("00:02:30", "a", 1000), ("00:03:01", "a", 5), ("00:04:00", "c", 6)),
    ]
    arrive(parts[0].limit(0), str(path))
    read = replay(parts, str(path), lambda: appended(sums_of(spark, path), tmp_path))
    assert read == [2, 4, 3]
    assert closed(spark, tmp_path) == [
        ("00:00:00", "a", 1), ("00:00:50", "a", 3), ("00:01:00", "a", 2), ("00:03:00", "a", 9),
    ]


def test_a_stopped_stream_goes_on(spark, messages, tmp_path):
    path = tmp_path / "in"
    for minute in range(4):
        arrive(messages(*((f"00:0{minute}:{s:02d}", "ab"[s % 2], 1) for s in range(0, 60, 5))), str(path))
        time.sleep(1.1)
    flat = sums_of(spark, path, 1).selectExpr("window.start AS w", "key", "count")
    places = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    assert stop_after(append_to_files(flat, *places)) >= 1
    append_to_files(flat, *places, available_now=True).awaitTermination()
    got = closed(spark, tmp_path)
    assert len(got) == len(set(got)) == 44 and sum(n for *_, n in got) == 44
    assert got[-1][0] == "00:03:30"


def test_errors_of_a_stopped_stream_come_out(spark, messages, tmp_path):
    arrive(messages(("00:00:01", "a", 1)), str(tmp_path / "in"))
    broken = file_messages(spark, str(tmp_path / "in"), SCHEMA).select(F.raise_error(F.lit("no good")).alias("x"))
    with pytest.raises(Exception, match="no good"):
        stop_after(append_to_files(broken.select(F.col("x").cast("string")), str(tmp_path / "out"),
                                   str(tmp_path / "checkpoint")))


def table(spark, path):
    df = spark.read.schema(SUMS_SCHEMA).parquet(str(path))
    return sorted((str(r.window_start)[11:], r.key, r["count"]) for r in df.collect())


def test_latest_sums_are_kept(spark, messages, tmp_path):
    path, out = tmp_path / "in", tmp_path / "sums"
    parts = [
        messages(("00:00:01", "a", 1), ("00:00:12", "b", 5)),
        messages(("00:00:02", "a", 10), ("00:00:31", "a", 2)),
        messages(("00:00:03", "a", 100), ("00:00:13", "c", 7)),
    ]
    arrive(parts[0].limit(0), str(path))

    def start(checkpoint="checkpoint"):
        frame = sums_of(spark, path, watermark="1 hour")
        return upsert_sums(frame, str(out), str(tmp_path / checkpoint), True)

    replay(parts, str(path), start)
    expected = [("00:00:00", "a", 111), ("00:00:10", "b", 5), ("00:00:10", "c", 7), ("00:00:30", "a", 2)]
    assert table(spark, out) == expected
    # All again from the start, in one micro-batch of a lower number: nothing changes, nothing is written.
    before = {p: p.stat().st_mtime_ns for p in Path(out).rglob("*.parquet")}
    start("another").awaitTermination()
    assert table(spark, out) == expected
    assert {p: p.stat().st_mtime_ns for p in Path(out).rglob("*.parquet")} == before


def test_a_repeated_batch_changes_nothing(spark, messages, tmp_path):
    """The last commit is taken back, as if the driver had died between table and commit."""
    path, out, checkpoint = tmp_path / "in", tmp_path / "sums", tmp_path / "checkpoint"
    arrive(messages(("00:00:01", "a", 1)), str(path))

    def run():
        query = upsert_sums(sums_of(spark, path, watermark="1 hour"), str(out), str(checkpoint), True)
        query.awaitTermination()

    run()
    arrive(messages(("00:00:02", "a", 2), ("00:00:15", "b", 3)), str(path))
    run()
    expected = [("00:00:00", "a", 3), ("00:00:10", "b", 3)]
    assert table(spark, out) == expected
    commits = sorted(int(p.name) for p in (checkpoint / "commits").iterdir() if p.name.isdigit())
    last = commits[-1]
    for name in (f"{last}", f".{last}.crc"):
        (checkpoint / "commits" / name).unlink(missing_ok=True)
    run()
    assert table(spark, out) == expected
