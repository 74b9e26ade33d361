from __future__ import annotations

import json
import time

import pytest

from starloom.streaming.word_sum import (
    append_to_files,
    file_messages,
    json_fields,
    kafka_messages,
    typed_events,
    window_sums,
    write_updates,
)


class Topic:
    """A folder that gets one file of messages at a time."""

    def __init__(self, spark, path):
        self.spark, self.path, self.sent = spark, str(path), 0
        path.mkdir()

    def send(self, *events):
        rows = [
            (word, json.dumps({"event_time": at, "word": word, "count": n}).encode())
            for at, word, n in events
        ]
        df = self.spark.createDataFrame(rows, "key string, value binary").coalesce(1)
        df.write.mode("append").parquet(self.path)
        self.sent += 1
        time.sleep(1.1)  # files are taken in the order of their times

    def read(self, files_per_batch=1):
        return file_messages(self.spark, self.path, "key string, value binary", files_per_batch)


@pytest.fixture
def topic(spark, tmp_path):
    return Topic(spark, tmp_path / "topic")


def at(second, minute=0):
    return f"2024-01-01 00:{minute:02d}:{second:02d}"


def sums(spark, path):
    df = spark.read.schema("w timestamp, key string, count bigint").parquet(path)
    return sorted((str(r.w), r.key, r["count"]) for r in df.collect())


def run(topic, tmp_path):
    frame = window_sums(typed_events(topic.read())).selectExpr("window.start AS w", "key", "count")
    out = str(tmp_path / "out")
    append_to_files(frame, out, str(tmp_path / "checkpoint"), True).awaitTermination()
    return sums(topic.spark, out)


def test_windows_come_out_when_the_watermark_has_passed(topic, tmp_path):
    topic.send((at(1), "a", 1), (at(9), "a", 2), (at(0, 1), "b", 5))
    topic.send((at(2), "a", 100), (at(0, 2), "b", 7))
    assert run(topic, tmp_path) == [(at(0), "a", 103), (at(0, 1), "b", 5)]


def test_late_rows_are_dropped_and_a_restart_goes_on(topic, tmp_path):
    topic.send((at(1), "a", 1), (at(0, 1), "b", 5))
    topic.send((at(0, 2), "b", 7))
    assert run(topic, tmp_path) == [(at(0), "a", 1), (at(0, 1), "b", 5)]
    topic.send((at(3), "a", 1000), (at(1, 2), "b", 1))
    topic.send((at(0, 4), "c", 1))
    assert run(topic, tmp_path) == [(at(0), "a", 1), (at(0, 1), "b", 5), (at(0, 2), "b", 8)]


def test_closed_windows_equal_the_batch_answer(spark, topic, tmp_path):
    events = [(at(s, m), "ab"[s % 2], s + m) for m in range(3) for s in range(0, 60, 7)]
    for start in range(0, len(events), 9):
        topic.send(*events[start : start + 9])
    expected = {}
    for when, word, n in events:
        window = when[:-1] + "0"
        expected[(window, word)] = expected.get((window, word), 0) + n
    closed = sorted((w, k, n) for (w, k), n in expected.items() if w <= at(40, 2))
    got = run(topic, tmp_path)
    assert got == [row for row in closed if row[0] < at(40, 2)]


def test_unreadable_messages_become_nulls(spark):
    messages = spark.createDataFrame(
        [(b'{"event_time": "2024-01-01 00:00:01", "word": "a", "count": 3}',),
         (b'{"event_time": "soon", "word": "b", "count": "x"}',), (b"no json",), (None,)],
        "value binary",
    )
    got = [(str(r.eventtime), r.key, r.value) for r in typed_events(messages).collect()]
    nothing = ("None", None, None)
    assert got == [("2024-01-01 00:00:01", "a", 3), ("None", "b", None), nothing, nothing]
    fields = [tuple(r) for r in json_fields(messages).collect()]
    assert fields[:2] == [("2024-01-01 00:00:01", "a", "3"), ("soon", "b", "x")]


def test_updates_are_written_once_per_batch(spark, topic, tmp_path):
    topic.send((at(1), "a", 1))
    topic.send((at(2), "b", 2))
    out = str(tmp_path / "updates")
    for _ in range(2):
        write_updates(
            typed_events(topic.read()), out, str(tmp_path / "state"), True
        ).awaitTermination()
    df = spark.read.parquet(out)
    assert sorted((r.batch, r.key, r.value) for r in df.collect()) == [(0, "a", 1), (1, "b", 2)]


def test_a_running_query_can_be_stopped(topic, tmp_path):
    topic.send((at(1), "a", 1))
    query = append_to_files(
        typed_events(topic.read()), str(tmp_path / "o"), str(tmp_path / "c")
    )
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    assert not query.isActive
    assert topic.spark.read.parquet(str(tmp_path / "o")).count() == 1


def test_kafka_options():
    class Reader:
        def __init__(self):
            self.set = {}

        def format(self, name):
            self.set["format"] = name
            return self

        def option(self, key, value):
            self.set[key] = value
            return self

        def load(self):
            return self.set

    class Session:
        readStream = Reader()

    assert kafka_messages(Session, "host:1", "demo", "earliest") == {
        "format": "kafka", "kafka.bootstrap.servers": "host:1", "subscribe": "demo",
        "startingOffsets": "earliest",
    }


def test_other_field_names_and_formats(spark, tmp_path, topic):
    text = json.dumps({"timestamp": at(1), "key": "a", "value": 3})
    frame = spark.createDataFrame([("k", text.encode())], "key string, value binary")
    names = ("timestamp", "key", "value")
    event = typed_events(frame, names).first()
    assert (str(event.eventtime), event.key, event.value) == (at(1), "a", 3)
    assert tuple(json_fields(frame, names).first()) == (at(1), "a", "3")
    topic.send((at(1), "a", 1))
    out = str(tmp_path / "json")
    events = typed_events(topic.read())
    append_to_files(events, out, str(tmp_path / "c"), True, "json").awaitTermination()
    assert [r.key for r in spark.read.json(out).collect()] == ["a"]
