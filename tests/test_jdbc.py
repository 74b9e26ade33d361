"""No database is started: the tests look at the options that would reach it."""

from __future__ import annotations

from decimal import Decimal

import pytest

from starloom.sinks import jdbc as sink
from starloom.sources import jdbc as source

CONNECTION = {"url": "jdbc:somewhere", "user": "me"}


class Recorder:
    """Stands for a reader or writer and keeps what it is told."""

    def __init__(self, first_row=None):
        self.calls, self.first_row = {}, first_row

    def format(self, name):
        self.calls["format"] = name
        return self

    def option(self, key, value):
        self.calls[key] = value
        return self

    def options(self, **values):
        self.calls.update(values)
        return self

    def mode(self, mode):
        self.calls["mode"] = mode
        return self

    def save(self):
        self.calls["saved"] = True

    def load(self):
        return self

    def first(self):
        return self.first_row


class Session:
    def __init__(self, bounds=None):
        self.readers, self.bounds = [], bounds

    @property
    def read(self):
        self.readers.append(Recorder(self.bounds))
        return self.readers[-1]


class Frame:
    def __init__(self):
        self.write = Recorder()


def test_plain_table_and_query():
    session = Session()
    assert source.read_table(session, "sales", CONNECTION).calls == {
        "format": "jdbc", "dbtable": "sales", **CONNECTION,
    }
    assert source.read_query(session, "SELECT 1", CONNECTION).calls["query"] == "SELECT 1"


def test_split_with_given_bounds():
    calls = source.read_table(
        Session(), "sales", CONNECTION, source.Split("order_id", 0, 1000)
    ).calls
    assert calls["partitionColumn"] == "order_id"
    assert (calls["lowerBound"], calls["upperBound"], calls["numPartitions"]) == ("0", "1000", "4")


def test_split_asks_for_missing_bounds():
    session = Session(bounds=(5, 77))
    calls = source.read_table(
        session, "(select a from t) s", CONNECTION, source.Split("a", parts=9)
    ).calls
    assert (calls["lowerBound"], calls["upperBound"], calls["numPartitions"]) == ("5", "77", "9")
    asked = [r.calls["query"] for r in session.readers if "query" in r.calls]
    assert asked == ["SELECT MIN(a) AS lo, MAX(a) AS hi FROM (select a from t) s"]


def test_bounds_are_whole_numbers():
    bounds = (Decimal("5.500000"), Decimal("76.20"))
    calls = source.read_table(
        Session(bounds=bounds), "t", CONNECTION, source.Split("amount", parts=2)
    ).calls
    assert (calls["lowerBound"], calls["upperBound"]) == ("5", "77")


def test_split_of_an_empty_table_reads_it_plainly():
    calls = source.read_table(
        Session(bounds=(None, None)), "t", CONNECTION, source.Split("a")
    ).calls
    assert "partitionColumn" not in calls


@pytest.mark.parametrize("connections", [None, 3])
def test_append(connections):
    frame = Frame()
    sink.append_table(frame, "dim", CONNECTION, connections)
    assert frame.write.calls["mode"] == "append" and frame.write.calls["saved"]
    assert frame.write.calls.get("numPartitions") == connections


def test_overwrite_keeps_the_definition():
    frame = Frame()
    sink.overwrite_table(frame, "fact", CONNECTION)
    assert frame.write.calls["mode"] == "overwrite" and frame.write.calls["truncate"] is True


def test_repeated_load_appends_nothing(spark, monkeypatch, rows):
    written = []
    monkeypatch.setattr(sink, "append_table", lambda df, *args: written.append(df))
    dates = spark.createDataFrame([("2024-01-01",), ("2024-01-02",)], "date string")
    sink.append_new_rows(dates, dates.limit(1), ["date"], "DateDim", CONNECTION)
    sink.append_new_rows(dates, dates, ["date"], "DateDim", CONNECTION)
    assert [df.count() for df in written] == [1, 0]
