from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starloom.operators.numbering import dense_numbers
from starloom.sinks.files import stored_in


@pytest.fixture
def store(tmp_path):
    return stored_in(str(tmp_path))


@pytest.mark.parametrize("partitions", ["1", "7", "40"])
def test_numbers_follow_the_order_without_gaps(spark, store, settings, partitions):
    settings(shuffle__partitions=partitions)
    df = spark.range(5000, numPartitions=6).selectExpr("id", "id * 7919 % 5003 AS v")
    got = dense_numbers(df, [F.desc("v")], "n", store)
    assert got.columns == ["id", "v", "n"]
    by_v = got.orderBy(F.desc("v")).collect()
    assert [r.n for r in by_v] == list(range(1, 5001))


def test_equal_rows_and_nulls(spark, store, settings):
    settings(shuffle__partitions="8")
    rows = [(None, i) for i in range(5)] + [("a", 1)] * 700 + [("b", i % 50) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(4)
    got = dense_numbers(df, ["k"], "n", store, first=0).collect()
    assert sorted(r.n for r in got) == list(range(len(rows)))
    assert {r.n for r in got if r.k is None} == set(range(5))
    assert {r.n for r in got if r.k == "a"} == set(range(5, 705))


def test_a_hot_value_is_spread(spark, store, settings):
    settings(shuffle__partitions="8", adaptive__enabled="false")
    df = spark.range(8000).selectExpr("id", "if(id < 6000, 0, id) AS v")
    dense_numbers(df, ["v"], "n", store)
    placed = store("sizes", df.sparkSession.read.parquet(store_path(store)).groupBy(F.expr("__place >> 33")).count())
    assert placed.count() == 8 and placed.agg(F.max("count")).first()[0] < 2500


def store_path(store):
    return f"{store.__closure__[0].cell_contents.rstrip('/')}/numbered-n"


def test_no_rows(spark, store):
    assert dense_numbers(spark.range(0), ["id"], "n", store).collect() == []
