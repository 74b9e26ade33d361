from __future__ import annotations

import random

import pytest

from starloom.operators.joins import BUCKETS, detect_changes, lookup, lookup_in_range


@pytest.fixture
def versions(spark):
    return spark.sql(
        "SELECT * FROM VALUES (1, 'a', timestamp'2024-01-01', timestamp'2024-02-01'),"
        " (1, 'b', timestamp'2024-02-01', timestamp'2100-12-12'),"
        " (2, 'c', timestamp'2024-01-15', timestamp'2100-12-12') AS v(k, name, s, e)"
    )


def facts_at(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k int, t string").selectExpr(
        "k", "to_timestamp(t) AS t"
    )


@pytest.mark.parametrize("bucket", [None, "month", "year"])
def test_start_excluded_end_included(spark, versions, rows, bucket):
    facts = facts_at(
        spark,
        (1, "2024-01-01 00:00:00"),
        (1, "2024-01-01 00:00:01"),
        (1, "2024-02-01 00:00:00"),
        (1, "2024-02-01 00:00:01"),
        (2, "2024-01-15 00:00:00"),
        (3, "2024-01-20 00:00:00"),
        (None, "2024-01-20 00:00:00"),
    )
    got = lookup_in_range(
        facts, versions, {"k": "k"}, "t", "s", "e", {"n": "name"},
        start_included=False, bucket=bucket,
    )
    assert got.columns == ["k", "t", "n"]
    assert [(r.k, r.n) for r in got.orderBy("k", "t").collect()] == [
        (None, None), (1, None), (1, "a"), (1, "a"), (1, "b"), (2, None), (3, None),
    ]


@pytest.mark.parametrize("bucket", [None, "day", "month", "year"])
def test_closed_range_fans_out(spark, rows, bucket):
    ranges = spark.sql(
        "SELECT * FROM VALUES (1, 'x', date'2024-01-01', date'2024-01-10'),"
        " (1, 'y', date'2024-01-10', date'2024-01-20') AS v(k, name, s, e)"
    )
    facts = facts_at(spark, (1, "2024-01-10 23:00:00"), (1, "2024-01-21 00:00:00"))
    got = lookup_in_range(
        facts, ranges, {"k": "k"}, "to_date(t)", "s", "e", {"n": "name"},
        start_included=True, bucket=bucket,
    )
    assert [r[0] for r in rows(got, "n")] == ["x", "y", None]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_buckets_change_nothing(spark, rows, how):
    rng = random.Random(7)
    ranges = [(rng.randrange(5), i, rng.randrange(900), rng.randrange(1, 500)) for i in range(120)]
    facts = [(rng.randrange(6), i, rng.randrange(1500)) for i in range(300)]
    dimension = spark.createDataFrame(ranges, "k int, id int, off int, len int").selectExpr(
        "k", "id", "date_add(date'2021-01-01', off) AS s",
        "date_add(date'2021-01-01', off + len) AS e",
    )
    left = spark.createDataFrame(facts, "k int, f int, off int").selectExpr(
        "k", "f", "date_add(date'2021-01-01', off) AS day"
    )

    def joined(bucket):
        return rows(
            lookup_in_range(
                left, dimension, {"k": "k"}, "day", "s", "e", {"id": "id"},
                start_included=True, how=how, bucket=bucket,
            ),
            "f", "id",
        )

    expected = sorted(
        (
            (f, i)
            for k, f, at in facts
            for i in (
                [i for kk, i, off, n in ranges if kk == k and off <= at <= off + n]
                or ([None] if how == "left" else [])
            )
        ),
        key=repr,
    )
    for bucket in (None, *BUCKETS):
        assert joined(bucket) == expected


def test_same_dimension_in_two_roles(spark, rows):
    rides = spark.createDataFrame([(1, 10, 20), (2, 20, 99)], "id int, a int, b int")
    stations = spark.createDataFrame([(10, "north"), (20, "south")], "id int, name string")
    once = lookup(rides, stations, {"a": "id"}, {"a_name": "name"})
    both = lookup(once, stations, {"b": "id"}, {"b_name": "name", "b_upper": "upper(name)"})
    assert rows(both) == [(1, 10, 20, "north", "south", "SOUTH"), (2, 20, 99, "south", None, None)]
    assert lookup(rides, stations, {"b": "id"}, {"n": "name"}, "inner").count() == 1


def test_lookup_by_several_columns_and_expressions(spark, rows):
    facts = spark.createDataFrame([(2000, 5), (2000, 6)], "zip int, hour int")
    weather = spark.createDataFrame(
        [("2000", 5, "wet"), ("bad", 6, "dry")], "z string, h int, d string"
    )
    got = lookup(facts, weather, {"zip": "try_cast(z AS int)", "hour": "h"}, {"d": "d"})
    assert rows(got) == [(2000, 5, "wet"), (2000, 6, None)]


def test_changes_are_found_through_nulls(spark, rows):
    source = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z"), (4, None)], "k int, md5 string")
    old = spark.createDataFrame([(1, "x"), (2, None), (4, None)], "k int, md5 string")
    assert rows(detect_changes(source, old, "k", "md5"), "k", "dwh_k") == [(2, 2), (3, None)]


@pytest.mark.parametrize("hot", ["7", "NULL"])
def test_a_hot_fact_key_is_split(spark, settings, executed_plan, hot):
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        adaptive__advisoryPartitionSizeInBytes="20KB",
        shuffle__partitions="32",
    )
    facts = spark.range(0, 200_000, 1, 8).selectExpr(
        f"if(id % 3 = 0, {hot}, id) AS k", "id AS payload", "timestamp'2024-05-05' AS t"
    )
    dimension = spark.range(0, 200_000, 1, 8).selectExpr(
        "id AS k", "id * 2 AS twice", "timestamp'2024-01-01' AS s", "timestamp'2100-12-12' AS e"
    )
    plain = lookup(facts, dimension, {"k": "k"}, {"twice": "twice"})
    ranged = lookup_in_range(
        facts, dimension, {"k": "k"}, "t", "s", "e", {"twice": "twice"}, start_included=False
    )
    for joined in (plain, ranged):
        assert "SortMergeJoin(skew=true)" in executed_plan(joined)
        assert joined.count() == 200_000
        assert joined.where("twice = 14").count() == (66_668 if hot == "7" else 1)
