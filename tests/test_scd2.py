from __future__ import annotations

import random

import pytest

from starloom.operators.scd2 import scd2_apply, scd2_initial, unique_by

ARGS = ("id", ("name", "office"), "sk")
SCHEMA = "id int, name string, office string"


def start(spark, people):
    return scd2_initial(spark.createDataFrame(people, SCHEMA), *ARGS)


def load(spark, dimension, people, at):
    return scd2_apply(dimension, spark.createDataFrame(people, SCHEMA), *ARGS, at)


def spans(df):
    return sorted(
        (r.id, r.office, str(r.scd_start), str(r.scd_end), r.current) for r in df.collect()
    )


OPEN, FIRST = "2100-12-12 00:00:00", "1999-01-01 00:00:00"


def test_first_load(spark):
    dimension = start(spark, [(1, "Jane", "NY")])
    assert dimension.columns == [
        "sk", "id", "name", "office", "scd_start", "scd_end", "md5", "current",
    ]
    assert spans(dimension) == [(1, "NY", FIRST, OPEN, True)]


def test_changed_new_and_unchanged(spark):
    dimension = start(spark, [(1, "Jane", "NY"), (2, "Bob", "Berlin")])
    run = "2024-06-01 00:00:00"
    source = [(1, "Jane", "Paris"), (2, "Bob", "Berlin"), (3, "Eve", "Rome")]
    after = load(spark, dimension, source, run)
    assert spans(after) == [
        (1, "NY", FIRST, run, False),
        (1, "Paris", run, OPEN, True),
        (2, "Berlin", FIRST, OPEN, True),
        (3, "Rome", run, OPEN, True),
    ]
    assert after.schema.fieldNames() == dimension.schema.fieldNames()
    assert [f.dataType for f in after.schema] == [f.dataType for f in dimension.schema]
    assert after.select("sk").distinct().count() == 4
    assert spans(load(spark, after, source, "2024-07-01 00:00:00")) == spans(after)


def test_change_to_and_from_null_is_seen(spark):
    dimension = start(spark, [(1, "Jane", None)])
    after = load(spark, dimension, [(1, "Jane", "NY")], "2024-01-01 00:00:00")
    again = load(spark, after, [(1, "Jane", None)], "2024-02-01 00:00:00")
    assert [r.current for r in again.orderBy("scd_start").collect()] == [False, False, True]


def test_vanished_rows_stay_open(spark):
    dimension = start(spark, [(1, "Jane", "NY"), (2, "Bob", "Berlin")])
    after = load(spark, dimension, [(2, "Bob", "Berlin")], "2024-01-01 00:00:00")
    assert spans(after) == spans(dimension)


def test_rows_without_a_key(spark):
    dimension = start(spark, [(None, "Old", "NY"), (1, "Jane", "NY")])
    after = load(
        spark, dimension, [(None, "A", "x"), (None, "B", "y"), (1, "Jane", "NY")],
        "2024-01-01 00:00:00",
    )
    got = sorted((r.id is None, r.name, r.current) for r in after.collect())
    assert got == [
        (False, "Jane", True), (True, "A", True), (True, "B", True), (True, "Old", True),
    ]


def test_repeated_source_key_fails(spark):
    dimension = start(spark, [(1, "Jane", "NY")])
    twice = load(spark, dimension, [(2, "A", "x"), (2, "B", "x")], "2024-01-01 00:00:00")
    with pytest.raises(Exception, match="occurs twice"):
        twice.collect()


def test_uniqueness_check_adds_no_shuffle(spark, settings, executed_plan):
    settings(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    left = spark.range(100).withColumnRenamed("id", "k")
    right = spark.range(100).selectExpr("id AS k", "id + 1 AS v")
    joined = left.join(unique_by(right, "k"), "k", "full")
    assert executed_plan(joined).count("Exchange hashpartitioning") == 2


def test_two_open_versions_fail(spark):
    dimension = start(spark, [(1, "Jane", "NY"), (1, "Jane", "LA")])
    with pytest.raises(Exception, match="occurs twice"):
        load(spark, dimension, [(1, "Jane", "Rome")], "2024-01-01 00:00:00").collect()


def test_a_run_before_the_open_version_fails(spark):
    dimension = load(
        spark, start(spark, [(1, "Jane", "NY")]), [(1, "Jane", "LA")], "2024-06-01 00:00:00"
    )
    dimension = spark.createDataFrame(dimension.collect(), dimension.schema)
    with pytest.raises(Exception, match="starts after the run"):
        load(spark, dimension, [(1, "Jane", "Rome")], "2024-01-01 00:00:00").collect()
    same = load(spark, dimension, [(1, "Jane", "LA")], "2024-01-01 00:00:00")
    assert spans(same) == spans(dimension)


def test_many_loads_keep_the_invariants(spark):
    rng = random.Random(3)
    people = {i: (f"n{i}", "A") for i in range(30)}
    dimension = start(spark, [(i, *v) for i, v in people.items()])
    history = {i: [(FIRST, v)] for i, v in people.items()}
    for month in range(1, 5):
        at = f"2024-{month:02d}-01 00:00:00"
        for i in rng.sample(range(40), 12):
            new = (f"n{i}", rng.choice("ABC"))
            if people.get(i) != new:
                people[i] = new
                history.setdefault(i, []).append((at, new))
        dimension = load(spark, dimension, [(i, *v) for i, v in people.items()], at)
        dimension = spark.createDataFrame(dimension.collect(), dimension.schema)
    expected = sorted(
        (i, v[1], begin, (versions + [(OPEN, None)])[n + 1][0], n == len(versions) - 1)
        for i, versions in history.items()
        for n, (begin, v) in enumerate(versions)
    )
    assert spans(dimension) == expected
