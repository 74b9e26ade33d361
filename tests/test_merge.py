from __future__ import annotations

import random

import pytest

from starloom.operators.merge import ACTION, delete_where, merge, rows_not_in, update_where

SCHEMA = "id int, v string, n int"


def table(spark, *rows_):
    return spark.createDataFrame(list(rows_), SCHEMA)


def test_update(spark, rows):
    df = table(spark, (1, "a", 1), (2, "b", 2), (3, None, 3))
    got = update_where(df, "v = 'a'", {"n": "n + 10", "v": "concat(v, n)"})
    assert rows(got) == [(1, "a1", 11), (2, "b", 2), (3, None, 3)]
    assert got.schema == df.schema


def test_delete_keeps_rows_whose_condition_is_null(spark, rows):
    df = table(spark, (1, "a", 1), (2, "b", 2), (3, None, 3))
    assert rows(delete_where(df, "v = 'a'")) == [(2, "b", 2), (3, None, 3)]


def test_upsert_with_a_constant(spark, rows):
    target = table(spark, (1, "a", 1), (2, "b", 2))
    source = table(spark, (2, "x", 9), (3, "c", 3))
    got = merge(target, source, ["id"], update={"n": "0"})
    assert rows(got) == [(1, "a", 1), (2, "b", 0), (3, "c", 3)]


def test_upsert_of_changed_rows_only(spark, rows):
    target = table(spark, (1, "a", 1), (2, "b", 2))
    source = table(spark, (1, "a", 100), (2, "x", 200), (3, "c", 300))
    got = merge(target, source, ["id"], when="source.v <> target.v", marked=True)
    assert rows(got) == [
        (1, "a", 1, "kept"), (2, "x", 200, "updated"), (3, "c", 300, "inserted"),
    ]


def test_null_keys_match_nothing(spark, rows):
    target = table(spark, (None, "t", 1), (1, "a", 1))
    source = table(spark, (None, "s", 2), (1, "b", 2))
    assert rows(merge(target, source, ["id"])) == [(1, "b", 2), (None, "s", 2), (None, "t", 1)]


def test_two_matches_for_one_row_fail(spark, rows):
    target = table(spark, (1, "a", 1))
    twice = table(spark, (1, "x", 1), (1, "y", 1))
    with pytest.raises(Exception, match="two source rows match"):
        merge(target, twice, ["id"]).collect()
    unmatched = table(spark, (5, "x", 1), (5, "y", 1))
    assert rows(merge(target, unmatched, ["id"])) == [(1, "a", 1), (5, "x", 1), (5, "y", 1)]


def test_one_source_row_may_match_many(spark, rows):
    target = table(spark, (1, "a", 1), (1, "b", 2))
    got = merge(target, table(spark, (1, "z", 9)), ["id"], update={"n": "source.n + target.n"})
    assert rows(got) == [(1, "a", 10), (1, "b", 11)]


def test_conditions_on_who_may_match(spark, rows):
    target = table(spark, (1, "open", 1), (1, "closed", 2), (2, "open", 3))
    source = table(spark, (1, "close", 0), (1, "fresh", 5), (3, "close", 6))
    got = merge(
        target, source, ["id"], update={"v": "'closed'"},
        target_matches="v = 'open'", source_matches="v = 'close'", marked=True,
    )
    assert rows(got) == sorted(
        [
            (1, "closed", 1, "updated"), (1, "closed", 2, "kept"), (2, "open", 3, "kept"),
            (1, "fresh", 5, "inserted"), (3, "close", 6, "inserted"),
        ],
        key=repr,
    )


def test_update_without_insert(spark, rows):
    got = merge(table(spark, (1, "a", 1)), table(spark, (2, "b", 2)), ["id"], insert=False)
    assert rows(got) == [(1, "a", 1)]


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_against_brute_force(spark, rows, settings, threshold):
    settings(autoBroadcastJoinThreshold=threshold)
    rng = random.Random(11)
    old = [(rng.choice([None, *range(60)]), rng.choice("abc"), i) for i in range(200)]
    new = [(k, rng.choice("abc"), 1000 + k) for k in rng.sample(range(90), 50)]
    by_key = {k: (v, n) for k, v, n in new}
    expected = []
    for k, v, n in old:
        hit = by_key.get(k)
        expected.append((k, *hit) if hit and hit[0] != v else (k, v, n))
    present = {k for k, _, _ in old}
    expected += [row for row in new if row[0] not in present]
    got = merge(table(spark, *old), table(spark, *new), ["id"], when="source.v <> target.v")
    assert rows(got) == sorted(expected, key=repr)


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_rows_not_in(spark, rows, settings, threshold):
    settings(autoBroadcastJoinThreshold=threshold)
    fresh = table(spark, (1, "a", 1), (2, "b", 2), (2, "c", 2), (None, "d", 3))
    known = table(spark, (1, "z", 0), (1, "z", 0), (None, "z", 0))
    assert rows(rows_not_in(fresh, known, ["id"])) == [(2, "b", 2), (2, "c", 2), (None, "d", 3)]


def test_a_small_source_shuffles_nothing_but_keys_of_the_target(spark, tmp_path, executed_plan):
    folder = str(tmp_path / "target")
    spark.range(0, 100_000, 1, 8).selectExpr("id", "id AS wide").write.parquet(folder)
    target = spark.read.parquet(folder)
    source = spark.sql("SELECT * FROM VALUES (5L, 1L), (200000L, 2L) AS s(id, wide)")
    updated = merge(target, source, ["id"], insert=False)
    plan = executed_plan(updated).split("Initial Plan")[0]
    above_the_target = plan[: plan.index("FileScan")].splitlines()
    joined = next(i for i, line in enumerate(above_the_target) if "BroadcastHashJoin" in line)
    assert not any("Exchange hashpartitioning" in line for line in above_the_target[:joined])
    assert "SortMergeJoin" not in plan and "SortAggregate" not in plan
    whole = executed_plan(merge(target, source, ["id"])).split("Initial Plan")[0]
    assert whole.count("FileScan") == 2 and "SortAggregate" not in whole
    assert sum("Exchange hashpartitioning(id" in line for line in whole.splitlines()) <= 3


def test_each_side_is_read_twice(spark, tmp_path, executed_plan):
    for name in ("target", "source"):
        spark.range(50).selectExpr("id", f"'{name}' AS name").write.parquet(str(tmp_path / name))
    sides = [spark.read.parquet(str(tmp_path / name)) for name in ("target", "source")]
    plan = merge(*sides, ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 4


def test_a_hot_target_key_is_split(spark, settings, executed_plan):
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        adaptive__advisoryPartitionSizeInBytes="20KB",
        shuffle__partitions="32",
    )
    target = spark.range(0, 200_000, 1, 8).selectExpr("if(id % 3 = 0, 7, id) AS id", "id AS n")
    source = spark.range(0, 100_000, 1, 8).selectExpr("id", "id AS n")
    merged = merge(target, source, ["id"], update={"n": "-1"}, marked=True)
    assert "SortMergeJoin(skew=true)" in executed_plan(merged)
    counts = dict(map(tuple, merged.groupBy(ACTION).count().collect()))
    kept = sum(1 for i in range(100_000, 200_000) if i % 3)
    missing = len(range(0, 100_000, 3))
    assert counts == {"kept": kept, "updated": 200_000 - kept, "inserted": missing}
