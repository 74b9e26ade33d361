from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from starloom.operators.merge import merge
from starloom.operators.stored_merge import merge_into
from starloom.sinks.files import write_partitioned


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def folders(names):
    return {name.rsplit("/", 1)[0] for name in names}


@pytest.fixture
def table(spark, tmp_path):
    """Ten days of a hundred rows."""
    path = str(tmp_path / "table")
    df = spark.range(1000).selectExpr("id", "id % 7 AS v", "date_add(date'2024-01-01', cast(id div 100 AS int)) AS day")
    write_partitioned(df, path, ["day"])
    return path, df


def read(spark, path, df):
    return spark.read.schema(df.schema).parquet(path)


def test_a_folder_per_day_in_few_files(table):
    path, _ = table
    names = files(path)
    assert len(folders(names)) == len(names) == 10


def test_only_days_with_changes_are_written(spark, table, rows):
    path, df = table
    # Day 2 gets a change, day 3 the same rows again, day 11 is new.
    source = df.where("day in (date'2024-01-02', date'2024-01-03')").withColumn(
        "v", F.when(F.col("id") == 150, 99).otherwise(F.col("v"))
    ).unionByName(spark.sql("SELECT 5000L AS id, 1L AS v, date'2024-01-11' AS day"))
    before = files(path)
    how = {"update": "all", "when": "NOT (target.v <=> source.v)"}
    expected = rows(merge(df, source, ["id", "day"], **how))
    assert merge_into(path, df.schema, source, ["id", "day"], ["day"], **how) == 2
    assert rows(read(spark, path, df)) == expected and len(expected) == 1001
    after = files(path)
    new = {name for name in after if after[name] != before.get(name)}
    assert folders(new) == {"day=2024-01-02", "day=2024-01-11"}
    assert {n for n in before if "2024-01-02" not in n} <= set(after)

    same = files(path)
    assert merge_into(path, df.schema, source, ["id", "day"], ["day"], **how) == 0
    assert files(path) == same


def test_without_a_condition_offered_days_are_written(spark, table, rows):
    path, df = table
    source = df.where("id between 250 and 260").selectExpr("id", "day", "-1 AS v")
    expected = rows(merge(df, source, ["id", "day"]))
    assert merge_into(path, df.schema, source, ["id", "day"], ["day"]) == 1
    assert rows(read(spark, path, df)) == expected
    assert merge_into(path, df.schema, source.limit(0), ["id", "day"], ["day"]) == 0
    only_updates = source.unionByName(spark.sql("SELECT 9L AS id, date'2025-01-01' AS day, 0 AS v"))
    assert merge_into(path, df.schema, only_updates, ["id", "day"], ["day"], insert=False) == 1
    assert rows(read(spark, path, df)) == expected


def test_pruned_read(spark, table):
    path, df = table
    plan = read(spark, path, df).where(F.col("day").isin(["2024-01-02"]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in text and "2024-01-02" in text.split("PartitionFilters")[1][:120]


def test_two_partition_columns_and_nulls(spark, tmp_path, rows):
    path = str(tmp_path / "table")
    df = spark.range(60).selectExpr("id", "0 AS v", "if(id % 5 = 0, NULL, id % 3) AS a", "cast(id % 2 AS string) AS b")
    write_partitioned(df, path, ["a", "b"])
    source = spark.sql("SELECT 7L AS id, 1 AS v, 1L AS a, '1' AS b UNION ALL SELECT 100, 2, NULL, 'x'")
    before = files(path)
    assert merge_into(path, df.schema, source, ["id", "a", "b"], ["a", "b"]) == 2
    got = rows(read(spark, path, df))
    assert got == sorted([(i, 1 if i == 7 else 0, None if i % 5 == 0 else i % 3, str(i % 2)) for i in range(60)]
                         + [(100, 2, None, "x")], key=repr)
    after = files(path)
    assert folders(n for n in after if n not in before) == {"a=1/b=1", "a=__HIVE_DEFAULT_PARTITION__/b=x"}


def test_partition_columns_are_keys(spark, table):
    path, df = table
    with pytest.raises(ValueError, match="among the keys"):
        merge_into(path, df.schema, df, ["id"], ["day"])


def test_copies_in_the_source_fail_and_leave_the_table(spark, table, rows):
    path, df = table
    before = files(path)
    twice = df.where("id = 5").unionByName(df.where("id = 5"))
    with pytest.raises(Exception, match="two source rows"):
        merge_into(path, df.schema, twice, ["id", "day"], ["day"])
    assert files(path) == before
