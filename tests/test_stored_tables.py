"""Tables whose storage spares reading or shuffling, and lines that do not fit."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starloom.plans.calendar import date_dimension
from starloom.plans.sales import fact_by_month, revenue_by_weekday, revenue_by_weekday_of
from starloom.sinks.files import stored_in, write_partitioned, write_table
from starloom.sources.files import checked_csv_lines, scan_csv_checked, scan_parquet


@pytest.fixture
def star(spark, tmp_path):
    dates = stored_in(str(tmp_path))("dates", date_dimension(spark, "2024-01-01", "2024-12-31"))
    fact = spark.range(4000).selectExpr(
        "if(id % 40 = 0, NULL, id % 366) AS date_sk", "cast(id % 10 AS decimal(18, 2)) AS revenue_mv"
    )
    by_month = fact_by_month(fact, dates)
    write_partitioned(by_month, str(tmp_path / "fact"), ["month_sk"])
    return fact, dates, scan_parquet(spark, str(tmp_path / "fact"), by_month.schema)


def test_the_report_reads_the_months_of_its_days(star, rows, executed_plan):
    fact, dates, stored = star
    march = dates.where("CalendarYear = 2024 AND MonthOfYear = 3 AND IsWeekDay = 'Y'")
    report = revenue_by_weekday_of(stored, march)
    assert rows(report) == rows(revenue_by_weekday(fact, march))
    plan = executed_plan(report)
    assert "dynamicpruningexpression(month_sk" in plan


def test_every_month_and_no_day_at_all(star, rows):
    fact, dates, stored = star
    assert rows(revenue_by_weekday_of(stored, dates)) == rows(revenue_by_weekday(fact, dates))
    assert revenue_by_weekday_of(stored, dates.where("false")).collect() == []
    assert stored.where("month_sk IS NULL").count() == 100


@pytest.fixture
def buckets(spark, tmp_path):
    made = []

    def write(name, df, **how):
        write_table(df, name, str(tmp_path / name), **how)
        made.append(name)
        return spark.table(name)

    yield write
    for name in made:
        spark.sql(f"DROP TABLE {name}")


def test_equal_buckets_join_and_group_without_a_shuffle(spark, buckets, settings, rows, executed_plan):
    settings(autoBroadcastJoinThreshold="-1")
    left = spark.range(3000).selectExpr("id % 700 AS k", "id AS v")
    right = spark.range(650).selectExpr("id AS k2", "id * 2 AS w")
    a = buckets("bucketed_a", left, buckets=6, bucket_by=["k"])
    b = buckets("bucketed_b", right, buckets=6, bucket_by=["k2"])
    joined = a.join(b, F.expr("k = k2")).groupBy("k").agg(F.sum("w").alias("w"))
    plan = executed_plan(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "SelectedBucketsCount: 6" in plan
    assert rows(joined) == rows(
        left.join(right, F.expr("k = k2")).groupBy("k").agg(F.sum("w").alias("w"))
    )


def test_buckets_within_partitions(spark, buckets, tmp_path, rows):
    df = spark.range(100).selectExpr("id AS k", "id % 3 AS p")
    got = buckets("bucketed_c", df, buckets=2, bucket_by=["k"], partition_by=["p"])
    assert rows(got, "k", "p") == rows(df, "k", "p")
    assert len(list((tmp_path / "bucketed_c").rglob("*.parquet"))) == 6
    plain = buckets("bucketed_d", df, partition_by=["p"])
    assert rows(plain, "k", "p") == rows(df, "k", "p")


LINES = [
    "id,amount,day,note",
    "1,2.5,2024-01-31,fine",
    "2,,,",
    '3,1e3,2024-02-29,"a, ""b"""',
    "x,1,2024-01-01,no number",
    "4,1,2024-02-30,no day",
    "5,1,2024-01-01",
    "6,1,2024-01-01,one,more",
    ",1,2024-01-01,no key",
    "",
    "id,amount,day,note",
    "99999999999999999999,1,,too large",
    "7,1,2024-01-01,windows\r",
]


@pytest.fixture
def lines(spark, tmp_path):
    path = str(tmp_path / "lines")
    spark.createDataFrame([(line,) for line in LINES], "value string").coalesce(1).write.text(path)
    return path


SCHEMA = "id bigint NOT NULL, amount double, day date, note string"


def test_lines_that_do_not_fit_go_to_their_own_table(spark, lines):
    good, bad = scan_csv_checked(spark, lines, SCHEMA)
    assert [f.dataType.simpleString() for f in good.schema] == ["bigint", "double", "date", "string"]
    assert [(r.id, r.amount, str(r.day), r.note) for r in good.orderBy("id").collect()] == [
        (1, 2.5, "2024-01-31", "fine"), (2, None, "None", None), (3, 1000.0, "2024-02-29", 'a, "b"'),
        (7, 1.0, "2024-01-01", "windows"),
    ]
    assert {r.line: r.reason for r in bad.collect()} == {
        "x,1,2024-01-01,no number": "id is no bigint: x",
        "4,1,2024-02-30,no day": "day is no date: 2024-02-30",
        "5,1,2024-01-01": "not 4 fields",
        "6,1,2024-01-01,one,more": "not 4 fields",
        ",1,2024-01-01,no key": "id is missing",
        "": "not 4 fields",
        "99999999999999999999,1,,too large": "id is no bigint: 99999999999999999999",
    }
    # All lines but headers are in one of the two.
    assert good.count() + bad.count() == len(LINES) - 2


def test_one_pass_for_both(spark, lines, tmp_path):
    store = stored_in(str(tmp_path))
    checked = store("checked", checked_csv_lines(spark, lines, StructType.fromDDL(SCHEMA)))
    assert checked.where("reason IS NULL").select("row.*").count() == 4
    assert checked.where("reason IS NOT NULL").count() == 7
