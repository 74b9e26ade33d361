from __future__ import annotations

from types import SimpleNamespace

import pytest

from starloom import workspace
from starloom.sinks.files import export_tables, write_json, write_table, write_text
from starloom.sources.files import (
    generate_dates,
    rows_with_schema,
    scan_csv,
    scan_csv_strings,
    scan_parquet,
    scan_text,
)


def test_csv_types(spark, tmp_path):
    path = tmp_path / "people.csv"
    path.write_text("id,name,hired\n1,Jane,2020-01-10\n2,Bob,2021-02-20\n")
    assert scan_csv(spark, str(path)).dtypes == [
        ("id", "int"), ("name", "string"), ("hired", "date"),
    ]
    assert {t for _, t in scan_csv_strings(spark, str(path)).dtypes} == {"string"}
    explicit = scan_csv(spark, str(path), "id bigint, name string, hired string")
    assert [t for _, t in explicit.dtypes] == ["bigint", "string", "string"]


def test_text_json_and_tables(spark, tmp_path, rows):
    df = rows_with_schema(spark, [(1, "a", None), (2, None, 2.5)], "i int, s string, d double")
    write_text(df, str(tmp_path / "text"))
    assert rows(scan_text(spark, str(tmp_path / "text"))) == [("1\ta\t",), ("2\t\t2.5",)]
    write_json(df, str(tmp_path / "edges.json"))
    assert rows(spark.read.schema(df.schema).json(str(tmp_path / "edges.json"))) == rows(df)
    write_table(df, "managed_rows")
    write_table(df, "managed_rows")
    assert rows(spark.table("managed_rows")) == rows(df)
    write_table(df, "placed_rows", path=str(tmp_path / "placed"))
    assert rows(scan_parquet(spark, str(tmp_path / "placed"), df.schema)) == rows(df)


def test_export(spark, tmp_path):
    frames = {"a": spark.range(3), "b": spark.range(5)}
    folders = export_tables(frames, frames.get, str(tmp_path) + "/")
    assert {n: scan_parquet(spark, p).count() for n, p in folders.items()} == {"a": 3, "b": 5}
    export_tables(frames, frames.get, str(tmp_path))
    assert scan_parquet(spark, folders["a"]).count() == 3


def test_generated_dates(spark):
    days = generate_dates(spark, "2024-02-28", "2024-03-01")
    assert [str(r.day) for r in days.orderBy("day").collect()] == [
        "2024-02-28", "2024-02-29", "2024-03-01",
    ]


def test_filters_and_columns_reach_the_files(spark, tmp_path, executed_plan):
    spark.range(10).selectExpr("id", "id * 2 AS twice", "'x' AS wide").write.parquet(
        str(tmp_path / "p")
    )
    plan = executed_plan(scan_parquet(spark, str(tmp_path / "p")).where("id > 5").select("id"))
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,5)]" in plan
    assert "ReadSchema: struct<id:bigint>" in plan


def test_shared_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert workspace.shared_folder(spark) == configured
    one, two = (workspace.new_folder(spark, "x") for _ in range(2))
    assert one != two and one.startswith(f"{configured}/x-")


def session(master, **conf):
    """What a session tells about its machines and folders."""
    settings = {f"spark.{key.replace('__', '.')}": value for key, value in conf.items()}
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)),
        sparkContext=SimpleNamespace(master=master),
    )


@pytest.mark.parametrize("master", ["yarn", "local[*]"])
def test_folder_without_a_setting(master):
    there = session(master, sql__warehouse__dir="hdfs://shared/warehouse")
    assert workspace.shared_folder(there) == "hdfs://shared/warehouse/starloom-work"


def test_a_cluster_needs_a_shared_folder():
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1000]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            workspace.shared_folder(session(master, sql__warehouse__dir="file:/home/me/spark-warehouse"))
    alone = session("local[8]", sql__warehouse__dir="file:/home/me/spark-warehouse")
    assert workspace.shared_folder(alone) == "file:/home/me/spark-warehouse/starloom-work"
    told = session("yarn", checkpoint__dir="/mnt/shared/", sql__warehouse__dir="file:/x")
    assert workspace.shared_folder(told) == "/mnt/shared"


def test_literal_rows_have_a_size(spark, rows):
    df = rows_with_schema(spark, [(1, "O'Neil", None), (2, None, 2.5)], "a int, b string, c double")
    assert df.dtypes == [("a", "int"), ("b", "string"), ("c", "double")]
    assert rows(df) == [(1, "O'Neil", None), (2, None, 2.5)]
    assert rows_with_schema(spark, [], "a int").collect() == []
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert int(str(size)) < 1000
