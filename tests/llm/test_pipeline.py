from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from starloom.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(FOLDER).exists(), reason="tables are not there")


def test_every_operator_has_a_query():
    numbers = {int(name[2:].split("_")[0]) for name in QUERIES}
    assert numbers == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


@needs_data
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_and_its_twin(spark, name):
    from check_oracle import comparable, oracle_rows

    frame = QUERIES[name](spark, FOLDER)
    got = [tuple(row) for row in frame.collect()]
    columns, expected = oracle_rows(FOLDER, ORACLES[name])
    assert sorted(frame.dtypes) == sorted(columns)
    assert comparable(frame.columns, got) == comparable([c for c, _ in columns], expected)


@needs_data
def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, FOLDER)
        if name != "packing":
            assert made.columns == docs.columns
        made.write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        assert kept[name] <= {r.doc_id for r in before.select("doc_id").collect()}
    assert kept["packing"] == kept["decontamination"]
    good = duckdb.sql(f"SELECT doc_id FROM '{FOLDER}/labels.parquet' WHERE quality = 1").fetchall()
    assert len(kept["quality"] & {d for d, in good}) >= 0.98 * len(good)
    # What is left has neither equal texts nor whole items of the benchmark.
    texts = [r.text for r in spark.read.parquet(str(tmp_path / "decontamination")).collect()]
    assert len(set(texts)) == len(texts)
    items = duckdb.sql(f"SELECT text FROM '{FOLDER}/benchmark.parquet'").fetchall()
    assert not any(item in text for item, in items for text in texts)
