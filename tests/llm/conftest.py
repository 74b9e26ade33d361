from __future__ import annotations

import os
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[2])
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

#: Columns that operators use for themselves, here as columns of the input.
CLASHING = "digest string, key string, node string, n string, part string, words string, text_hash string, keep_id string"


@pytest.fixture(autouse=True)
def few_partitions(settings):
    settings(shuffle__partitions="3")


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang), with extra columns of clashing names."""

    def make(rows, partitions=3):
        full = [
            (row[0], row[1], row[2] if len(row) > 2 else "en", None, None, *[None] * 8)
            for row in rows
        ]
        schema = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASHING}"
        return spark.createDataFrame(full, schema).repartition(partitions)

    return make


@pytest.fixture
def odd(documents):
    """Null ids and texts, empty, blank and long texts, rows that repeat, texts that differ little."""
    long = " ".join(f"word{i % 997} and{i % 13}" for i in range(30_000))
    return documents(
        [
            (1, None), (2, ""), (3, " \n\t"), (4, "one"), (4, "one"), (5, "one two three four"),
            (6, "One two three four"), (7, long), (8, long), (9, long + " end"), (None, "one"),
            (None, None), (10, "é" * 50), (11, "é" * 50 + "\n"), (12, "<|endoftext|> a <|endoftext|>"),
            (13, "mail a.b@c.de, +32 475 123 4567, 10.0.0.1 and 4111 1111 1111 1111"), (None, "one"),
        ]
    )


@pytest.fixture
def collected():
    def run(df, *columns):
        return sorted((tuple(row) for row in df.select(*columns or df.columns).collect()), key=repr)

    return run
