"""Every registered query against its SQL twin over the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
from check_oracle import comparable, oracle_rows
from starloom.workloads.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(FOLDER).exists(), reason="tables are not there")


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(ORACLES) <= set(entry.oracle_sql())


@needs_data
def test_flagship(spark):
    result = entry.entry(spark)
    assert result.columns == ["DayOfWeek", "revenue"]
    assert result.count() == 7


@needs_data
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    frame = entry.queries()[name](spark, FOLDER)
    got = [tuple(row) for row in frame.collect()]
    columns, expected = oracle_rows(FOLDER, entry.oracle_sql()[name])
    assert sorted(frame.dtypes) == sorted(columns)
    assert comparable(frame.columns, got) == comparable([c for c, _ in columns], expected)
