from __future__ import annotations

from collections import Counter

import pytest

from starloom.plans.words import (
    letter_count,
    top_words,
    word_count,
    words,
    write_word_and_letter_counts,
)
from starloom.sources.files import scan_text

LINES = ["the cat  The hat", "", "  the end ", "été Été\tx", "end"]


@pytest.fixture
def text(spark):
    return spark.createDataFrame([(line,) for line in LINES], "value string")


def test_words_split_on_single_spaces(text, rows):
    expected = [w for line in LINES for w in line.split(" ")]
    assert [r[0] for r in rows(words(text))] == sorted(expected, key=lambda w: repr((w,)))
    assert Counter(dict(map(tuple, word_count(text).collect()))) == Counter(expected)
    no_empty = dict(map(tuple, word_count(text, keep_empty=False).collect()))
    assert no_empty == dict(Counter(w for w in expected if w))


def test_letters(text):
    expected = Counter(w[0] for line in LINES for w in line.split(" ") if w)
    assert dict(map(tuple, letter_count(word_count(text)).collect())) == dict(expected)


def test_top_words_fold_case_and_break_ties(text):
    got = [tuple(r) for r in top_words(text, limit=3).collect()]
    assert got == [("the", 3), ("end", 2), ("cat", 1)]


def test_both_outputs(spark, text, tmp_path):
    paths = [str(tmp_path / name) for name in ("words", "letters")]
    persisted = spark.sparkContext._jsc.getPersistentRDDs
    before = set(persisted())
    write_word_and_letter_counts(text, *paths)
    letters = {r.value for r in scan_text(spark, paths[1]).collect()}
    assert {"t\t2", "T\t1", "é\t1"} <= letters
    assert scan_text(spark, paths[0]).count() == 7
    assert set(persisted()) <= before


def test_counting_is_two_stages(text, executed_plan):
    plan = executed_plan(word_count(text)).split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_count" in plan
