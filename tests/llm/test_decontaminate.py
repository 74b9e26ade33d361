from __future__ import annotations

import random
import re

import pytest

from starloom.llm import decontaminate
from starloom.llm.decontaminate import MASKS, drop_leaks, leaks, seeds

WORDS = [f"{a}{b}" for a in "ba be bi bo bu da de di do du".split() for b in "n m l r s t".split()]


@pytest.fixture(scope="module")
def case():
    rng = random.Random(8)
    items = [(i, " ".join(rng.choices(WORDS, k=rng.randint(15, 40)))) for i in range(20)]
    rows, wanted = [], set()
    for i in range(120):
        words = rng.choices(WORDS, k=rng.randint(0, 150))
        if i % 4 == 0:
            number, text = items[rng.randrange(20)]
            passage = text.split()
            if i % 8 == 0:
                for at in range(rng.randrange(5), len(passage), 6):
                    passage[at] = "other"
            at = rng.randint(0, len(words))
            words[at:at] = passage
            wanted.add((i, number))
        rows.append((i, " ".join(words).title().replace(" ", ", ", 3)))
    return items, rows, wanted


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


def test_leaks_with_substitutions(spark, documents, case):
    items, rows, wanted = case
    got = leaks(documents(rows), benchmark(spark, items)).collect()
    assert {(r.doc_id, r.item_id) for r in got} == wanted
    for r in got:
        assert r.similarity == r.matched / r.item_words
        if r.doc_id % 8:
            assert r.matched == r.item_words == r.stretch


def test_seeds_depend_on_the_words_under_the_ones(documents):
    words = [f"w{i}" for i in range(40)]
    at = 12
    changed = [*words[:at], "other", *words[at + 1 :]]
    rows = seeds(documents([(1, " ".join(words)), (2, " ".join(changed)), (3, "w0 w1")]), "doc_id")
    found = {i: [r.seed for r in rows.collect() if r.doc_id == i] for i in (1, 2, 3)}
    per_mask = [40 - len(mask) + 1 for mask in MASKS]
    assert len(set(found[1])) == len(found[1]) == sum(per_mask) and not found[3]
    ones = sum(mask.count("1") for mask in MASKS)
    assert len(set(found[1]) - set(found[2])) == ones


def test_a_long_part_of_an_item_is_a_leak(spark, documents):
    item = [f"word{i}" for i in range(60)]
    rows = [(1, " ".join(item[20:40])), (2, " ".join(item[20:30])), (3, " ".join(item[:13]))]
    got = leaks(documents(rows), benchmark(spark, [(1, " ".join(item))])).collect()
    assert sorted((r.doc_id, r.stretch) for r in got) == [(1, 20), (3, 13)]


def test_dropping_keeps_columns_and_clean_rows(spark, documents, case):
    items, rows, wanted = case
    docs = documents([*rows, (None, "clean"), (None, None)])
    kept = drop_leaks(docs, benchmark(spark, items))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - {i for i, _ in wanted} | {None}


def test_odd_inputs(spark, odd, documents):
    items = [(1, None), (2, ""), (3, "four words are few"), (None, "one two three four five"), (5, "x " * 30)]
    docs = documents([(1, "One two, three FOUR five six"), (1, "a"), (None, "one two three four five")])
    got = leaks(docs, benchmark(spark, items)).collect()
    assert sorted((repr(r.doc_id), r.item_id) for r in got) == [("1", None), ("None", None)]
    assert leaks(odd, benchmark(spark, [])).collect() == []
    assert leaks(documents([]), benchmark(spark, items)).collect() == []
    assert leaks(odd, benchmark(spark, [(9, "word1 and1 word2 and2 word3 and3")])).count() == 3


def naive_leaks(rows, items, threshold=0.8, min_words=13):
    """All diagonals on which a mask fits, word by word."""
    out = []
    for doc, text in rows:
        for item, passage in items:
            have, want = (re.findall(r"[^\W_]+", t.lower()) for t in (text, passage))
            diagonals = set()
            for mask in MASKS:
                ones = [k for k, bit in enumerate(mask) if bit == "1"]
                places = {}
                for j in range(len(want) - len(mask) + 1):
                    places.setdefault(tuple(want[j + k] for k in ones), []).append(j)
                for i in range(len(have) - len(mask) + 1):
                    diagonals |= {i - j for j in places.get(tuple(have[i + k] for k in ones), [])}
            matched = stretch = 0
            for d in diagonals:
                same = [have[j + d] == want[j] for j in range(len(want)) if 0 <= j + d < len(have)]
                matched = max(matched, sum(same))
                top, found = 0, 0
                for end in range(len(same)):
                    score, best, matches = 0, 0, 0
                    for start in range(end, -1, -1):
                        score += 1 if same[start] else -3
                        matches += same[start]
                        if score > best:
                            best, here = score, matches
                    if best > top:
                        top, found = best, here
                stretch = max(stretch, found)
            if want and (matched / len(want) >= threshold or stretch >= min_words):
                out.append((doc, item, matched, len(want), stretch))
    return sorted(out)


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_against_comparing_all_diagonals(spark, documents, limit, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", limit)
    rng = random.Random(11)
    items = [(i, " ".join(rng.choices(WORDS, k=rng.randint(4, 30)))) for i in range(8)]
    long = rng.choices(WORDS, k=1500)
    items.append((8, " ".join(long)))
    rows = []
    for i in range(40):
        words = rng.choices(WORDS, k=rng.randint(0, 40))
        source = rng.choice([text.split() for _, text in items])
        begin = rng.randrange(max(1, len(source) - 40))
        passage = list(source[begin : begin + rng.randint(5, 60)])
        for at in rng.sample(range(len(passage)), len(passage) // rng.choice([4, 6, 9, 50])):
            passage[at] = "other"
        at = rng.randint(0, len(words))
        rows.append((i, " ".join([*words[:at], *passage, *words[at:]])))
    rows.append((40, " ".join([*long, *long])))  # many hits on one text
    got = leaks(documents(rows), benchmark(spark, items)).collect()
    found = sorted((r.doc_id, r.item_id, r.matched, r.item_words, r.stretch) for r in got)
    # The long text against the long item is compared by what must come out of it.
    assert [r for r in found if r[0] == 40 and r[1] == 8] == [(40, 8, 1500, 1500, 1500)]
    assert [r for r in found if r[0] != 40] == naive_leaks(rows[:-1], items)
