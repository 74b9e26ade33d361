from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from starloom.llm import hashing, jaccard_join
from starloom.llm.components import connected_components
from starloom.llm.jaccard_join import jaccard_groups, one_of_each_group


def shingles(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not w:
        return frozenset()
    return frozenset([tuple(w)] if len(w) < 5 else (tuple(w[i : i + 5]) for i in range(len(w) - 4)))


class Union:
    def __init__(self, items):
        self.parent = {x: x for x in items}

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def link(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.parent[b] = a


def expected(rows):
    sets = {doc: shingles(text) for doc, text in rows}
    union = Union(sets)
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            shared = len(sets[a] & sets[b])
            if sets[a] and 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                union.link(a, b)
    return sorted((doc, len(sets[doc]), union.find(doc)) for doc in ids)


def test_shingles_are_those_of_the_words():
    rng = random.Random(2)
    parts = ["a", "B", "b", " ", "\n", "é", "word ", "x y ", "\x0b", "\x85"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(1500)]
    before, hashing.SLICE = hashing.SLICE, 3000
    got = list(hashing.shingle_sets(pa.array(texts)))
    hashing.SLICE = before
    wanted = [shingles(t) for t in texts]
    assert [len(x) for x in got] == [len(x) for x in wanted]
    for _ in range(5000):
        i, j = rng.randrange(1500), rng.randrange(1500)
        assert len(np.intersect1d(got[i], got[j])) == len(wanted[i] & wanted[j])


def near_copies(rng, words, n, edits):
    for _ in range(n):
        copy = list(words)
        for _ in range(rng.randint(0, edits)):
            copy[rng.randrange(len(copy))] = f"new{rng.randrange(10**6)}"
        yield " ".join(copy)


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_against_all_pairs(documents, settings, collected, monkeypatch, threshold):
    settings(autoBroadcastJoinThreshold=threshold)
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(12):
        base = rng.choices(vocabulary, k=rng.randint(6, 150))
        texts += near_copies(rng, base, rng.choice([1, 2, 5]), max(1, len(base) // 25))
    # A large group of near copies, a line that most texts have, short texts, and a chain.
    texts += near_copies(rng, rng.choices(vocabulary, k=120), 90, 4)
    line = " ".join(rng.choices(vocabulary, k=30))
    texts += [f"{line} {' '.join(rng.choices(vocabulary, k=rng.randint(5, 60)))}" for _ in range(60)]
    texts += ["a b c", "A  b\tC", "a b", "a", "", None, "a b c d e", "a b c d e f"]
    long = [f"c{i}" for i in range(130)]
    texts += [" ".join(long[i : i + 100]) for i in range(0, 30, 6)]
    rows = list(enumerate(texts))
    monkeypatch.setattr(jaccard_join, "BROADCAST_ROWS", 10 if threshold == "-1" else 300_000)
    assert sorted(collected(jaccard_groups(documents(rows)))) == expected(rows)


def test_one_document_of_each_group_stays(documents):
    base = " ".join(f"w{i}" for i in range(60))
    docs = documents([(5, base), (3, base + " x"), (9, "other"), (None, None), (2, ""), (9, "other")])
    kept = one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted((repr(r.doc_id), r.text) for r in kept.collect() if r.text) == [
        ("3", base + " x"), ("9", "other"), ("9", "other"),
    ]


def test_odd_documents(odd, documents):
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard_groups(odd).collect()}
    assert {(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 5), (6, 1, 5), (None, 0, None)} <= got
    assert (None, 1, 4) in got
    assert {c for d, _, c in got if d in (7, 8, 9)} == {7}
    assert jaccard_groups(documents([])).collect() == []


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)]
    edges += [(1000 + i, 1001 + i) for i in range(40)] + [(2000, 2000 + i) for i in range(1, 60)]
    union = Union({x for edge in edges for x in edge})
    for a, b in edges:
        union.link(a, b)
    got = connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert {r.node: r.component for r in got} == {x: union.find(x) for x in linked}
    assert len(got) == len(linked)
