from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from starloom.llm import lexical_search
from starloom.llm.lexical_search import Block, ranked_search, terms_of, weight

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def terms(text):
    return [t.translate(LOWER) for t in TERM.findall(text or "")]


def expected(docs, items, best=50):
    """Every document against every item."""
    counts = [(doc, Counter(terms(text))) for doc, text in docs]
    sizes = [sum(c.values()) for _, c in counts]
    n, length = sum(s > 0 for s in sizes), sum(sizes)
    holding = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for (doc, c), size in zip(counts, sizes):
            if size:
                m = 100 - 50 + (50 * size * n) // length
                score = sum(
                    math.floor(1000 * math.log((2 * n + 2) / (2 * holding[t] + 1)))
                    * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in set(terms(text)) & set(c)
                )
                if score > 0:
                    found.append((-score, doc is not None, doc))
        found.sort(key=lambda f: (f[0], f[1], f[2] or 0))
        out += [(item, rank, doc, -s) for rank, (s, _, doc) in enumerate(found[:best], 1)]
    return sorted(out, key=repr)


@pytest.fixture
def items(spark):
    def make(rows):
        schema = "item_id bigint, text string, rank string, score string, item string"
        return spark.createDataFrame([(*row, None, None, None) for row in rows], schema)

    return make


def prose(rng, n):
    """Few words, so that many documents share a mask and a score."""
    return " ".join(rng.choice("Alpha beta GAMMA, delta. épée naïve x1 42 Öl").lower()
                    if rng.random() < 0.02 else f"W{int(rng.paretovariate(0.6)) % 60}"
                    for _ in range(n))


def test_terms():
    assert [t.decode() for t in terms_of("Ab-C_é1 ÀB\x00d e\x7f^f")] == [
        "ab", "c", "é1", "Àb", "d e", "f",
    ]
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(chr(rng.choice([rng.randrange(300), rng.randrange(0xD800)])) for _ in range(40))
        assert [t.decode() for t in terms_of(text)] == terms(text)
    assert terms_of(None) == terms_of("") == []


@pytest.mark.parametrize("terms_per_pass", [1 << 14, 20])
def test_against_all_pairs(documents, items, collected, terms_per_pass):
    rng = random.Random(7)
    docs = [(i, prose(rng, rng.randint(0, 30))) for i in range(900)]
    docs += [(2000 + i, docs[5][1]) for i in range(120)]
    queries = [(i, prose(rng, rng.randint(0, 12))) for i in range(15)] + [(3, docs[5][1])]
    got = ranked_search(documents(docs, 5), items(queries), terms_per_pass=terms_per_pass)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert collected(got) == expected(docs, queries)


def test_small_blocks_and_few_best(documents, items, collected, monkeypatch):
    monkeypatch.setattr(lexical_search, "CELLS", 64)
    rng = random.Random(8)
    docs = [(i, prose(rng, rng.randint(1, 20))) for i in range(400)]
    queries = [(i, prose(rng, 8)) for i in range(10)]
    got = ranked_search(documents(docs, 2), items(queries), best=3)
    assert collected(got) == expected(docs, queries, 3)


def test_a_block_ends_early_and_loses_nothing():
    """Rare terms settle most masks; the scores found are those of all documents of the block."""
    rng = np.random.default_rng(4)
    n, width = 3000, 80
    times = rng.poisson(np.linspace(0.01, 1.5, width)[:, None], (width, n))
    ends = np.append(0, np.cumsum((times > 0).sum(0)))
    docs, numbers = np.nonzero(times.T)
    block = Block(list(range(n)), times.sum(0), ends, numbers, times.T[docs, numbers].astype(np.int64),
                  width, n, int(times.sum()))
    item = np.sort(rng.choice(width, 70, False))
    weights = np.array([weight(n, int((times[t] > 0).sum())) for t in item])
    members, points, scored = block.best(item, weights, 50, 1)
    every = weights @ block.counted[item].astype(np.int64)
    least = np.sort(every)[-50]
    assert sorted(points.tolist()) == sorted(every[every >= least].tolist())
    assert (every[members] == points).all() and set(np.flatnonzero(every >= least)) == set(members)
    assert scored < n
    rare = item[:12]
    assert block.best(rare, weights[:12], 50, 1)[2] < n / 4
    # A worst leader of earlier blocks shuts all masks out.
    assert block.best(item, weights, 50, int(every.max()) * 10)[2] == 0


def test_masks_of_many_terms_group_documents():
    """More than 64 terms, with documents of the same mask."""
    rng = np.random.default_rng(5)
    kinds = rng.random((7, 130)) < 0.3
    there = kinds[rng.integers(0, 7, 500)]
    docs, numbers = np.nonzero(there)
    ends = np.append(0, np.cumsum(there.sum(1)))
    block = Block(list(range(500)), there.sum(1), ends, numbers, np.ones(len(docs), np.int64), 130, 500,
                  int(there.sum()))
    masks, members, first = block.masks(np.arange(130))
    assert len(masks) == len(np.unique(there, axis=0)) == 7 and len(members) == 500
    for mask, begin, end in zip(masks, first, np.append(first[1:], 500)):
        assert (there[members[begin:end]] == mask).all()


def test_odd_documents(odd, items, collected):
    docs = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    queries = [(1, "one and two"), (2, None), (3, ""), (None, "word5 a"), (4, " \n"), (1, "one and two")]
    assert collected(ranked_search(odd, items(queries))) == expected(docs, queries)


def test_no_rows(documents, items):
    assert ranked_search(documents([]), items([(1, "a")])).collect() == []
    assert ranked_search(documents([(1, "a"), (2, None)]), items([])).collect() == []
    assert ranked_search(documents([(1, "")]), items([(1, "a")])).collect() == []
