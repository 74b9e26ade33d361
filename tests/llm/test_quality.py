from __future__ import annotations

import math
import random
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest

from starloom.llm.common import stored
from starloom.llm.quality import (
    ORDER,
    SYMBOL_BITS,
    Lookup,
    corpus_grams,
    good_documents,
    grams,
    probabilities,
    quality,
)

GOOD = "the house stands near a river and people walk along green fields every morning".split()


def sentence(rng):
    return " ".join(rng.choices(GOOD, k=rng.randint(3, 30))).capitalize() + "."


def noise(rng):
    return "".join(rng.choices("QXZ&%$#!|", k=rng.randint(40, 200)))


def kneser_ney(trusted):
    """The textbook recursion over symbols as tuples."""

    def symbols(text):
        codes = [48 if "0" <= c <= "9" else max(1, ord(c)) for c in text]
        return [0] * (ORDER - 1) + codes

    counts = {ORDER: Counter()}
    for text in trusted:
        s = symbols(text)
        counts[ORDER].update(tuple(s[i : i + ORDER]) for i in range(len(text)))
    for n in range(ORDER - 1, 0, -1):
        counts[n] = Counter(gram[1:] for gram in counts[n + 1])
    discounts, totals, leftover = {}, {}, {}
    for n, table in counts.items():
        of = Counter(table.values())
        y = of[1] / (of[1] + 2 * of[2]) if of[1] else 0
        d = [k - (k + 1) * y * of[k + 1] / of[k] if of[k] else 0.5 * k for k in (1, 2, 3)]
        if not of[1]:
            d = [0.5] * 3
        else:
            d = [min(max(v, 0.05 * k), 0.95 * k) for k, v in zip((1, 2, 3), d)]
        discounts[n] = d
        totals[n], leftover[n] = defaultdict(int), defaultdict(float)
        for gram, c in table.items():
            totals[n][gram[:-1]] += c
            leftover[n][gram[:-1]] += d[min(c, 3) - 1]

    def p(gram):
        if not gram:
            return 1 / (1 << SYMBOL_BITS)
        n, lower = len(gram), p(gram[1:])
        if not totals[n][gram[:-1]]:
            return lower
        c = counts[n][gram]
        held = c - discounts[n][min(c, 3) - 1] if c else 0.0
        return (held + leftover[n][gram[:-1]] * lower) / totals[n][gram[:-1]]

    return p, symbols


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(12)
    return [sentence(rng) for _ in range(60)], [noise(rng) for _ in range(5)] + ["été 1234", "日本"]


def unpacked(gram):
    return tuple((gram >> (SYMBOL_BITS * (ORDER - 1 - k))) & ((1 << SYMBOL_BITS) - 1) for k in range(ORDER))


def test_probabilities_against_the_recursion(spark, texts):
    trusted, others = texts
    rows = spark.createDataFrame([(t, True) for t in trusted] + [(t, False) for t in others], "text string, trusted boolean")
    corpus = stored(corpus_grams(rows), "corpus")
    counted = {r.gram: r["count"] for r in corpus.collect()}
    found, _ = grams([*trusted, *others])
    assert set(counted) == set(found.tolist())
    assert sum(counted.values()) == sum(map(len, trusted))
    p, _ = kneser_ney(trusted)
    for r in probabilities(corpus).collect():
        assert r.log_p == pytest.approx(math.log(p(unpacked(r.gram))), rel=1e-5)


def test_probabilities_of_a_context_sum_to_one(texts):
    p, symbols = kneser_ney(texts[0])
    context = tuple(symbols(texts[0][0])[4 : 4 + ORDER - 1])
    assert sum(p((*context, w)) for w in range(1 << SYMBOL_BITS)) == pytest.approx(1)


def test_lookup():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**60, 5000))
    table = Lookup(keys[:4000], np.arange(4000, dtype=np.float32))
    asked = rng.permutation(keys)
    place = {k: i for i, k in enumerate(keys[:4000].tolist())}
    assert table.of(asked).tolist() == [float(place.get(k, 0)) for k in asked.tolist()]
    assert Lookup(keys[:0], np.zeros(0, np.float32)).of(keys).sum() == 0


def test_lookup_is_compact():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 2**60, 270_000))
    rng.shuffle(keys)
    values = np.arange(len(keys), dtype=np.float32)
    tracemalloc.start()
    table = Lookup(keys, values)
    held, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 22 * len(keys) and peak < 45 * len(keys)
    assert (table.of(keys) == values).all()
    absent = np.setdiff1d(rng.integers(0, 2**60, 10_000), keys)
    assert not table.of(absent).any()


def test_lookup_of_equal_hashes():
    class Few(Lookup):
        def _slots(self, keys):
            return (keys % 3 + 5).astype(np.int32)

    keys = np.arange(0, 80, 2)
    table = Few(keys, np.arange(1, 41, dtype=np.float32))
    assert table.of(np.arange(80)).tolist() == [k / 2 + 1 if k % 2 == 0 else 0 for k in range(80)]


@pytest.fixture(scope="module")
def case():
    rng = random.Random(3)
    rows = [(i, " ".join(sentence(rng) for _ in range(rng.randint(2, 6)))) for i in range(500)]
    rows += [(1000 + i, noise(rng)) for i in range(40)]
    labels = [(i, 1) for i in range(400)] + [(1000 + i, 0) for i in range(20)] + [(None, 1), (3, None)]
    return rows, labels


def test_rejects_noise_and_keeps_the_rest(spark, documents, case):
    rows, labels = case
    docs, marks = documents(rows), spark.createDataFrame(labels, "doc_id bigint, quality int")
    whole = {r.doc_id: r for r in quality(docs, marks).collect()}
    assert len(whole) == len(rows)
    assert sum(whole[i].kept for i in range(500)) >= 497
    assert not any(whole[1000 + i].kept for i in range(40))
    shards = {r.doc_id: r for r in quality(docs, marks, shard_entries=300).collect()}
    for i, r in whole.items():
        assert shards[i].perplexity == pytest.approx(r.perplexity, rel=1e-9)


def test_odd_documents(spark, odd, documents, case):
    rows, labels = case
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int")
    docs = odd.unionByName(documents(rows)).unionByName(documents([(2000, "People walk near the river every morning.", None)]))
    got = quality(docs, marks).collect()
    assert {r.kept for r in got if not r.chars} == {False}
    assert all(r.perplexity is None for r in got if not r.chars)
    distinct = docs.selectExpr("doc_id", "lang", "coalesce(text, '')").distinct().count()
    assert len(got) == distinct
    kept = good_documents(docs, marks)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} >= {2000} and kept.where("text is null").isEmpty()


def test_without_labels_or_rows(spark, odd, documents):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    got = quality(odd, none).collect()
    assert all(r.kept == bool(r.chars) and r.perplexity is None for r in got)
    some = spark.createDataFrame([(1, 1)], "doc_id bigint, quality int")
    assert quality(documents([]), some).collect() == []


def test_few_judges_and_several_languages(spark, documents):
    rng = random.Random(5)
    other = "maison rue jardin matin lumière fenêtre souvent pendant quelques arbres".split()
    rows = [(i, sentence(rng), "en") for i in range(60)]
    rows += [(100 + i, " ".join(rng.choices(other, k=rng.randint(3, 30))), "fr") for i in range(15)]
    rows += [(200 + i, noise(rng), ("en", "fr", "xx")[i % 3]) for i in range(12)]
    marks = spark.createDataFrame(
        [(i, 1) for i, _, _ in rows if i < 50 or 100 <= i < 112], "doc_id bigint, quality int"
    )
    got = {r.doc_id: r for r in quality(documents(rows), marks).collect()}
    assert all(got[i].kept for i, _, _ in rows if i < 50 or 100 <= i < 112)
    assert not any(got[200 + i].kept for i in range(12) if i % 3 < 2)
    # Nothing can be told of a language without trusted texts.
    assert all(got[200 + i].kept and got[200 + i].threshold is None for i in range(2, 12, 3))
