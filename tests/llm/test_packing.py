from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starloom.llm import packing
from starloom.llm.packing import (
    best_fit,
    packed_documents,
    packing_digests,
    packing_plan,
    places,
    ranked,
)

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("n", [0, 1, 40, 5000])
def test_plan_uses_each_piece_once_and_few_sequences(n):
    rng = np.random.default_rng(n)
    lengths = np.clip(rng.lognormal(4, 1, n).astype(int), 1, 512)
    counts = np.bincount(lengths, minlength=513)
    used = np.zeros(513, int)
    plan = packing_plan(counts)
    for lengths_of_one, number in plan:
        assert sum(lengths_of_one) <= 512 and number > 0
        for length in lengths_of_one:
            used[length] += number
    assert (used == counts).all()
    least = -(-int(lengths.sum()) // 512)
    assert sum(number for _, number in plan) <= least * 1.01 + 2
    assert sum(number for _, number in best_fit(counts)) <= least * 1.02 + 2


def test_the_plan_does_not_grow_with_the_number_of_documents():
    counts = np.bincount(np.clip(np.random.default_rng(1).lognormal(4, 1, 5000).astype(int), 1, 512), minlength=513)
    assert len(places(packing_plan(counts * 1_000_000))["key"]) < 40 * 512


def test_sequences_hold_the_documents(odd):
    rows = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    got = packed_documents(odd, PATH, capacity=64).collect()
    sequences = {}
    for r in got:
        assert r.length == len(r.ids) // 4 <= 64 and r.start == 64 * r.piece
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    texts = {}
    for doc, text in rows:
        texts.setdefault(doc, []).append(ids_of(text))
    for doc, wanted in texts.items():
        pieces = sorted((r.piece, bytes(r.ids)) for r in got if r.doc_id == doc)
        if len(wanted) == 1:
            whole = np.frombuffer(b"".join(ids for _, ids in pieces), "<u4").tolist()
            assert whole == wanted[0]
        else:
            assert sum(len(ids) // 4 for _, ids in pieces) == sum(map(len, wanted))


def test_digests(documents):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(["cat", "dog", "zebra"], k=rng.randint(0, 90)))) for i in range(60)]
    got = packing_digests(documents(rows), PATH, capacity=50).collect()
    expected = set()
    for doc, text in rows:
        ids = np.array(ids_of(text), "<u4")
        for at in range(0, len(ids), 50):
            part = ids[at : at + 50]
            expected.add((doc, at // 50, at, len(part), zlib.crc32(part.tobytes())))
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == expected
    assert len(got) == len(expected)


def test_no_rows(documents):
    assert packing_digests(documents([]), PATH).collect() == []


def test_ranks_of_a_hot_length_are_counted_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK_ROWS", 10)
    pieces = spark.range(3000).selectExpr("id AS doc_id", "0 AS piece", "if(id % 3 = 0, 7L, id % 50 + 100) AS length")
    sizes = pieces.groupBy("length").count().withColumnRenamed("count", "n")
    numbered = ranked(pieces, sizes)
    ranks = {}
    for r in numbered.collect():
        ranks.setdefault(r.length, []).append(r.rank)
    assert len(ranks) == 51 and len(ranks[7]) == 1000
    assert all(sorted(found) == list(range(len(found))) for found in ranks.values())
    # The hot length is not in order of its ids as a whole, but within each of some 100 blocks.
    hot = [r.doc_id for r in numbered.where("length = 7").orderBy("rank").collect()]
    assert 80 <= sum(a > b for a, b in zip(hot, hot[1:])) + 1 <= 100
