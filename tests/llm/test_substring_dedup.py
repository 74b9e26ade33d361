from __future__ import annotations

import random

import pyarrow as pa

from starloom.llm import hashing
from starloom.llm.common import QUERIES
from starloom.llm.substring_dedup import repeated_spans, without_repeats


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdeghilmnorstuü", k=rng.randint(2, 9))) for _ in range(n))


def test_chunks_cover_the_text_and_resist_shifts():
    rng = random.Random(1)
    passage = prose(rng, 200)
    texts = [passage, prose(rng, 37) + passage, "", "a", "é" * 3000, passage.replace(" ", "  ", 1)]
    hashing_slice, hashing.SLICE = hashing.SLICE, 500
    found = list(hashing.chunks(pa.array(texts)))
    hashing.SLICE = hashing_slice
    for text, (starts, ends, _) in zip(texts, found):
        data = text.encode()
        assert b"".join(data[a:b] for a, b in zip(starts, ends)) == data
        assert "".join(data[a:b].decode() for a, b in zip(starts, ends)) == text
    first, second = set(found[0][2].tolist()), set(found[1][2].tolist())
    assert len(first & second) >= len(first) - 4
    assert len(first & set(found[5][2].tolist())) >= len(first) - 4


def test_passages_of_fifty_words_are_found_and_clean_texts_left(documents):
    rng = random.Random(6)
    rows, planted = [], {}
    for p in range(40):
        passage = prose(rng, 52)
        for k in range(rng.choice([2, 3, 9])):
            doc = len(rows)
            before = prose(rng, rng.randint(0, 80))
            rows.append((doc, f"{before} {passage} {prose(rng, rng.randint(0, 80))}"))
            planted[doc] = (len(before.encode()), p, k)
    clean = range(len(rows), len(rows) + 60)
    line = prose(rng, 10)
    rows += [(i, f"{prose(rng, 90)}\n{line}\n{prose(rng, 50)}") for i in clean]
    got = repeated_spans(documents(rows)).collect()
    assert {r.doc_id for r in got} == set(planted)
    for r in got:
        begin, passage, k = planted[r.doc_id]
        assert begin - 60 <= r.start < r.end <= begin + 1000
        assert planted[r.first_doc_id][1:] == (passage, 0)
    left = {r.doc_id: r.text for r in without_repeats(documents(rows)).collect()}
    for doc, text in rows:
        if doc in planted and planted[doc][2]:
            assert len(left[doc]) < len(text) - 100
        else:
            assert left[doc] == text


def test_odd_documents(odd, documents):
    got = {(r.doc_id, r.first_doc_id): r for r in repeated_spans(odd).collect()}
    assert set(got) == {(7, 7), (8, 7), (9, 7)}
    assert got[8, 7].start == 0 and got[8, 7].end == got[7, 7].end
    assert repeated_spans(documents([])).collect() == []
    same = "one passage of some length that stands in one document only " * 5
    assert repeated_spans(documents([(1, same), (1, same), (None, same)])).collect() == []
    assert without_repeats(odd).count() == odd.count()


def test_each_of_two_adjoining_passages_survives(documents):
    rng = random.Random(7)
    first, second = prose(rng, 60), prose(rng, 60)
    rows = [
        (5, f"{prose(rng, 40)} {first} {prose(rng, 40)}"),
        (10, f"{prose(rng, 30)} {first} {second} {prose(rng, 30)}"),
        # With the end of the first one, so that the chunk over the border is repeated too.
        (20, f"{prose(rng, 20)} {first[-100:]} {second} {prose(rng, 20)}"),
    ]
    docs = documents(rows)
    spans = {(r.doc_id, r.first_doc_id) for r in repeated_spans(docs).collect()}
    assert spans == {(5, 5), (10, 5), (10, 10), (20, 10)}
    left = {r.doc_id: r.text for r in without_repeats(docs).collect()}
    assert first in left[5] and first not in left[10]
    assert second[60:] in left[10] and second not in left[20]
    # Every chunk of the texts is still somewhere.
    kept = "\n".join(left.values()).encode()
    for text, (starts, ends, _) in zip([t for _, t in rows], hashing.chunks(pa.array([t for _, t in rows]))):
        assert all(text.encode()[a:b] in kept for a, b in zip(starts, ends))


def test_passages_repeated_within_one_document(documents):
    rng = random.Random(8)
    passage = prose(rng, 60)
    parts = [prose(rng, 40), passage, prose(rng, 30), passage, prose(rng, 20)]
    rows = [(1, " ".join(parts)), (1, " ".join(parts)), (2, prose(rng, 200))]
    docs = documents(rows)
    first, second = sorted(repeated_spans(docs, within=True).collect(), key=lambda r: r.start)
    assert (first.doc_id, first.first_doc_id, first.keep) == (1, 1, True)
    assert (second.doc_id, second.first_doc_id, second.keep) == (1, 1, False)
    left = without_repeats(docs, within=True).collect()
    assert len(left) == 3
    for r in left:
        text = rows[r.doc_id][1]
        if r.doc_id == 1:
            assert r.text.count(passage) == 1 and len(r.text) < len(text) - 100
        else:
            assert r.text == text


def test_query_counts_places(spark, documents, tmp_path):
    rng = random.Random(9)
    passage = prose(rng, 60)
    documents([(1, f"{passage} {prose(rng, 30)} {passage}")]).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op6_substring_dedup"](spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.keep) for r in got) == [(1, False), (1, True)]


def naive_chunks(data, rate=10, least=10):
    """The chunks of a text, byte by byte."""
    gear = [int(x) >> 16 & 0xFFFFFFFF for x in hashing._BYTES]
    rolled, last, starts = 0, -least, [0]
    for i, byte in enumerate(data):
        rolled = ((rolled << 1) + gear[byte]) & 0xFFFFFFFF
        if rolled < 2**32 // rate:
            if i - last >= least:
                start = i + 1
                while start < len(data) and data[start] & 0xC0 == 0x80:
                    start += 1
                if start < len(data):
                    starts.append(start)
            last = i
    return list(zip(starts, [*starts[1:], len(data)]))


def naive_spans(rows, min_bytes):
    """(doc_id, start, end, first_doc_id, keep) as ``repeated_spans`` with ``within``, by comparing
    the chunks themselves."""
    chunked = {doc: [(a, b, text.encode()[a:b]) for a, b in naive_chunks(text.encode())] for doc, text in rows}
    places = {}
    for doc in sorted(chunked):
        for a, b, chunk in chunked[doc]:
            places.setdefault(chunk, []).append((doc, a))
    out = []
    for doc, found in chunked.items():
        run = []
        for a, b, chunk in [*found, (None, None, None)]:
            if chunk is not None and len(places[chunk]) > 1:
                first = min(places[chunk])
                run.append((a, b, first[0], first == (doc, a)))
                continue
            cut = []
            for a, b, first, keep in run:
                if cut and cut[-1][3] == keep:
                    cut[-1] = (cut[-1][0], b, min(cut[-1][2], first), keep)
                else:
                    cut.append((a, b, first, keep))
            for keep in (True, False):
                size = sum(b - a for a, b, _, k in cut if k) if keep else run[-1][1] - run[0][0] if run else 0
                out += [(doc, *span) for span in cut if span[3] == keep and size >= min_bytes]
            run = []
    return sorted(out)


def test_spans_against_comparing_all_chunks(documents):
    rng = random.Random(10)
    passages = [
        "".join(rng.choices("日本語の文章éü😀 ", k=rng.randint(60, 200))) if p % 2 else prose(rng, 50)
        for p in range(8)
    ]
    rows = []
    for doc in range(60):
        parts = [prose(rng, rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(passages), "".join(rng.choices("é日 😀", k=rng.randint(0, 30)))]
        rows.append((doc, " ".join(parts)))
    got = repeated_spans(documents(rows), min_bytes=60, within=True).collect()
    spans = sorted((r.doc_id, r.start, r.end, r.first_doc_id, r.keep) for r in got)
    assert spans == naive_spans(rows, 60)
    data = dict((doc, text.encode()) for doc, text in rows)
    for doc, start, end, _, _ in spans:
        data[doc][start:end].decode()  # fails if a border is inside a character
    gone = {doc: [s for s in spans if s[0] == doc and not s[4]] for doc in data}
    left = {r.doc_id: r.text for r in without_repeats(documents(rows), 60, within=True).collect()}
    for doc in data:
        kept, at = [], 0
        for _, start, end, _, _ in gone[doc]:
            kept.append(data[doc][at:start])
            at = end
        assert left[doc] == b"".join([*kept, data[doc][at:]]).decode()
