from __future__ import annotations

import random
import re

import pytest

from starloom.llm.license_scan import LONG, STRIDE, TEMPLATES, WINDOW, bands, license_matches

PLAIN = "the house stands near river and people walk along green fields every morning".split()


def shingles(text):
    w = re.findall("[a-z0-9]+", (text or "").lower())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def expected(rows, templates):
    out = set()
    for doc, text in rows:
        for name, notice in templates.items():
            shared, size = len(shingles(notice) & shingles(text)), len(shingles(notice))
            if shared >= 0.8 * size:
                out.add((doc, name, shared, size))
    return out


def test_against_all_pairs(documents):
    rng = random.Random(4)
    rows = []
    for i in range(300):
        words = rng.choices(PLAIN, k=rng.randint(0, 200))
        if i % 3 == 0:
            notice = rng.choice(list(TEMPLATES.values())).split()
            if i % 2 and len(notice) > 15:
                notice[rng.choice([0, 1, len(notice) - 1])] = "Changed"
            at = rng.randint(0, len(words))
            words[at:at] = notice
        rows.append((i, " ".join(words)))
    got = license_matches(documents(rows)).collect()
    assert {(r.doc_id, r.license, r.shared, r.template_size) for r in got} == expected(rows, TEMPLATES)
    assert len(got) > 60 and all(r.containment == r.shared / r.template_size for r in got)


def test_every_template_at_every_place(documents):
    """Before, within and at the end of a text, at all offsets of the windows."""
    rng = random.Random(9)
    rows, of = [], {}
    for name, notice in TEMPLATES.items():
        for before in range(0, 70):
            for after in (0, 3):
                of[len(rows)] = name
                text = rng.choices(PLAIN, k=before) + [notice] + rng.choices(PLAIN, k=after)
                rows.append((len(rows), " ".join(text)))
    got = {(r.doc_id, r.license): r.shared for r in license_matches(documents(rows)).collect()}
    for doc, name in of.items():
        assert got[doc, name] == len(shingles(TEMPLATES[name]))
    assert {(d, n) for d, n, *_ in expected(rows, TEMPLATES)} == set(got)


def test_changed_licenses(documents):
    """Full licenses with changed, lost and inserted words, near and beyond the threshold."""
    rng = random.Random(10)
    long = [n for n in TEMPLATES.values() if len(shingles(n)) >= LONG]
    assert len(long) >= 2
    rows = []
    for i in range(300):
        notice = rng.choice(long).split()
        for _ in range(rng.randint(0, 10)):
            at = rng.randrange(len(notice))
            notice[at : at + rng.randint(0, 2)] = rng.choices(PLAIN, k=rng.randint(0, 2))
        if i % 4 == 0:  # a part of it only
            notice = notice[: int(len(notice) * rng.uniform(0.7, 0.95))]
        rows.append((i, " ".join(rng.choices(PLAIN, k=rng.randint(0, 90)) + notice)))
    got = {(r.doc_id, r.license, r.shared, r.template_size) for r in license_matches(documents(rows)).collect()}
    assert got == expected(rows, TEMPLATES) and len(got) > 100


def test_windows_cover_every_shingle_twice(spark):
    for n in (WINDOW, WINDOW + 1, 3 * WINDOW + 7, 500):
        starts = sorted({*range(0, n - WINDOW + 1, STRIDE), n - WINDOW})
        times = [sum(p <= i < p + WINDOW for p in starts) for i in range(n)]
        assert min(times) >= 1 and min(times[STRIDE : n - STRIDE], default=2) >= min(2, len(starts))
        hashes = spark.range(n).selectExpr("sort_array(collect_list(xxhash64(id))) AS h").selectExpr("shuffle(h, 1) AS hashes")
        values = hashes.select("hashes", bands().alias("bands")).first()
        wanted = 0
        for p in starts:
            least = {}
            for v in values.hashes[p : p + WINDOW]:
                bin_ = (v & (1 << 64) - 1) >> 60
                least[bin_] = min(v, least.get(bin_, v))
            wanted += sum(b in least and b + 1 in least for b in range(0, 16, 2))
        assert len(values.bands) == wanted


def test_several_passes(documents):
    rows = [(i, text) for i, text in enumerate(TEMPLATES.values())]
    one, many = (license_matches(documents(rows), per_pass=n) for n in (100, 3))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))


def test_odd_documents(odd, documents):
    assert license_matches(odd).collect() == []
    mit = TEMPLATES["MIT"]
    rows = [(None, mit), (1, mit + " " + "x " * 200_000), (1, "a " * 100_000 + mit.upper()), (2, None)]
    got = license_matches(documents(rows)).collect()
    assert sorted((repr(r.doc_id), r.license) for r in got) == [("1", "MIT"), ("None", "MIT")]


def test_no_rows_and_short_templates(documents):
    assert license_matches(documents([])).collect() == []
    with pytest.raises(ValueError, match="less than 5 words"):
        license_matches(documents([]), {"short": "only four words here"})
