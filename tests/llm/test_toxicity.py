from __future__ import annotations

import random

import pytest

from starloom.llm.toxicity import Lexicon, Matcher, folded, learn, toxicity

PLAIN = "the house stands near river and people walk along green fields every morning".split()


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(600):
        words = rng.choices(PLAIN, k=rng.randint(5, 60))
        toxic = int(i % 5 == 0)
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["moron", "M0RON", "mоrоn", "scumbag"]))
        if i % 7 == 0 and not toxic:
            words.insert(rng.randrange(len(words)), "moron detector")
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    return rows, labels


def test_folding():
    assert folded("1D10T $tupid p@th ＡＢ сat") == "idiot stupid path ab cat"


def test_matching_and_exceptions():
    found = Matcher(Lexicon({"idio": 3.0, "scum ": 2.0}, ["idiot proof"]))
    assert [h[2] for h in found.hits("idiots scum scummy video idiot proof")] == ["idio", "scum"]
    assert found.hits("") == []


def test_learned_scores(spark, documents, corpus):
    rows, labels = corpus
    known = spark.createDataFrame(labels[:400], "doc_id bigint, label int")
    lexicon = learn(documents(rows[:400]), known)
    assert "moron " in lexicon.weights or "moron" in lexicon.weights
    assert "moron detector" in lexicon.exceptions
    scored = {r.doc_id: r.score for r in toxicity(documents(rows[400:]), lexicon).collect()}
    wrong = [i for i, toxic in labels[400:] if (scored[i] >= 0.5) != bool(toxic)]
    assert len(wrong) <= 2
    assert all(0 <= s <= 1 for s in scored.values())


def test_odd_documents_and_labels(spark, odd, documents, corpus):
    rows, labels = corpus
    more = [*labels, (None, 1), (5000, 0), (1, None)]
    lexicon = learn(documents([*rows, (700, None)]), spark.createDataFrame(more, "doc_id bigint, label int"))
    got = toxicity(odd, lexicon).collect()
    assert len(got) == odd.count()
    assert all(r.score < 0.5 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2)}) == 1


def test_nothing_to_learn_from(spark, odd, documents):
    empty = spark.createDataFrame([], "doc_id bigint, label int")
    lexicon = learn(odd, empty)
    assert {r.score for r in toxicity(odd, lexicon).collect()} == {0.0}
    assert toxicity(documents([]), lexicon).collect() == []


def naive_hits(lexicon, text):
    """Every entry at every place."""
    def found(entry, whole):
        for begin in range(len(text)):
            end = begin + len(entry)
            if not text.startswith(entry, begin) or begin and text[begin - 1].isalnum():
                continue
            if not (whole and end < len(text) and text[end].isalnum()):
                yield begin, end

    spared = [span for phrase in lexicon.exceptions for span in found(phrase, True)]
    return sorted(
        (b, e, entry.rstrip(), weight)
        for entry, weight in lexicon.weights.items()
        for b, e in found(entry.rstrip(), entry[-1] == " ")
        if not any(c <= b and e <= d for c, d in spared)
    )


def test_matches_are_those_of_a_naive_search():
    rng = random.Random(6)
    for _ in range(400):
        words = ["".join(rng.choices("abé", k=rng.randint(1, 4))) for _ in range(12)]
        entries = {w + rng.choice(["", " "]): rng.uniform(1, 4) for w in rng.sample(words, 4)}
        entries = {w: v for w, v in entries.items() if not (w[-1] == " " and w[:-1] in entries)}
        lexicon = Lexicon(entries, [" ".join(rng.choices(words, k=2)) for _ in range(3)])
        lexicon.exceptions = [p for p in lexicon.exceptions if p not in entries and p + " " not in entries]
        text = " ".join(rng.choices(words, k=40))
        assert sorted(Matcher(lexicon).hits(text)) == naive_hits(lexicon, text)


def test_a_rich_lexicon_is_kept_whole(spark, documents):
    """More than a thousand toxic words, some of them very long."""
    rng = random.Random(8)
    bad = ["".join(rng.choices("bcdfghjklmnpqrtvwxyz", k=rng.choice([9, 12, 45]))) for _ in range(2200)]
    rows = [(i, " ".join(rng.choices(PLAIN, k=30) + (rng.sample(bad, 90) if i % 2 else []))) for i in range(900)]
    marks = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id bigint, label int")
    lexicon = learn(documents(rows, 8), marks)
    scores = Matcher(lexicon)
    found = {word for word in bad if scores.hits(word)}
    assert len(lexicon.weights) > 1000 and len(found) > 0.8 * len(bad)
    assert {len(word) for word in found} == {9, 12, 45}


def test_rows_that_share_a_labelled_id(spark, documents, corpus):
    rows, labels = corpus
    marks = spark.createDataFrame(labels[:400], "doc_id bigint, label int")
    once = learn(documents(rows[:400]), marks)
    again = learn(documents(rows[:400] + [rows[0]] * 300 + [rows[5]] * 300), marks)
    assert (again.weights, again.exceptions) == (once.weights, once.exceptions)
    assert again.logistic == pytest.approx(once.logistic)
