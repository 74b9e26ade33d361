"""Toxicity by a weighted lexicon that is learned from labels.

Texts are folded first: lower case, compatibility forms, homoglyphs of other scripts, digits and
signs that stand for letters. The lexicon holds stems and whole words of folded text; an entry's
weight is its log-odds between toxic and other documents, and it is taken only if its
log-likelihood ratio is beyond what chance gives for as many candidates. A stem counts where a
word begins. An Aho-Corasick automaton finds all entries in one pass over a whole text; a hit
inside an exception phrase (a hit and a neighbouring word that were seen in other documents) does not
count. A score is a logistic function of the strongest weight, the sum of the weights and that sum
normalised by length.

``fit_rows`` bounds the labelled rows from which everything is learned: those with the smallest
hash of their id. Scoring reads every row and every whole text.

A null text counts as empty; an empty text has the score of a text without hits. Labelled rows
without a text or a label are not learned from. Each row gives one row, repeated ones too; null ids
stay null. Without labels of both kinds nothing can be learned: every score is 0. An empty table
gives no rows.
"""

from __future__ import annotations

import math
import re
import unicodedata
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from starloom.llm.common import by_batch, query, stored, table, texts

# Letters of other scripts that look like Latin ones, and digits that stand for
# letters.
HOMOGLYPHS = dict(zip("авеёкмнорстухіјѕԁɡαβεικνορτυχ", "abeekmhopctyxijsdgabeikvoptux"))
DIGITS = dict(zip("0134578", "oieastb"))
_SIGNS = re.compile(r"[@$](?=[^\W\d_])")
_FOLD = str.maketrans(HOMOGLYPHS | DIGITS)
_WORD = re.compile(r"[^\W_]+")
STEMS = range(3, 11)


def folded(text: str) -> str:
    """Text as the lexicon sees it. Positions may change."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = text.lower()
    if "@" in text or "$" in text:
        text = _SIGNS.sub(lambda m: "a" if m[0] == "@" else "s", text)
    return text.translate(_FOLD)


@dataclass
class Lexicon:
    """Weights of entries (a whole word ends with a space) and of exception phrases, and the
    logistic function: bias, strongest weight, sum of weights, sum by length."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    logistic: tuple[float, ...] = ()


class Matcher:
    """Finds the entries of a lexicon in folded text."""

    def __init__(self, lexicon: Lexicon):
        import ahocorasick

        self.lexicon = lexicon
        self.automaton = ahocorasick.Automaton()
        for entry, weight in lexicon.weights.items():
            self.automaton.add_word(entry.rstrip(), (entry.rstrip(), entry[-1] == " ", weight))
        for phrase in lexicon.exceptions:
            self.automaton.add_word(phrase, (phrase, True, None))
        if len(self.automaton):
            self.automaton.make_automaton()

    def hits(self, text: str) -> list[tuple[int, int, str, float]]:
        """(start, end, entry, weight) of what counts."""
        if not len(self.automaton):
            return []
        found, excepted = [], []
        for last, (entry, whole, weight) in self.automaton.iter(text):
            begin, end = last + 1 - len(entry), last + 1
            if begin and text[begin - 1].isalnum():
                continue
            if whole and end < len(text) and text[end].isalnum():
                continue
            (excepted if weight is None else found).append((begin, end, entry, weight))
        return [
            hit
            for hit in found
            if not any(b <= hit[0] and hit[1] <= e for b, e, _, _ in excepted)
        ]

    def features(self, text: str, hits: list | None = None) -> tuple[float, float, float]:
        """Strongest weight, sum of weights, sum of weights by length."""
        best: dict[int, float] = {}
        for begin, _, _, weight in self.hits(text) if hits is None else hits:
            best[begin] = max(weight, best.get(begin, 0.0))
        total = sum(best.values())
        return (
            max(best.values(), default=0.0),
            math.log1p(total),
            math.log1p(100 * total / (10 + text.count(" "))),
        )

    def score(self, text: str, hits: list | None = None) -> float:
        if not self.lexicon.logistic:
            return 0.0
        bias, *slopes = self.lexicon.logistic
        z = bias + sum(a * b for a, b in zip(slopes, self.features(text, hits)))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def _entries(text: str) -> set[str]:
    found = set()
    for word in set(_WORD.findall(text)):
        found.add(word + " ")
        found.update(word[:n] for n in STEMS if n <= len(word))
    return found


def _counts(rows: DataFrame, make) -> DataFrame:
    """entry, toxic and clean: the documents of each kind with an entry of ``make(text)``."""

    def run(batch: pa.RecordBatch) -> dict:
        seen: dict[str, list[int]] = {}
        labels = batch.column("label").to_pylist()
        for text, label in zip(batch.column("text").to_pylist(), labels):
            for entry in make(folded(text)):
                seen.setdefault(entry, [0, 0])[label] += 1
        return {
            "entry": pa.array(list(seen), pa.string()),
            "clean": pa.array([n[0] for n in seen.values()], pa.int64()),
            "toxic": pa.array([n[1] for n in seen.values()], pa.int64()),
        }

    return (
        rows.select("text", "label")
        .mapInArrow(by_batch(run), "entry string, clean bigint, toxic bigint")
        .groupBy("entry")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )


def _with_evidence(counts: DataFrame, clean: int, toxic: int) -> DataFrame:
    """Adds the log-odds and the log-likelihood ratio of each entry."""
    a, b = F.col("toxic"), F.col("clean")
    share = (a + b) / (clean + toxic)

    def part(n: Column, of: int, p: Column) -> Column:
        got = F.greatest(n / of, F.lit(1e-12))
        rest = F.greatest(1 - n / of, F.lit(1e-12))
        return n * F.log(got / p) + (of - n) * F.log(rest / F.greatest(1 - p, F.lit(1e-12)))

    return counts.withColumn(
        "weight", F.log((a + 0.5) / (toxic + 1)) - F.log((b + 0.5) / (clean + 1))
    ).withColumn("evidence", 2 * (part(a, toxic, share) + part(b, clean, share)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, ...]:
    """Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-6, *[ridge] * (x.shape[1] - 1)])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty @ w
        curvature = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + penalty
        w -= np.linalg.solve(curvature, gradient)
    return tuple(map(float, w))


def learn(docs: DataFrame, labels: DataFrame, fit_rows: int = 10_000) -> Lexicon:
    """A lexicon from ``labels`` (doc_id, label 0 or 1), of which the ``fit_rows`` with the
    smallest hash are used, and of rows that repeat an id the text with the smallest hash. All entries
    with enough evidence are taken; so are all exceptions."""
    chosen = (
        labels.where("label in (0, 1)")
        .select("doc_id", F.col("label").cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "label")
        .limit(fit_rows)
    )
    rows = stored(
        docs.where("text is not null")
        .select("doc_id", "text")
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))["text"].alias("text")),
        "labelled",
    )
    sizes = {row["label"]: row["count"] for row in rows.groupBy("label").count().collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not clean or not toxic:
        return Lexicon()
    # Entries of few toxic documents cannot have enough evidence, so they need no further work.
    counts = stored(_counts(rows, _entries), "lexicon-counts")
    chance = 2 * math.log(max(counts.count(), 10))
    strong = (
        _with_evidence(counts, clean, toxic)
        .where((F.col("weight") > 1.5) & (F.col("evidence") > chance))
        .orderBy(F.desc("evidence"), "entry")
        .collect()
    )
    seen_in = {row["entry"]: row["toxic"] for row in strong}
    # A stem is too short if one letter more, or the end of the word, finds almost as much.
    too_short = {
        entry[:n]
        for entry, toxic in seen_in.items()
        for n in STEMS
        if n < len(entry) and toxic >= 0.97 * seen_in.get(entry[:n], math.inf)
    }
    found = {row["entry"]: row["weight"] for row in strong if row["entry"] not in too_short}
    # A longer entry that is no stronger than a stem of itself finds nothing more.
    weights = {
        entry: weight
        for entry, weight in found.items()
        if not any(found.get(entry[:n], -1) >= weight for n in STEMS if n < len(entry))
    }
    lexicon = Lexicon(weights)

    mild = (
        _with_evidence(_counts(rows, _phrases(lexicon)), clean, toxic)
        .where("clean >= 3 and weight < -1")
        .orderBy(F.desc("clean"), "entry")
        .collect()
    )
    lexicon.exceptions = [row["entry"] for row in mild]

    def measure(batch: pa.RecordBatch) -> dict:
        matcher = Matcher(lexicon)
        columns = list(zip(*(matcher.features(folded(t)) for t in batch.column("text").to_pylist())))
        return {"label": batch.column("label")} | {
            name: pa.array(columns[i] if columns else [], pa.float64())
            for i, name in enumerate(("a", "b", "c"))
        }

    # At most fit_rows rows of four numbers.
    fit = (
        rows.select("text", "label")
        .mapInArrow(by_batch(measure), "label int, a double, b double, c double")
        .toPandas()
        .sort_values(["label", "a", "b", "c"])
    )
    lexicon.logistic = _logistic(fit[["a", "b", "c"]].to_numpy(), fit["label"].to_numpy())
    return lexicon


def _phrases(lexicon: Lexicon):
    """The hits of a text with the word before and the word after."""
    made: list[Matcher] = []

    def phrases(text: str) -> set[str]:
        if not made:
            made.append(Matcher(lexicon))
        near = set()
        for begin, _, _, _ in made[0].hits(text):
            end = begin
            while end < len(text) and text[end].isalnum():
                end += 1
            start = begin - 1
            while start > 0 and text[start - 1].isalnum():
                start -= 1
            before = _WORD.findall(text[max(0, start) : begin])
            after = _WORD.match(text, end + 1) if text[end : end + 1] == " " else None
            if before and text[begin - 1] == " ":
                near.add(f"{before[-1]} {text[begin:end]}")
            if after:
                near.add(f"{text[begin:end]} {after[0]}")
        return near

    return phrases


def toxicity(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Per row of ``docs``: doc_id, score, and hits, the entries that counted."""
    schema = pa.schema(
        {"doc_id": pa.int64(), "score": pa.float64(), "hits": pa.list_(pa.string())}
    )

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        matcher = Matcher(lexicon)
        rows = [folded(text) for text in batch.column("text").to_pylist()]
        hits = [matcher.hits(text) for text in rows]
        scores = [matcher.score(text, found) for text, found in zip(rows, hits)]
        hits = [sorted({entry for _, _, entry, _ in found}) for found in hits]
        return pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(scores, pa.float64()),
                pa.array(hits, pa.list_(pa.string())),
            ],
            schema=schema,
        )

    return texts(docs).mapInArrow(by_batch(run), from_arrow_schema(schema))


def held_out(doc_id: str = "doc_id") -> Column:
    """A fifth of the ids, by the CRC of their text."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    labels = table(spark, folder, "labels").select("doc_id", F.col("toxic").alias("label"))
    lexicon = learn(docs, labels.where(~held_out()))
    return toxicity(docs, lexicon).select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
        "hits",
    )
