"""The best documents for each item of a query table, ranked by shared terms (a form of BM25 in integers).

Terms are runs of letters and digits of ASCII and of all other characters beyond ASCII; A-Z are
lower-cased. One pass over the texts counts the terms and keeps, per document, its length and how
often it has each term of the items. A task then takes documents in blocks and, for each item, holds
a bitmap per term: the documents of the block that have it. The bitmaps together give every
document a mask of the terms it matches, and documents of one mask form a group. No document of a
group can score more than the sum of its terms' weights times the largest saturation each term has
in the block. Groups are scored in the order of that limit, until the limit falls below the worst of
the best documents found; what is left cannot enter. Equal limits are still scored, as ties go to
the smaller doc_id. A task carries its best documents from block to block, so later blocks end early.

Items are taken in sets that have at most ``terms_per_pass`` different terms (an item with more is a set
by itself), so what is sent to tasks is bounded; the texts are read once per set. A block has
``CELLS`` term counts at most. A task returns at most ``best`` documents per item; they are merged in
``SALTS`` parts per item before the last merge, so no task sees all of an item's.

Null and empty texts and items have no terms: such documents are never found and not counted, such
items find nothing. Rows that repeat a doc_id are documents of their own, rows that repeat an item_id
items of their own. A null doc_id stands before all others among ties. Empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.llm.common import query, stored, table, texts

BEST = 50
TERMS_PER_PASS = 1 << 14
CELLS = 1 << 23
SALTS = 64

#: Bytes as they count in a term: A-Z as a-z, separators as spaces.
_FOLDED = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256)
)

POSTINGS = "doc_id bigint, n bigint, terms array<int>, times array<bigint>"
FOUND = "item int, score bigint, doc_id bigint, salt int"


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLDED).split()


def item_sets(items: DataFrame, terms_per_pass: int) -> Iterator[list[tuple[int, list[bytes]]]]:
    """(item_id, its different terms) of all items, in lists of at most so many different terms."""
    held: list[tuple[int, list[bytes]]] = []
    known: set[bytes] = set()
    for row in items.select("item_id", "text").toLocalIterator():
        terms = sorted(set(terms_of(row["text"])))
        if held and len(known.union(terms)) > terms_per_pass:
            yield held
            held, known = [], set()
        held.append((row["item_id"], terms))
        known.update(terms)
    if held:
        yield held


def postings(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """Per document: its number of terms, the numbers of the known ones in it in ascending order, and
    how often each occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, terms, times, ends = [], [], [], [0]
            for text in batch.column("text"):
                words = terms_of(text.as_py())
                sizes.append(len(words))
                counts = Counter(words)
                here = sorted((numbers[w], counts[w]) for w in counts.keys() & numbers.keys())
                terms.extend(t for t, _ in here)
                times.extend(n for _, n in here)
                ends.append(len(terms))
            places = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(places, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(places, pa.array(times, pa.int64())),
                ],
                names=["doc_id", "n", "terms", "times"],
            )

    return texts(docs).mapInArrow(run, POSTINGS)


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


class Block:
    """Some documents: how much each term counts in each of them (0 where it is not), and whether it
    is there at all."""

    def __init__(self, ids, sizes, ends, terms, times, width: int, documents: int, length: int):
        n = len(sizes)
        m = [50 + (50 * size * documents) // length for size in sizes.tolist()]
        rows = np.repeat(np.arange(n), np.diff(ends))
        counted = (1_000_000_000 * times) // (1000 * times + 20 * np.array(m, np.int64)[rows])
        self.ids = ids
        self.counted = np.zeros((width, n), np.int32)
        self.counted[terms, rows] = counted
        there = np.zeros((width, n), bool)
        there[terms, rows] = True
        self.bitmaps, self.n = np.packbits(there, axis=1), n
        self.most = self.counted.max(axis=1, initial=0).astype(np.int64)

    def masks(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The different masks (as rows of booleans by term), the documents in the order of their
        masks, and where each mask's documents begin. Documents without a term are left out."""
        bitmaps = self.bitmaps[terms]
        any_term = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(bitmaps), count=self.n))
        bits = np.unpackbits(bitmaps, axis=1, count=self.n)[:, any_term]
        words = np.packbits(bits, axis=0)
        filled = np.zeros((-(-len(words) // 8) * 8, len(any_term)), np.uint8)
        filled[: len(words)] = words
        keys = np.ascontiguousarray(filled.T).view(np.uint64)
        order = np.lexsort(keys.T)
        keys = keys[order]
        first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)][: len(order)])
        return bits[:, order[first]].T.astype(bool), any_term[order], first

    def best(
        self, terms: np.ndarray, weights: np.ndarray, best: int, least: int
    ) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents (places in the block) that can be among the best, their scores, and the
        number of documents scored; ``least`` is a score that must be reached, 1 at least."""
        masks, docs, first = self.masks(terms)
        limits = masks @ (weights * self.most[terms])
        order = np.argsort(-limits, kind="stable")
        limits = limits[order]
        ends = np.append(first[1:], len(docs))
        sizes = (ends - first)[order]
        reached = np.cumsum(sizes)
        found, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        at, scored = 0, 0
        while at < len(order) and limits[at] >= least:
            # Groups with twice as many documents as before, one group at least.
            until = max(at + 1, int(np.searchsorted(reached, 2 * scored + best, "right")))
            until = min(until, int(np.searchsorted(-limits, -least, "right")))
            groups = order[at:until]
            members = np.concatenate([docs[first[g] : ends[g]] for g in groups])
            points = weights @ self.counted[np.ix_(terms, members)].astype(np.int64)
            scored += len(members)
            enough = points >= least
            found.append(members[enough])
            scores.append(points[enough])
            everything = np.concatenate(scores)
            if len(everything) >= best:
                least = max(least, int(np.partition(everything, -best)[-best]))
            at = until
        members, points = np.concatenate(found), np.concatenate(scores)
        enough = points >= least
        return members[enough], points[enough], scored


def best_of_tasks(
    counts: DataFrame,
    items: list[list[int]],
    weights: list[int],
    documents: int,
    length: int,
    best: int,
) -> DataFrame:
    """(item, score, doc_id, salt): the best documents of each task for each item, which is a list
    of numbers of terms that have a weight above 0."""
    width = len(weights)
    step = max(64, CELLS // max(1, width))
    by_item = [np.array(terms, np.int64) for terms in items]
    heavy = [np.array([weights[t] for t in terms], np.int64) for terms in items]

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                terms, times = part.column(2), part.column(3)
                sizes = terms.value_lengths().to_numpy().astype(np.int64)
                yield Block(
                    part.column(0).to_pylist(),
                    part.column(1).to_numpy(),
                    np.append(0, np.cumsum(sizes)),
                    terms.flatten().to_numpy(),
                    times.flatten().to_numpy(),
                    width,
                    documents,
                    length,
                )

    def order(entry: tuple[int, int | None]):
        score, doc = entry
        return (-score, doc is not None, doc or 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        salt = TaskContext.get().partitionId() % SALTS
        leaders: list[list[tuple[int, int | None]]] = [[] for _ in items]
        for block in blocks(batches):
            for k, terms in enumerate(by_item):
                if not len(terms):
                    continue
                least = leaders[k][-1][0] if len(leaders[k]) >= best else 1
                members, points, _ = block.best(terms, heavy[k], best, least)
                if len(members):
                    fresh = [(p, block.ids[i]) for p, i in zip(points.tolist(), members.tolist())]
                    leaders[k] = sorted(leaders[k] + fresh, key=order)[:best]
        for k, entries in enumerate(leaders):
            if entries:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k] * len(entries), pa.int32()),
                        pa.array([score for score, _ in entries], pa.int64()),
                        pa.array([doc for _, doc in entries], pa.int64()),
                        pa.array([salt] * len(entries), pa.int32()),
                    ],
                    names=["item", "score", "doc_id", "salt"],
                )

    return counts.mapInArrow(run, FOUND)


def _nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")


def _ranked(docs: DataFrame, held: list[tuple[int, list[bytes]]], best: int) -> DataFrame:
    spark = docs.sparkSession
    every = sorted({term for _, terms in held for term in terms})
    numbers = {term: i for i, term in enumerate(every)}
    counts = stored(postings(docs, numbers), "search-postings")
    sums = counts.agg(
        F.expr("count_if(n > 0)").alias("documents"), F.expr("coalesce(sum(n), 0L)").alias("length")
    ).first()
    holding = dict(
        counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    )
    weights = [weight(sums["documents"], holding.get(i, 0)) for i in range(len(every))]
    # A term that no document has cannot be matched, one of weight 0 adds nothing.
    items = [
        [n for n in (numbers[t] for t in terms) if weights[n] > 0 and n in holding]
        for _, terms in held
    ]
    if not any(items):
        return _nothing(spark)
    found = best_of_tasks(counts, items, weights, sums["documents"], sums["length"], best)
    by_score = [F.desc("score"), F.asc_nulls_first("doc_id")]
    for keys in (["item", "salt"], ["item"]):
        ordered = Window.partitionBy(*keys).orderBy(*by_score)
        found = found.withColumn("rank", F.row_number().over(ordered)).where(f"rank <= {best}")
    names = spark.createDataFrame(
        [(k, item) for k, (item, _) in enumerate(held)], "item int, item_id bigint"
    )
    return found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def ranked_search(
    docs: DataFrame, items: DataFrame, best: int = BEST, terms_per_pass: int = TERMS_PER_PASS
) -> DataFrame:
    """item_id, rank, doc_id and score of the ``best`` documents (doc_id, text) with a score above 0
    for each of ``items`` (item_id, text); all of them, if there are fewer."""
    found = None
    for held in item_sets(items, terms_per_pass):
        part = _ranked(docs, held, best)
        found = part if found is None else found.unionByName(part)
    return _nothing(docs.sparkSession) if found is None else found


def _oracle() -> str:
    """All pairs of items and documents that share a term."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    terms = f"regexp_extract_all(translate(text, '{letters}', '{letters.lower()}'), '{pattern}')"
    return f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {terms} AS w FROM documents),
s AS (SELECT count(*) FILTER (len(w) > 0) AS big_n, sum(len(w))::BIGINT AS big_l FROM d),
p AS MATERIALIZED (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY ALL),
i AS (SELECT row_number() OVER () AS q, item_id, {terms} AS w FROM benchmark),
q AS MATERIALIZED (SELECT DISTINCT q, unnest(w) AS term FROM i),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(big_n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM p, s WHERE term IN (SELECT term FROM q) GROUP BY term),
m AS (SELECT r, doc_id, 50 + (50 * len(w) * big_n) // big_l AS m FROM d, s),
f AS (SELECT q, r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY q, r),
o AS (SELECT q, doc_id, score, row_number() OVER
  (PARTITION BY q ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM f JOIN m USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o JOIN i USING (q) WHERE rank <= {BEST}"""


@query("op12_lexical_search", _oracle())
def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
