"""Pack documents into sequences of a fixed number of tokens by patterns of few documents.

Documents are encoded, closed with an end id, and cut only if longer than a sequence. The lengths
of the pieces give a histogram of at most ``capacity`` bars. Patterns of one to four lengths that
fill a sequence (almost) are enumerated from it; non-negative least squares finds how often each
pattern should be used to reproduce the histogram; the counts are rounded down to whole sequences
that the histogram can serve, and what is left is packed best fit, longest first, as counts of
lengths as well. The work on the driver depends on the number of different lengths only, never on
the number of documents. Pieces get their places by their rank among the pieces of their length;
ranks are counted in blocks of about ``BLOCK_ROWS`` pieces, as many as a length needs, so a length that
a third of all pieces have is spread over tasks in proportion.

Null and empty texts are documents of the end id alone. A repeated row is packed again. A null
doc_id stays null. An empty table gives no rows.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from starloom.llm.coding import UNUSUAL, WordCache, tokenizer
from starloom.llm.common import query, stored, table, texts

BLOCK_ROWS = 4096
Pattern = tuple[tuple[int, ...], int]


@cache
def _ids(path: str) -> WordCache:
    def make(words: list[str]) -> list[bytes]:
        # Letters and the punctuation behind them are different tokens, so words that differ in
        # punctuation only need their letters encoded once.
        cut = []
        for word in words:
            head = word.rstrip(string.punctuation)
            plain = head.isalpha() and max(head) < "\u0100"
            cut.append((head, word[len(head) :]) if plain else (word, ""))
        known = words_known.known
        new = list({part for both in cut for part in both if part and part not in known})
        coded = tokenizer(path).encode_batch_fast(new, add_special_tokens=False)
        made = {part: np.array(x.ids, "<u4").tobytes() for part, x in zip(new, coded)}
        values = [
            (made[h] if h in made else known[h]) + (made[t] if t in made else known[t] if t else b"")
            for h, t in cut
        ]
        whole = set(words)
        for part, value in made.items():
            if part not in whole and words_known.stays(part, len(known)):
                known[part] = value
        return values

    words_known = WordCache(make)
    return words_known


def _lower(body: str) -> str:
    """The tokenizer lower-cases, so words may be lower-cased first to be found in the cache. That is
    left out beyond Latin-1, where cases are not simple, and beside special strings."""
    try:
        body.encode("latin-1")
    except UnicodeEncodeError:
        return body
    return body if "<|" in body else body.lower()


def ids_of(path: str, bodies: list[str]) -> list[bytes]:
    """The ids of each text as little-endian unsigned 32-bit numbers. This tokenizer drops white
    space and never joins over it, so texts are encoded word by word."""
    usual = [not UNUSUAL.search(body) for body in bodies]
    words = [_lower(body).split() if ok else [] for body, ok in zip(bodies, usual)]
    return [
        b"".join(parts)
        if ok
        else np.array(tokenizer(path).encode(body, add_special_tokens=False).ids, "<u4").tobytes()
        for parts, body, ok in zip(_ids(path).of(words), bodies, usual)
    ]


def tokenized_pieces(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1):
    """doc_id, piece, start, length and ids (little-endian unsigned 32-bit) of every piece."""
    end, step = np.array([end_id], "<u4").tobytes(), 4 * capacity
    schema = pa.schema(
        {
            "doc_id": pa.int64(),
            "piece": pa.int32(),
            "start": pa.int64(),
            "length": pa.int64(),
            "ids": pa.binary(),
        }
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                owners, coded = part.column("doc_id").to_pylist(), part.column("text").to_pylist()
                cut = [
                    (doc, at // step, at // 4, len(ids := whole[at : at + step]) // 4, ids)
                    for doc, whole in zip(owners, (x + end for x in ids_of(path, coded)))
                    for at in range(0, len(whole), step)
                ]
                columns = zip(*cut) if cut else [[]] * len(schema)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
                )

    ddl = "doc_id bigint, piece int, start bigint, length bigint, ids binary"
    return texts(docs).mapInArrow(run, ddl)


def few_piece_patterns(counts: np.ndarray, tolerance: float = 0.0005) -> list[tuple[int, ...]]:
    """Patterns of one to four lengths that occur, which leave at most ``tolerance`` unused."""
    capacity = len(counts) - 1
    waste = int(capacity * tolerance)
    # below[c]: the longest length of at most c that occurs, 0 if none.
    below = np.maximum.accumulate(np.where(counts > 0, np.arange(capacity + 1), 0))
    lengths = np.flatnonzero(counts)[::-1]
    shares = (0.2, 0.35, 0.5, 0.65, 0.8)
    # At most 32 patterns begin with a length, so there are at most 32 * capacity patterns.
    found = set()
    for first in map(int, lengths):
        room = capacity - first
        starts = [(first,), *((first, int(below[int(room * s)])) for s in shares)]
        starts += [
            (*pair, int(below[int((room - pair[1]) * s)])) for pair in starts[1:] for s in (0.3, 0.6)
        ]
        for start in starts:
            rest = capacity - sum(start)
            for last in {int(below[rest]), int(below[max(0, rest - waste // 2)])}:
                pattern = tuple(sorted((x for x in (*start, last) if x), reverse=True))
                if capacity - sum(pattern) <= waste:
                    found.add(pattern)
    return sorted(found, reverse=True)


def fitted(patterns: list[tuple[int, ...]], counts: np.ndarray, rounds: int = 300) -> np.ndarray:
    """How often to use each pattern: least squares over numbers that are not negative, by
    accelerated projected gradient steps; bars are weighted by one over the root of their height."""
    width = max(map(len, patterns))
    grid = np.array([p + (0,) * (width - len(p)) for p in patterns])
    target = counts.astype(float).copy()
    target[0] = 0
    weight = 1 / (target + 1)
    weight[0] = 0
    flat = grid.ravel()

    def made(x):
        return np.bincount(flat, np.repeat(x, width), len(target))

    # The largest singular value, by power iteration, bounds the step.
    v = np.ones(len(patterns))
    for _ in range(20):
        v = (weight * made(v))[grid].sum(axis=1)
        size = np.linalg.norm(v)
        v /= size
    x = y = np.zeros(len(patterns))
    momentum = 1.0
    for _ in range(rounds):
        step = y - (weight * (made(y) - target))[grid].sum(axis=1) / (1.05 * size)
        new = np.maximum(step, 0)
        after = (1 + (1 + 4 * momentum**2) ** 0.5) / 2
        y, x, momentum = new + (momentum - 1) / after * (new - x), new, after
    return x


def best_fit(counts: np.ndarray) -> list[Pattern]:
    """Best fit, longest first, over counts of lengths: sequences with equal content are one entry
    with a number, so the work follows the number of different lengths."""
    capacity = len(counts) - 1
    opened: dict[int, list[list]] = {}
    free = np.zeros(capacity + 1, bool)
    for length in map(int, np.flatnonzero(counts)[::-1]):
        left = int(counts[length])
        while left:
            fits = np.flatnonzero(free[length:])
            room = length + int(fits[0]) if len(fits) else capacity
            if len(fits):
                content, number = opened[room].pop()
                free[room] = bool(opened[room])
                each = 1
            else:
                content, each = (), min(capacity // length, left)
                number = left // each
            used = min(number, left // each)
            if used < number:
                opened[room].append([content, number - used])
                free[room] = True
            left -= used * each
            rest = room - each * length
            opened.setdefault(rest, []).append([content + (length,) * each, used])
            free[rest] = rest > 0
    return [(content, number) for groups in opened.values() for content, number in groups]


def packing_plan(counts: np.ndarray) -> list[Pattern]:
    """(lengths of a sequence, number of such sequences), for ``counts[length]`` pieces."""
    left, plan = counts.astype(np.int64).copy(), []
    left[0] = 0
    patterns = few_piece_patterns(left)
    if patterns:
        uses = np.floor(fitted(patterns, left)).astype(np.int64)
        for at in np.argsort(-uses, kind="stable"):
            lengths, times = np.unique(patterns[at], return_counts=True)
            use = int(min(uses[at], (left[lengths] // times).min()))
            if use:
                left[lengths] -= use * times
                plan.append((patterns[at], use))
    return plan + best_fit(left)


def places(plan: list[Pattern]) -> dict[str, np.ndarray]:
    """Per run of ranks of a length: where it begins (``key``), how many of it a sequence takes,
    the first sequence and the first offset; sorted by ``key``."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for lengths, number in plan:
        offset = 0
        for length in sorted(set(lengths), reverse=True):
            times = lengths.count(length)
            rank = used.get(length, 0)
            used[length] = rank + times * number
            rows.append(((length << 48) + rank, times, base, offset))
            offset += times * length
        base += number
    columns = np.array(sorted(rows), np.int64).reshape(-1, 4).T
    return dict(zip(("key", "times", "base", "offset"), columns))


def ranked(pieces: DataFrame, sizes: DataFrame) -> DataFrame:
    """``pieces`` and their ``rank``, from 0, among those of their length. ``sizes`` has the number
    of pieces ``n`` of each length."""
    blocks = sizes.select("length", F.ceil(F.col("n") / BLOCK_ROWS).alias("blocks"))
    dealt = (
        pieces.join(F.broadcast(blocks), "length")  # a row per length
        .withColumn("block", F.expr("pmod(xxhash64(doc_id, piece), blocks)"))
        .drop("blocks")
    )
    earlier = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        dealt.groupBy("length", "block")
        .agg(F.count("*").alias("n"))
        .select("length", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    )
    order = Window.partitionBy("length", "block").orderBy("doc_id", "piece")
    return (
        dealt.withColumn("number", F.row_number().over(order))
        .join(before, ["length", "block"])
        .select(*pieces.columns, (F.col("before") + F.col("number") - 1).alias("rank"))
    )


def placed(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """``pieces`` (with doc_id, piece, length and whatever else) and their sequence_id and offset.

    ``pieces`` is read three times, so it should be stored.
    """
    sizes = stored(pieces.groupBy("length").agg(F.count("*").alias("n")), "lengths")
    collected = sizes.toPandas()  # at most ``capacity`` rows, whatever the table
    counts = np.bincount(
        collected["length"], collected["n"].to_numpy(float), capacity + 1
    ).astype(np.int64)
    lookup = places(packing_plan(counts))

    names = pieces.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(lookup["key"], (length << 48) + rank, "right") - 1
            inside = rank - (lookup["key"][at] & ((1 << 48) - 1))
            times = lookup["times"][at]
            kept = batch.select(names)
            yield pa.RecordBatch.from_arrays(
                [
                    *kept.columns,
                    pa.array(lookup["base"][at] + inside // times, pa.int64()),
                    pa.array(lookup["offset"][at] + inside % times * length, pa.int64()),
                ],
                names=[*names, "sequence_id", "offset"],
            )

    more = [StructField(name, LongType()) for name in ("sequence_id", "offset")]
    return ranked(pieces, sizes).mapInArrow(run, StructType([*pieces.schema.fields, *more]))


def packed_documents(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """doc_id, piece, start, length, ids, sequence_id and offset: the sequences themselves."""
    return placed(stored(tokenized_pieces(docs, path, capacity, end_id), "pieces"), capacity)


def packing_digests(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """As ``packed_documents``, with ids_crc32 for the ids, which then need not be stored."""
    pieces = tokenized_pieces(docs, path, capacity, end_id).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")
    )
    return placed(stored(pieces, "pieces"), capacity)


@query("op4_best_fit_packing")
def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing_digests(table(spark, folder, "documents"), path)
