"""Token counts of whole texts, with huge texts encoded in overlapping chunks.

A text of at most ``chunk_chars`` characters is one unit. A longer one is cut into chunks, each
reaching ``overlap`` characters into the next; chunks are dealt out over all tasks and encoded with
offsets. Two neighbours are spliced at the first position of their overlap where both begin a new
word of the tokenizer's splitting. Such a position is stable: the splitting pattern never looks
back, so from a common boundary on both run alike, and the left chunk's boundaries are the whole
text's up to ``MARGIN`` characters before its end, which is more than the pattern or a special
string can look ahead. Where no such position exists, the document is done again with chunks and
overlaps four times as large, until all are spliced or a chunk holds the whole text.

Null and empty texts have no bytes and no tokens. Each row gives one row, repeated ones too; null
ids stay null. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from starloom.llm.coding import UNUSUAL, WordCache, tokenizer
from starloom.llm.common import by_batch, query, stored, table, texts
from starloom.llm.hashing import column_bytes, slices

MARGIN = 64
#: Bytes of short texts whose words are held at once.
SLICE = 1 << 18
_CHUNKS = pa.schema(
    {
        "row_id": pa.string(),
        "doc_id": pa.int64(),
        "n_bytes": pa.int64(),
        "chunk": pa.int64(),
        "chunks": pa.int64(),
        "begin": pa.int64(),
        "body": pa.string(),
    }
)
_SPLICES = pa.schema(
    {
        "row_id": pa.string(),
        "doc_id": pa.int64(),
        "n_bytes": pa.int64(),
        "chunk": pa.int64(),
        "chunks": pa.int64(),
        "n": pa.int64(),
        **dict.fromkeys(("head", "head_n", "tail", "tail_n"), pa.list_(pa.int64())),
    }
)

#: White space and the word after it: a token never reaches from a word into the space after it.
SEGMENT = re.compile(r"\s*\S+|\s+")


@cache
def _counts(path: str) -> WordCache:
    def make(words: list[str]) -> list[int]:
        return [len(x) for x in tokenizer(path).encode_batch_fast(words, add_special_tokens=False)]

    return WordCache(make)


def count_each(path: str, bodies: list[str]) -> list[int]:
    """The number of tokens of each text."""
    usual = [not UNUSUAL.search(body) for body in bodies]
    words = [SEGMENT.findall(body) if ok else [] for body, ok in zip(bodies, usual)]
    sums = map(sum, _counts(path).of(words))
    return [
        n if ok else len(tokenizer(path).encode(body, add_special_tokens=False))
        for n, body, ok in zip(sums, bodies, usual)
    ]


def boundaries(path: str, body: str) -> tuple[int, list[int], list[int]]:
    """The number of tokens; where words begin; the number of tokens before each of those places."""
    coded = tokenizer(path).encode(body, add_special_tokens=False)
    words, offsets = coded.word_ids, coded.offsets
    at = [i for i in range(len(words)) if i == 0 or words[i] is None or words[i] != words[i - 1]]
    return len(words), [offsets[i][0] for i in at], at


def counted(path: str):
    """Counts the whole texts of a batch in slices, since the words of a slice are held as strings."""

    def run(batch: pa.RecordBatch) -> dict:
        column, counts = batch.column("text"), []
        _, offsets = column_bytes(column)
        for first, end in slices(offsets, SLICE):
            counts += count_each(path, column.slice(first, end - first).to_pylist())
        return {
            "doc_id": batch.column("doc_id"),
            "n_bytes": batch.column("n_bytes"),
            "n_tokens": pa.array(counts, pa.int64()),
        }

    return run


def one_by_one(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch, of which only one at a time is held as Python objects."""
    for i in range(batch.num_rows):
        yield from batch.slice(i, 1).to_pylist()


def _cut(chunk_chars: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in one_by_one(batch):
                text = row["text"]
                n = len(text)
                last = max(0, -(-(n - overlap) // chunk_chars) - 1)
                for k in range(last + 1):
                    begin = k * chunk_chars
                    end = n if k == last else begin + chunk_chars + overlap
                    row |= {"chunk": k, "chunks": last + 1, "begin": begin, "body": text[begin:end]}
                    yield pa.RecordBatch.from_pylist([row], schema=_CHUNKS)

    return run


def _encode(path: str, chunk_chars: int, overlap: int):
    def spliceable(row: dict) -> dict:
        n, at, before = boundaries(path, row["body"])
        begin, safe = row["begin"], len(row["body"]) - MARGIN
        head = [(begin + p, c) for p, c in zip(at, before) if p < overlap and row["chunk"]]
        tail = [
            (begin + p, c)
            for p, c in zip(at, before)
            if chunk_chars <= p <= safe and row["chunk"] < row["chunks"] - 1
        ]
        return row | {
            "n": n,
            "head": [p for p, _ in head],
            "head_n": [c for _, c in head],
            "tail": [p for p, _ in tail],
            "tail_n": [c for _, c in tail],
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in one_by_one(batch):
                yield pa.RecordBatch.from_pylist([spliceable(row)], schema=_SPLICES)

    return run


def spliced(chunks: DataFrame) -> DataFrame:
    """Per document row_id, doc_id, n_bytes, n_tokens, and ``aligned``, false if two neighbours
    have no common boundary."""
    order = Window.partitionBy("row_id").orderBy("chunk")
    joined = chunks.withColumn(
        "cut", F.array_min(F.array_intersect("tail", F.lead("head").over(order)))
    )
    placed = joined.withColumn("from", F.lag("cut").over(order))
    upto = F.when(F.col("chunk") == F.col("chunks") - 1, F.col("n")).otherwise(
        F.expr("element_at(tail_n, cast(array_position(tail, cut) as int))")
    )
    since = F.when(F.col("chunk") == 0, F.lit(0)).otherwise(
        F.expr("element_at(head_n, cast(array_position(head, from) as int))")
    )
    return (
        placed.select("row_id", "doc_id", "n_bytes", (upto - since).alias("n"))
        .groupBy("row_id")
        .agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_bytes").alias("n_bytes"),
            F.sum("n").alias("n_tokens"),
            F.bool_and(F.col("n").isNotNull()).alias("aligned"),
        )
    )


def token_counts(
    docs: DataFrame,
    path: str,
    limit: int = 1024,
    chunk_chars: int = 32_768,
    overlap: int = 1_024,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every row of ``docs``."""
    if overlap > chunk_chars:
        raise ValueError("overlap must not be larger than chunk_chars")
    rows = texts(docs).withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    is_long = F.length("text") > chunk_chars + overlap
    schema = "doc_id bigint, n_bytes bigint, n_tokens bigint"
    done = rows.where(~is_long).mapInArrow(by_batch(counted(path)), schema)
    # Repeated rows are alike in all columns, so each needs a name of its own; it is stored, and
    # so it stays the same whenever a task is repeated.
    left = stored(rows.where(is_long).withColumn("row_id", F.expr("uuid()")), "huge-texts")
    while not left.isEmpty():
        # Only huge texts are cut, and their chunks are dealt out evenly.
        cut = left.select("row_id", "doc_id", "n_bytes", "text").mapInArrow(
            _cut(chunk_chars, overlap), from_arrow_schema(_CHUNKS)
        )
        coded = cut.repartition("row_id", "chunk").mapInArrow(
            _encode(path, chunk_chars, overlap), from_arrow_schema(_SPLICES)
        )
        result = stored(spliced(coded), "spliced")
        done = done.unionByName(result.where("aligned").select("doc_id", "n_bytes", "n_tokens"))
        failed = result.where("not aligned").select("row_id")
        left = left.join(failed, "row_id", "left_semi")
        chunk_chars, overlap = chunk_chars * 4, overlap * 4
    return done.withColumn("over_limit", F.col("n_tokens") > limit)


@query("op7_token_counts")
def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts(table(spark, folder, "documents"), path)
