"""Repeated passages by content-defined chunking.

Texts are cut where a rolling gear hash says so, so an insertion moves only the borders beside it
and equal passages are cut alike wherever they stand. Borders are places in the UTF-8 bytes, never
inside a character. Chunks with a digest that occurs in several documents are repeated, and in the
query those at several places of one document too; consecutive ones form a run, and runs of at
least ``min_bytes`` are reported, cut into spans where chunks to drop meet chunks to keep. A chunk is dropped where an
earlier place has it, whatever stands beside it, so each chunk stays at its first place. The chunks
of a passage leave out what lies before its first and after its last border,
about 40 bytes together: 150 bytes find a passage of 50 words practically always, and single lines
of a dozen words never.

Digests are counted by partial sums and joined back; one that a third of all documents have is
one row of the counts. Only the spans to cut from one document are grouped into a list.

Null and empty texts have no chunks. Rows without a doc_id cannot be reported and are left out. Rows
that repeat a doc_id count as one document. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from starloom.llm import hashing
from starloom.llm.common import query, table, texts

_CHUNKS = pa.schema(
    {
        "doc_id": pa.int64(),
        "start": pa.int64(),
        "end": pa.int64(),
        "digest": pa.int64(),
        "again": pa.bool_(),
    }
)


def _again(digests: np.ndarray) -> np.ndarray:
    """Whether each digest stood before."""
    result = np.ones(len(digests), bool)
    result[np.unique(digests, return_index=True)[1]] = False
    return result


def document_chunks(docs: DataFrame) -> DataFrame:
    """doc_id, start, end (bytes of the UTF-8 text), digest of each chunk, and whether the text has
    the digest again, from an earlier place on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 1000) for i in range(0, batch.num_rows, 1000)):
                found = list(hashing.chunks(part.column("text")))
                owners = part.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
                sizes = [len(starts) for starts, _, _ in found]
                columns = [np.repeat(owners, sizes)]
                columns += [np.concatenate(parts) for parts in zip(*found)]
                columns[3] = columns[3].view(np.int64)
                again = [_again(digests) for _, _, digests in found]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, pa.int64()) for c in columns), pa.array(np.concatenate(again))],
                    schema=_CHUNKS,
                )

    known = texts(docs).where("doc_id is not null and text != ''")
    return known.mapInArrow(run, from_arrow_schema(_CHUNKS))


def repeated_spans(docs: DataFrame, min_bytes: int = 150, within: bool = False) -> DataFrame:
    """doc_id, start, end (bytes), chunks, first_doc_id and keep of each span of chunks that occur in
    several documents or, with ``within``, at several places, be it of one document. Runs of such
    chunks have ``min_bytes`` at least; a run is cut into spans where chunks of which the document
    has the first place meet others. ``first_doc_id`` is the smallest doc_id with any of the chunks;
    ``keep`` says that the span is the one to keep. Spans to drop can be short beside others; those
    to keep are reported if the run has ``min_bytes`` of them, so a letter that two copies happen to
    share after a passage is no passage by itself."""
    found = document_chunks(docs)
    if not within:
        found = found.withColumn("again", F.lit(False))
    shared = (
        found.groupBy("digest")
        .agg(
            F.min("doc_id").alias("first_doc_id"),
            F.max("doc_id").alias("last_doc_id"),
            F.max("again").alias("twice"),
        )
        .where("first_doc_id < last_doc_id or twice")
        .drop("last_doc_id", "twice")
    )
    order = Window.partitionBy("doc_id").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    up_to_here = order.rowsBetween(Window.unboundedPreceding, 0)
    marked = (
        found.join(shared, "digest")
        .withColumn("opens", F.coalesce(F.col("start") > before, F.lit(True)).cast("int"))
        .withColumn("keep", (F.col("first_doc_id") == F.col("doc_id")) & ~F.col("again"))
        .withColumn("turns", (F.col("keep") != F.lag("keep", 1, True).over(order)).cast("int"))
        .withColumn("run", F.sum("opens").over(up_to_here))
        .withColumn("turn", F.sum("turns").over(up_to_here))
    )
    run = Window.partitionBy("doc_id", "run")
    return (
        marked.groupBy("doc_id", "run", "turn", "keep")
        .agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.count_distinct("start").alias("chunks"),
            F.min("first_doc_id").alias("first_doc_id"),
        )
        .withColumn("all_bytes", F.max("end").over(run) - F.min("start").over(run))
        .withColumn("kept_bytes", F.sum(F.when(F.col("keep"), F.col("end") - F.col("start"))).over(run))
        .where(F.when(F.col("keep"), F.col("kept_bytes")).otherwise(F.col("all_bytes")) >= min_bytes)
        .select("doc_id", "start", "end", "chunks", "first_doc_id", "keep")
    )


def without_repeats(docs: DataFrame, min_bytes: int = 150, within: bool = False) -> DataFrame:
    """doc_id and text without the spans of whose chunks earlier documents, or with ``within``
    earlier places, keep copies."""
    spans = (
        repeated_spans(docs, min_bytes, within)
        .where("not keep")
        .groupBy(F.col("doc_id").alias("owner"))
        .agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = []
            for text, gone in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                whole, at, kept = text.encode(), 0, []
                for span in gone or ():
                    kept.append(whole[at : span["start"]])
                    at = max(at, span["end"])
                cut.append(b"".join([*kept, whole[at:]]).decode())
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "text": pa.array(cut, pa.string())}
            )

    joined = texts(docs).join(spans, F.col("doc_id") == F.col("owner"), "left").drop("owner")
    return joined.mapInArrow(run, "doc_id bigint, text string")


@query("op6_substring_dedup")
def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_spans(table(spark, folder, "documents"), within=True)
