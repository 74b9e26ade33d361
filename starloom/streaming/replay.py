"""A table as a stream that arrives in a known order, and streams that stop and go on."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def arrive(rows: DataFrame, path: str) -> None:
    """Add ``rows`` to a folder that a file stream reads; files are taken in the order of their times."""
    rows.write.mode("append").parquet(path)


def replay(
    arrivals: Iterable[DataFrame], path: str, start: Callable[[], StreamingQuery]
) -> list[int]:
    """Let each of ``arrivals`` come to ``path`` and run the stream until it has taken it, so that each
    is a micro-batch of its own; returns how many rows each run read.

    ``start`` starts the stream with one checkpoint and the available-now trigger. A watermark moves
    between two arrivals, so rows behind it are late in the next one.
    """
    read = []
    for rows in arrivals:
        arrive(rows, path)
        query = start()
        query.awaitTermination()
        read.append(sum(progress["numInputRows"] for progress in query.recentProgress))
    return read


def stop_after(query: StreamingQuery, batches: int = 1, seconds: float = 600) -> int:
    """Stop a running stream as soon as so many micro-batches with rows are done, whatever it is at
    then; returns how many were seen. An error of the stream is raised."""
    until = time.monotonic() + seconds
    done: set[int] = set()
    while query.isActive and len(done) < batches and time.monotonic() < until:
        done |= {p["batchId"] for p in query.recentProgress if p["numInputRows"]}
        time.sleep(0.05)
    query.stop()
    if (error := query.exception()) is not None:
        raise error
    return len(done)
