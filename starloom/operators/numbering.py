"""Running numbers without gaps, given by many tasks at once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.names import quoted

#: The low bits of ``monotonically_increasing_id`` count the rows of a partition.
_BITS = 33


def dense_numbers(
    df: DataFrame,
    order_by: Sequence[str | Column],
    name: str,
    store: Callable[[str, DataFrame], DataFrame],
    first: int = 1,
) -> DataFrame:
    """``df`` with the column ``name``: ``first``, ``first`` + 1, ... in the order of ``order_by``.

    Rows are dealt to partitions by ranges of the order and sorted there; each has a place in its
    partition, and the partitions' sizes, added up in their order, say where a partition's numbers begin.
    The only thing that passes one task is a row per partition. Rows of equal order are told
    apart by a hash of all their columns, so a value that very many rows share is spread over
    partitions too; rows that are equal in all columns are numbered in any order.

    ``store`` writes a named frame and returns what to read instead (``stored_in``): numbers rest on
    ranges that Spark draws from a sample, so the partitions must be computed once.
    """
    columns = [F.col(quoted(c)) if isinstance(c, str) else c for c in order_by]
    same = F.xxhash64(*[F.col(quoted(c)) for c in df.columns])
    placed = store(
        f"numbered-{name}",
        df.repartitionByRange(*columns, same)
        .sortWithinPartitions(*columns, same)
        .withColumn("__place", F.monotonically_increasing_id()),
    )
    part = F.shiftright("__place", _BITS)
    ranged = placed.withColumn("__part", part)
    sizes = ranged.groupBy("__part").agg(F.count("*").alias("__size"))
    starts = sizes.selectExpr(
        "__part",
        f"coalesce(sum(__size) OVER (ORDER BY __part ROWS BETWEEN UNBOUNDED PRECEDING AND"
        f" 1 PRECEDING), 0) + {first} AS __start",
    )
    number = f"__start + (__place & {(1 << _BITS) - 1}L) AS {quoted(name)}"
    return ranged.join(starts, "__part").selectExpr(*map(quoted, df.columns), number)
