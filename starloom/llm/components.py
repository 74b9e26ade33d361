"""Connected components of a graph that no machine could hold, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    """A number of edges and a sum of hashes: they differ if the edges do."""
    return tuple(
        edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of the edges (a, b) but for those with no edge to another
    node; a component is named by its smallest node.

    Large stars link each node's larger neighbours to its smallest one, small stars its smaller
    ones, in turn, until nothing changes: a number of rounds logarithmic in the size of a
    component. Each round is stored.
    """
    ordered = edges.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    current = stored(ordered.distinct(), "edges")
    state = _state(current)
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = (
            both.join(lowest, "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
            .distinct()
        )
        lowest = large.groupBy("a").agg(F.min("b").alias("low"))
        to_lowest = [F.struct(F.col(end).alias("a"), F.col("low").alias("b")) for end in "ab"]
        small = (
            large.join(lowest, "a").select(F.explode(F.array(*to_lowest)).alias("e")).select("e.*")
        )
        current = stored(small.where("a != b").distinct(), "edges")
        after = _state(current)
        if after == state:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        state = after
