"""Clusters of vectors around integer centroids, exact, with few distances computed (Shallot).

Every vector carries its nearest and its second-nearest centroid, an upper bound of the distance to
the nearest and a lower bound of the distance to all others. Centroids move, bounds are widened by
the moves, and a vector whose bounds still part stays where it is. Any other one is measured
against the two centroids it remembers; the closer of them is the middle of a ball whose radius is
the sum of both distances. The middle's neighbours, sorted by their distance to it, are measured
until they lie outside the ball, and each one that is closer than the second-nearest shrinks it.
Bounds are doubles and only leave centroids out, with a margin for rounding; what is left is compared
by exact squared distances in 64-bit integers, ties going to the smaller number.

The work is done in tasks over any partitioning of the vectors, without a shuffle; each round's state
is written to the shared folder. Sums per centroid are combined in the tasks, so a centroid that
holds a third of all vectors is one row per task. The driver sees ``clusters`` x ``dims`` numbers a
round, and so does each task; nothing on it grows with the vectors.

Vectors that are null, have another number of components, or a null or non-finite one are left out.
Rows that repeat a vec_id are vectors of their own; as first centroids they stand in the order of
their components. A vector without vec_id is clustered, but is a first centroid only where there
are too few others. With fewer vectors than clusters there are fewer centroids; an empty table
gives no rows. A component beyond 2 ** 27 after scaling fails the job, as squared distances would not
fit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import query, stored, table

LIMIT = 1 << 27
#: Bounds that are closer than this share of each other count as equal.
MARGIN = 1e-9

STATE = "vec_id bigint, v array<int>, nearest int, second int, upper double, lower double"


class Centroids:
    """Integer centroids, how far each is from the others, and how far each has moved."""

    def __init__(self, places: np.ndarray, before: np.ndarray | None = None):
        self.places = places
        k = len(places)
        gaps = places[:, None, :] - places[None, :, :]
        self.apart = np.sqrt((gaps * gaps).sum(2).astype(float))
        self.order = np.argsort(self.apart, axis=1, kind="stable")
        # A centroid may share its place with others, so it need not be first among its neighbours.
        for i in range(k):
            others = self.order[i][self.order[i] != i]
            self.order[i] = np.concatenate([[i], others])
        others = self.apart + np.where(np.eye(k, dtype=bool), np.inf, 0)
        self.half_gap = others.min(1) / 2
        moved = np.zeros(k)
        if before is not None:
            steps = places - before
            moved = np.sqrt((steps * steps).sum(1).astype(float))
        self.moved = moved
        ranked = np.argsort(moved)
        farthest = moved[ranked[-1]]
        self.others_moved = np.full(k, farthest)
        self.others_moved[ranked[-1]] = moved[ranked[-2]] if k > 1 else 0.0

    def squared(self, vectors: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """The exact squared distance of each vector to the centroid of that number."""
        gaps = vectors - self.places[numbers]
        return np.einsum("ij,ij->i", gaps, gaps)


def search(
    vectors: np.ndarray,
    nearest: np.ndarray,
    second: np.ndarray,
    upper: np.ndarray,
    lower: np.ndarray,
    centroids: Centroids,
) -> int:
    """Bring the four arrays, which describe the vectors before the centroids moved, up to date in
    place; returns how many distances were computed."""
    k = len(centroids.places)
    if k == 1:
        return 0
    upper += centroids.moved[nearest]
    lower -= centroids.others_moved[nearest]
    apart = np.maximum(lower, centroids.half_gap[nearest])
    rows = np.flatnonzero(~(upper * (1 + MARGIN) < apart))
    tight = centroids.squared(vectors[rows], nearest[rows])
    measured = len(rows)
    upper[rows] = np.sqrt(tight)
    open_ = ~(upper[rows] * (1 + MARGIN) < apart[rows])
    rows, first = rows[open_], tight[open_]
    if not len(rows):
        return measured
    x, a, b = vectors[rows], nearest[rows], second[rows]
    other = centroids.squared(x, b)
    measured += len(rows)
    swap = (other < first) | ((other == first) & (b < a))
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    first, other = np.where(swap, other, first), np.where(swap, first, other)
    middle, to_middle, known = a.copy(), np.sqrt(first), b.copy()
    active = np.arange(len(rows))
    for rank in range(1, k):
        candidate = centroids.order[middle[active], rank]
        radius = (to_middle[active] + np.sqrt(other[active])) * (1 + MARGIN)
        inside = centroids.apart[middle[active], candidate] <= radius
        active, candidate = active[inside], candidate[inside]
        if not len(active):
            break
        fresh = candidate != known[active]
        at, c = active[fresh], candidate[fresh]
        d = centroids.squared(x[at], c)
        measured += len(at)
        leads = (d < first[at]) | ((d == first[at]) & (c < a[at]))
        follows = ~leads & (d < other[at])
        up, down = at[leads], at[follows]
        b[up], other[up] = a[up], first[up]
        a[up], first[up] = c[leads], d[leads]
        b[down], other[down] = c[follows], d[follows]
    nearest[rows], second[rows] = a, b
    upper[rows], lower[rows] = np.sqrt(first), np.sqrt(other)
    return measured


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), dims).astype(np.int64)


def _assign(state: DataFrame, places: np.ndarray, before: np.ndarray | None) -> DataFrame:
    """The state after the centroids have come to ``places``."""
    dims = places.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = Centroids(places, before)
        for batch in batches:
            if not batch.num_rows:
                continue
            known = [batch.column(i).to_numpy(zero_copy_only=False).copy() for i in range(2, 6)]
            search(matrix(batch.column(1), dims), *known, centroids)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *map(pa.array, known)], names=batch.schema.names
            )

    return state.mapInArrow(run, STATE)


def whole_vectors(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """vec_id and ``v``, the floors of the scaled components, of the vectors that are complete."""
    too_far = "cast(raise_error('a component is beyond 2 ** 27 after scaling') AS int)"
    return vectors.select("vec_id", F.col("embedding").alias("e")).where(
        f"size(e) = {dims} AND forall(e, x -> x IS NOT NULL AND NOT isnan(x)"
        " AND abs(x) < double('infinity'))"
    ).selectExpr(
        "cast(vec_id AS bigint) AS vec_id",
        f"transform(e, x -> floor({scale} * cast(x AS double))) AS e",
    ).selectExpr(
        "vec_id",
        f"transform(e, x -> if(abs(x) <= {LIMIT}L, cast(x AS int), {too_far})) AS v",
    )


def first_centroids(whole: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors with the smallest digests of seed and vec_id, in their order."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = (
        whole.select(digest.alias("digest"), "v")
        .orderBy(F.asc_nulls_last("digest"), "v")
        .limit(clusters)
        .collect()
    )
    return np.array([row["v"] for row in rows], np.int64)


def _moved(state: DataFrame, places: np.ndarray) -> np.ndarray:
    """Every centroid at the floor of the mean of its vectors, empty ones where they were."""
    dims = places.shape[1]
    sums = state.groupBy("nearest").agg(
        F.count("*").alias("n"), *[F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(dims)]
    )
    after = places.copy()
    for row in sums.collect():
        after[row["nearest"]] = [row[f"s{i}"] // row["n"] for i in range(dims)]
    return after


def cluster(
    vectors: DataFrame,
    clusters: int = 16,
    rounds: int = 3,
    dims: int = 64,
    scale: int = 64,
    seed: int = 1,
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) for each complete vector, and the final centroids.

    Each of ``rounds`` rounds assigns all vectors and moves the centroids; then all are assigned
    once more. ``distance`` is squared. ``clusters`` x ``dims`` numbers must fit a task.
    """
    whole = whole_vectors(vectors, dims, scale)
    places = first_centroids(whole, clusters, seed)
    if not len(places):
        none = whole.where("false").selectExpr("vec_id", "0 AS cluster", "0L AS distance")
        return none, places
    second = min(1, len(places) - 1)
    state = whole.selectExpr(
        "*", "0 AS nearest", f"{second} AS second", "double('infinity') AS upper",
        "-double('infinity') AS lower",
    )
    before = None
    for _ in range(rounds):
        state = stored(_assign(state, places, before), "cluster-round")
        before, places = places, _moved(state, places)
    state = _assign(state, places, before)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = Centroids(places)
        for batch in batches:
            if batch.num_rows:
                nearest = batch.column(2).to_numpy()
                distance = centroids.squared(matrix(batch.column(1), dims), nearest)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(distance)],
                    names=["vec_id", "cluster", "distance"],
                )

    measured = state.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")
    return stored(measured, "clusters"), places


def clusters_with_sums(vectors: DataFrame, **settings) -> DataFrame:
    """``cluster`` with the sums of the distances and the digest of each vector's centroid. The side
    that is joined has one row per centroid."""
    found, places = cluster(vectors, **settings)
    digests = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in places.tolist()]
    sums = {row["cluster"]: row["s"] for row in
            found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    total = sum(sums.values())
    per_cluster = found.sparkSession.createDataFrame(
        [(c, s, total, digests[c]) for c, s in sums.items()],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    return found.join(F.broadcast(per_cluster), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _oracle(clusters: int = 16, rounds: int = 3, dims: int = 64) -> str:
    """Plain rounds: all distances, in long form."""
    steps = []
    for n in range(rounds + 1):
        steps.append(f"""d{n} AS MATERIALIZED (SELECT w.r, c.c, sum((w.x - c.x) * (w.x - c.x)) AS d
  FROM w JOIN c{n} c USING (i) GROUP BY w.r, c.c),
a{n} AS MATERIALIZED (SELECT r, min_by(c, d * {clusters} + c) AS c, min(d) AS d FROM d{n} GROUP BY r)""")
        if n < rounds:
            steps.append(f"""m{n} AS (SELECT a.c, w.i, sum(w.x)::BIGINT AS s, count(*) AS n
  FROM a{n} a JOIN w USING (r) GROUP BY a.c, w.i),
c{n + 1} AS MATERIALIZED (SELECT c.c, c.i, CASE WHEN n IS NULL THEN x
  ELSE (s - ((s % n) + n) % n) // n END AS x FROM c{n} c LEFT JOIN m{n} m ON m.c = c.c AND m.i = c.i)""")
    return f"""WITH k AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, embedding AS e FROM embeddings
  WHERE len(embedding) = {dims} AND len([x FOR x IN embedding IF isfinite(x)]) = {dims}),
w AS MATERIALIZED (SELECT r, unnest(range({dims})) AS i,
  unnest([CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN e]) AS x FROM k),
f AS (SELECT r, row_number() OVER (ORDER BY sha256('1:' || vec_id), e) - 1 AS c FROM k),
c0 AS MATERIALIZED (SELECT c, i, x FROM f JOIN w USING (r) WHERE c < {clusters}),
{", ".join(steps)},
h AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256
  FROM c{rounds} GROUP BY c)
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
  CAST(sum(d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} a JOIN k USING (r) JOIN h ON h.c = a.c"""


@query("op13_centroid_clustering", _oracle())
def op13_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return clusters_with_sums(table(spark, folder, "embeddings"))
