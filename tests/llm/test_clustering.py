from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from starloom.llm.clustering import Centroids, cluster, clusters_with_sums, search

SCHEMA = "vec_id bigint, embedding array<float>, label int, v string, nearest string, cluster string"


@pytest.fixture
def vectors(spark):
    def make(rows, partitions=3):
        full = [(i, e, None, None, None, None) for i, e in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(partitions)

    return make


def expected(rows, clusters, rounds, dims):
    """Every distance of every round, in Python's integers."""
    kept = [
        (i, [math.floor(64 * x) for x in e])
        for i, e in rows
        if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)
    ]
    first = sorted(
        kept,
        key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]),
    )
    places = [v for _, v in first[:clusters]]

    def assigned():
        out = []
        for _, v in kept:
            distances = [sum((a - b) ** 2 for a, b in zip(v, p)) for p in places]
            out.append((distances.index(min(distances)), min(distances)))
        return out

    for _ in range(rounds):
        at = [c for c, _ in assigned()]
        for c in set(at):
            members = [v for (_, v), own in zip(kept, at) if own == c]
            places[c] = [sum(column) // len(members) for column in zip(*members)]
    return [(i, c, d) for (i, _), (c, d) in zip(kept, assigned())], places


def points(n, dims, seed, step=1.0):
    """Points around few centres; with a step they lie on a grid, which makes ties."""
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(6)]
    out = []
    for i in range(n):
        at = rng.choice(centres[: 1 + i % 6])
        out.append((i, [round((x + rng.gauss(0, 0.2)) / step) * step for x in at]))
    return out


@pytest.mark.parametrize("step", [1 / 64, 0.5])
def test_against_all_distances(vectors, collected, step):
    rows = points(700, 8, 3, step) + [(5, [0.0] * 8), (5, [0.5] * 8)]
    found, places = cluster(vectors(rows, 5), clusters=16, rounds=3, dims=8)
    by_hand, final = expected(rows, 16, 3, 8)
    assert collected(found) == sorted(by_hand, key=repr)
    assert places.tolist() == final


def test_sums_and_digests(vectors):
    rows = points(200, 4, 9)
    by_hand, final = expected(rows, 5, 2, 4)
    got = clusters_with_sums(vectors(rows), clusters=5, rounds=2, dims=4).collect()
    assert sorted((r.vec_id, r.cluster, r.distance) for r in got) == sorted(by_hand)
    for r in got:
        assert r.cluster_inertia == sum(d for _, c, d in by_hand if c == r.cluster)
        assert r.inertia == sum(d for _, _, d in by_hand)
        text = ",".join(map(str, final[r.cluster]))
        assert r.centroid_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_most_distances_are_left_out():
    """From the second round on bounds settle most vectors; results stay those of all distances."""
    rng = np.random.default_rng(2)
    centres = rng.integers(-300, 300, (16, 6))
    x = centres[rng.integers(0, 16, 4000)] + rng.integers(-20, 20, (4000, 6))
    state = [np.zeros(4000, int), np.ones(4000, int), np.full(4000, np.inf), np.full(4000, -np.inf)]
    places, before, measured = centres + rng.integers(-60, 60, centres.shape), None, []
    for _ in range(5):
        now = Centroids(places, before)
        measured.append(search(x, *state, now))
        distances = ((x[:, None] - places[None]) ** 2).sum(2)
        assert (state[0] == distances.argmin(1)).all()
        rest = np.where(np.arange(16) == state[0][:, None], np.inf, np.sqrt(distances)).min(1)
        assert (state[3] <= rest * (1 + 1e-9)).all()
        assert (state[2] >= np.sqrt(distances.min(1)) * (1 - 1e-9)).all()
        before, places = places, np.stack([
            x[state[0] == c].sum(0) // max(1, (state[0] == c).sum()) if (state[0] == c).any()
            else places[c] for c in range(16)
        ])
    assert measured[-1] < 1.5 * 4000


def test_odd_vectors(vectors, collected):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [1.0]), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [1.0, -inf]),
        (7, [1.0, 2.0]), (7, [1.0, 2.0]), (8, [1.0, 2.0]), (None, [-3.0, 2.5]), (None, None),
        (9, [1.0, 2.0, 3.0]), (10, [-0.001, 0.0]),
    ]
    found, places = cluster(vectors(rows), clusters=3, rounds=3, dims=2)
    by_hand, final = expected(rows, 3, 3, 2)
    assert collected(found) == sorted(by_hand, key=repr)
    assert places.tolist() == final
    # Copies of one vector are nearest to the first of the equal centroids.
    assert len({c for i, c, _ in by_hand if i in (7, 8)}) == 1


def test_fewer_vectors_than_clusters(vectors, collected):
    rows = [(1, [0.0, 1.0]), (2, [5.0, 5.0])]
    found, places = cluster(vectors(rows), clusters=16, rounds=3, dims=2)
    assert sorted(r[2] for r in collected(found)) == [0, 0] and len(places) == 2
    assert len(cluster(vectors(rows[:1]), dims=2)[1]) == 1


def test_no_vectors(vectors):
    assert clusters_with_sums(vectors([])).collect() == []
    assert clusters_with_sums(vectors([(1, None)])).columns == [
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256",
    ]


def test_components_that_do_not_fit(vectors):
    with pytest.raises(Exception, match="beyond 2"):
        cluster(vectors([(1, [3e8, 0.0])]), dims=2)[0].collect()
