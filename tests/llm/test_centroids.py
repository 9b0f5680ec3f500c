"""Centroid clustering against plain Python, the bounds against true distances, and odd tables."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from sediment.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, cluster string, v string, distance int"


def plain(rows, k, rounds, dims, scale):
    """[(vec_id, cluster, distance, cluster_inertia, inertia, hash)] by comparing everything with everything."""
    kept = []
    for i, x in rows:
        if x is not None and len(x) == dims and all(y is not None and math.isfinite(y) for y in x):
            kept.append((i, [math.floor(scale * float(np.float32(y))) for y in x]))
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "null", r[1]))
    centres = [v for _, v in order[:k]]

    def closest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(closest(v)[1], []).append(v)
        for n, vs in groups.items():
            centres[n] = [sum(x) // len(vs) for x in zip(*vs)]
    found = [(i, *closest(v)[::-1]) for i, v in kept]
    inertia = {n: sum(d for _, m, d in found if m == n) for n in range(len(centres))}
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted([(i, n, d, inertia[n], sum(inertia.values()), hashes[n]) for i, n, d in found], key=str)


def run(spark, rows, **how):
    df = spark.createDataFrame([(i, x, "a", "b", 1) for i, x in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, centroids.clusters(df, **how).collect()), key=str)


@pytest.mark.parametrize("dims, k, pivots", [(2, 5, 1), (8, 16, 4), (64, 16, 8), (64, 3, 8), (1, 4, 3)])
def test_against_plain(spark, dims, k, pivots):
    rng = random.Random(dims * k)
    middles = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    rows = [(i, [rng.gauss(m, 0.3) for m in rng.choice(middles)]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]  # a group of equal vectors
    how = {"k": k, "rounds": 3, "dims": dims, "scale": 64}
    assert run(spark, rows, pivots=pivots, **how) == plain(rows, **how)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (1, [0.25, 1.0]), (2, [nan, 0.0]), (3, [inf, 0.0]), (4, None), (5, [])]
    rows += [(6, [1.0]), (7, [1.0, None]), (8, [1.0, 2.0, 3.0]), (None, [-0.01, -3.0]), (None, [0.0, 0.0]), (9, [-inf, 1.0])]
    for k in (1, 2, 16):
        how = {"k": k, "rounds": 2, "dims": 2, "scale": 64}
        assert run(spark, rows, **how) == plain(rows, **how)


def test_no_rows(spark):
    for rows in ([], [(1, None)]):
        df = spark.createDataFrame([(i, x, "a", "b", 1) for i, x in rows], SCHEMA)
        found = centroids.clusters(df)
        assert found.collect() == []
        assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_large_components_stop(spark):
    with pytest.raises(PySparkException, match="a component is"):
        run(spark, [(1, [1e9, 0.0])], dims=2)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 12), st.integers(1, 9), st.integers(0, 10**6), st.sampled_from([2, 30, 10**4, 2**25]))
def test_bounds_hold(dims, pivots, seed, size):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-size, size, (60, dims))
    centres = np.vstack([vectors[:6], rng.integers(-size, size, (5, dims))])
    simplex = centroids.Simplex.of(centres, pivots)
    apexes, tops = simplex.apexes(vectors), simplex.apexes(centres)
    squares = ((vectors[:, None] - centres[None]) ** 2).sum(axis=2)
    numbers, least = centroids.nearest(vectors, apexes, centres, tops)
    assert (least == squares.min(axis=1)).all() and (numbers == squares.argmin(axis=1)).all()
    possible = centroids.candidates(apexes, tops)
    assert possible[np.arange(60), numbers].all()


def test_bounds_rule_centroids_out():
    rng = np.random.default_rng(3)
    middles = rng.normal(0, 64, (16, 64))
    vectors = (middles[rng.integers(0, 16, 2000)] + rng.normal(0, 12, (2000, 64))).astype(np.int64)
    centres = middles.astype(np.int64)
    simplex = centroids.Simplex.of(centres, 8)
    possible = centroids.candidates(simplex.apexes(vectors), simplex.apexes(centres))
    assert possible.mean() < 0.5
