"""Operator 12 against a plain version in Python integers."""

import hashlib
from math import floor

import numpy as np
import pytest

from skyloom.llm.centroids import _squared, cluster, integer_vectors, lower_bounds, nearest, op12_centroids, pivot_pairs

SCHEMA = "vec_id long, embedding array<double>, cluster int, away double, v string"


def plain(vectors, k, rounds, seed):
    order = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in vectors if i is not None)
    centroids = [v for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        own = {}
        for _, v in vectors:
            own.setdefault(near(v)[1], []).append(v)
        centroids = [[sum(x) // len(own[j]) for x in zip(*own[j])] if j in own else c for j, c in enumerate(centroids)]
    return sorted(((i, near(v)[1], near(v)[0]) for i, v in vectors), key=str), centroids


def rows_of(n, dims, seed):
    rng = np.random.default_rng(seed)
    middles = rng.normal(0, 1, (5, dims))
    rows = [(i, (middles[rng.integers(5)] + rng.normal(0, 0.2, dims)).tolist()) for i in range(n)]
    return rows + [rows[0], rows[0], (None, rows[1][1]), (n + 1, rows[2][1])]  # repeats, a null id, an equal vector


@pytest.mark.parametrize("n, k", [(200, 4), (3, 8), (0, 4)])
def test_against_plain(spark, n, k):
    rows = rows_of(n, 6, n) if n else []
    odd = [(900, None), (901, []), (902, [1.0] * 5), (903, [None] + [1.0] * 5), (904, [float("nan")] * 6), (905, [float("-inf")] * 6)]
    df = spark.createDataFrame([(*r, 1, 2.0, "x") for r in rows + odd], SCHEMA)
    found, centroids = cluster(integer_vectors(df, 6, 1024), k, 5, 3, 6)
    want, middle = plain([(i, [floor(1024 * x) for x in v]) for i, v in rows], k, 5, 3)
    assert sorted((tuple(r) for r in found.collect()), key=str) == want
    assert centroids.tolist() == middle


@pytest.mark.parametrize("spread", [1, 1000, 1 << 26])
def test_bounds_never_rule_out_the_nearest(spread):
    rng = np.random.default_rng(spread)
    x, c = rng.integers(-spread, spread, (500, 8)), rng.integers(-spread, spread, (6, 8))
    x[:50] = c[rng.integers(6, size=50)]  # distance zero, and ties between equal centroids
    c[5] = c[4]
    p = np.concatenate([c[:2], x[:6]])
    pairs = pivot_pairs(p, 12)
    xp, cp = np.sqrt(_squared(x, p).astype(float)), np.sqrt(_squared(c, p).astype(float))
    exact = _squared(x, c)
    assert (lower_bounds(xp, cp, pairs) <= np.sqrt(exact.astype(float)) * (1 + 1e-15)).all()
    found, distance, measured = nearest(x, xp, c, cp, pairs)
    assert (found == exact.argmin(1)).all() and (distance == exact.min(1)).all()
    assert measured <= exact.size
    assert nearest(x, xp, c, cp, [])[2] == exact.size  # no pairs, no bounds


def test_bounds_spare_distances():
    rng = np.random.default_rng(1)
    middles = rng.normal(0, 1000, (8, 16))
    x = (middles[rng.integers(8, size=2000)] + rng.normal(0, 40, (2000, 16))).astype(int)
    c, p = middles.astype(int), x[:12]
    xp, cp = np.sqrt(_squared(x, p).astype(float)), np.sqrt(_squared(c, p).astype(float))
    assert nearest(x, xp, c, cp, pivot_pairs(p))[2] < 0.5 * x.shape[0] * 8


def test_out_of_range(spark):
    df = spark.createDataFrame([(1, [1e9, 0.0], 1, 2.0, "x")], SCHEMA)
    with pytest.raises(Exception, match="out of range"):
        integer_vectors(df, 2, 1024).collect()


def test_query_on_no_vectors(spark, tmp_path):
    spark.createDataFrame([(1, None, 1, 2.0, "x")], SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    assert op12_centroids(spark, str(tmp_path)).collect() == []
