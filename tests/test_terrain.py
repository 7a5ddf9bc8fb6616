"""Linear terrain against a triangulation by brute force, over tiles and margins, and classes by height."""

from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.operators.terrain import facet, ground_classes, linear_terrain, nudges


def brute(rows, cols, z, r, c):
    """The height at (r, c) of the triangle that holds it and has no lifted point below its plane."""
    lift = rows**2 + cols**2 + nudges(rows, cols)
    for t in combinations(range(len(rows)), 3):
        t = list(t)
        a = np.stack([rows[t], cols[t], np.ones(3)], 1).astype(float)
        if abs(np.linalg.det(a)) < 1e-9:
            continue
        w = np.linalg.solve(a.T, np.array([r, c, 1.0]))
        if (w < -1e-9).any():
            continue
        p = np.linalg.solve(a, lift[t])
        if (lift - np.stack([rows, cols, np.ones(len(rows))], 1) @ p >= -1e-9).all():
            return w @ z[t]
    return None


@pytest.mark.parametrize("seed", range(12))
def test_facet(seed):
    rng = np.random.default_rng(seed)
    places = rng.permutation(64)[:18]
    rows, cols, z = places // 8, places % 8, rng.normal(0, 1, 18)
    for q in rng.permutation(np.setdiff1d(np.arange(64), places))[:10]:
        got, want = facet(rows, cols, int(q // 8), int(q % 8)), brute(rows, cols, z, q // 8, q % 8)
        assert (got is None) == (want is None)
        if got:
            assert got[1] @ z[got[0]] == pytest.approx(want, abs=1e-9)


@pytest.fixture(scope="module")
def raster():
    rng = np.random.default_rng(3)
    z = rng.normal(0, 1, (40, 44)).round(3)
    ground = rng.random((40, 44)) < 0.8
    ground[8:22, 10:27] = False  # wider than a tile
    ground[30:, :3] = False  # a corner outside the hull
    return z, ground


def cells(spark, z, ground):
    rows = [(1, r, c, float(z[r, c]), bool(ground[r, c])) for r in range(z.shape[0]) for c in range(z.shape[1])]
    return spark.createDataFrame(rows, "k int, row int, col int, z double, on boolean")


def test_tiles_agree_with_one_triangulation(spark, raster):
    z, ground = raster
    small = linear_terrain(cells(spark, z, ground), ["k"], "z", F.col("on"), tile=8, reach=64).collect()
    rows, cols = np.nonzero(ground)
    assert len(small) == z.size
    nearest = 0
    for r in small:
        if ground[r.row, r.col]:
            assert r.terrain == z[r.row, r.col]
            continue
        got = facet(rows, cols, r.row, r.col)
        if got is None:
            nearest += 1
            d = (rows - r.row) ** 2 + (cols - r.col) ** 2
            assert not r.linear and r.terrain in z[rows[d == d.min()], cols[d == d.min()]]
        else:
            assert r.linear and r.terrain == pytest.approx(got[1] @ z[rows, cols][got[0]], abs=1e-9)
    assert 0 < nearest < 60


def test_planes_come_back_and_no_ground_gives_none(spark, raster):
    ground = raster[1]
    y, x = np.mgrid[:40, :44]
    plane = 3 + 0.25 * y - 0.5 * x
    for r in linear_terrain(cells(spark, np.where(ground, plane, 99), ground), ["k"], "z", F.col("on"), tile=16).where("linear").collect():
        assert r.terrain == pytest.approx(plane[r.row, r.col], abs=1e-9)
    none = linear_terrain(cells(spark, plane[:3, :3], ground[:3, :3] & False), ["k"], "z", F.col("on"), tile=16, reach=16).collect()
    assert [r.terrain for r in none] == [None] * 9


def test_classes(spark):
    points = spark.createDataFrame([(1, 0, 0, z) for z in (10.0, 10.5, 10.6, 9.6, 8.1, 7.9)] + [(1, 5, 5, 1.0)], "k int, row long, col long, z double")
    terrain = spark.createDataFrame([(1, 0, 0, 10.0)], "k int, row long, col long, terrain double")
    rows = ground_classes(points, terrain, ["k"], "z").orderBy(F.desc("z")).collect()
    assert [r["class"] for r in rows] == [1, 2, 2, 2, 1, 7, 1]
