"""Rendering, images, multi-view and composed operators."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skyloom.functions import scalar as S
from skyloom.operators import checks, compose, images, recurrences, render


def test_ortho_takes_the_highest_surface(spark):
    rows = [("low", 0.0, 0.0, 1.0, 4.0, 0.0, 1.0, 0.0, 4.0, 1.0), ("high", 0.0, 0.0, 5.0, 2.0, 0.0, 5.0, 0.0, 2.0, 5.0)]
    df = spark.createDataFrame(rows, "name string, x0 double, y0 double, z0 double, x1 double, y1 double, z1 double, x2 double, y2 double, z2 double")
    got = {(r.row, r.col): (r.z, r.name) for r in render.render_ortho(df, "name", 1.0).collect()}
    assert got[0, 0] == (5.0, "high") and got[2, 0] == (1.0, "low") and (3, 3) not in got
    assert render.oversized(df, 1.0, 10).first().oversized == 1


def test_overlap_of_a_transform(spark):
    df = spark.createDataFrame([([1.0, 0.0, 30.0, 0.0, 1.0, 0.0],), ([1.0, 0.0, 0.0, 0.0, 1.0, 50.0],), ([0.0, -1.0, 100.0, 1.0, 0.0, 0.0],), ([1.0, 0.0, 500.0, 0.0, 1.0, 0.0],), (None,)], "m array<double>")
    got = [r.o for r in df.select(render.overlap_of_transform("m", F.lit(100.0), F.lit(100.0)).alias("o")).collect()]
    assert got[:4] == pytest.approx([0.7, 0.5, 1.0, 0.0]) and got[4] is None


def test_triangulation(spark):
    rng = np.random.default_rng(6)
    rows = []
    for k in range(5):
        p = rng.normal(size=3) + [0, 0, 10]
        for t in range(4):
            rows.append((k, float((p[0] - t) / p[2]), float(p[1] / p[2]), [float(x) for x in (1, 0, 0, -t, 0, 1, 0, 0, 0, 0, 1, 0)], *map(float, p)))
    df = spark.createDataFrame(rows, "k long, u double, v double, p array<double>, x0 double, y0 double, z0 double")
    for r in render.triangulate(df, "k", "u", "v", "p").join(df.select("k", "x0", "y0", "z0").distinct(), "k").collect():
        assert (r.x, r.y, r.z) == pytest.approx((r.x0, r.y0, r.z0), abs=1e-6) and r.rms_px < 1e-6


def test_image_statistics(spark):
    rng = np.random.default_rng(1)
    noise = rng.normal(128, 20, (32, 32))
    blocks = np.kron(rng.normal(128, 20, (4, 4)), np.ones((8, 8)))
    stripes = np.tile(np.sin(np.arange(32)) * 50, (32, 1))
    rows = [(n, g.ravel().tolist(), 32) for n, g in (("noise", noise), ("blocks", blocks), ("stripes", stripes))] + [("none", None, 8), ("tiny", [1.0], 1)]
    df = spark.createDataFrame(rows, "n string, p array<double>, w int")
    got = {r.n: r for r in df.select("n", images.variance_of_laplacian("p", "w").alias("s"), images.blockiness("p", "w").alias("b"), images.anisotropy("p", "w").alias("a"), images.texture_variance("p", "w").alias("t")).collect()}
    lap = noise[:-2, 1:-1] + noise[2:, 1:-1] + noise[1:-1, :-2] + noise[1:-1, 2:] - 4 * noise[1:-1, 1:-1]
    assert got["noise"].s == pytest.approx(lap.var()) and got["blocks"].b > 100 and 0.8 < got["noise"].b < 1.3
    assert got["stripes"].a > 0.9 and got["noise"].a < 0.3 and got["none"].s is None and got["tiny"].t is None


def test_track_is_conditioned(spark):
    t = np.arange(120) * 0.5
    df = pd.DataFrame({"k": 1, "t": t, "lat": 12.9 + t * 4e-5, "lon": 77.5 + 0 * t, "alt": 900.0})
    df.loc[60, "lat"] = 13.5
    made = compose.condition_track(spark.createDataFrame(df), ["k"], "t", max_speed=30.0, max_accel=15.0, tolerance=15.0).orderBy("t").toPandas()
    assert (made["flags"] & S.FLAGS["outlier"] != 0).sum() == 1 and made["flags"][60] & S.FLAGS["outlier"]
    assert np.abs(made.lat - (12.9 + made.t * 4e-5)).max() < 5e-5


def test_noise_follows_from_ids(spark):
    df = spark.range(4000).selectExpr("id", "0D as x")
    a = checks.noisy_fixes(df, "id", ["x"], 2.0, 0.01, 100.0).toPandas().set_index("id").x
    b = checks.noisy_fixes(df.repartition(7), "id", ["x"], 2.0, 0.01, 100.0).toPandas().set_index("id").x
    assert (a.sort_index() == b.sort_index()).all() and 15 < (a.abs() > 50).sum() < 80 and 1.9 < a[a.abs() < 50].std() < 2.1


def test_fallbacks_and_history(spark, tmp_path):
    assert compose.read_or_empty(spark, f"{tmp_path}/none", "a long").count() == 0
    rows = spark.createDataFrame([("s", 2.0), ("s", 1.0), ("t", 5.0)], "stage string, started double")
    rows.write.mode("append").json(f"{tmp_path}/h")
    assert [(r.started, r.run) for r in compose.load_history(spark, f"{tmp_path}/h", "stage string, started double", "s").orderBy("run").collect()] == [(1.0, 1), (2.0, 2)]
    assert compose.load_history(spark, f"{tmp_path}/x", "stage string, started double").count() == 0


def test_samples_keep_their_gap(spark):
    df = spark.range(100).selectExpr("1 as k", "id * 0.3D as t")
    t = [r.t for r in recurrences.gap_sampled(df, ["k"], "t", 1.0).orderBy("t").collect()]
    assert min(np.diff(t)) >= 1.0 and len(t) == 25
