"""Recurrences, fits and ordered operators against plain versions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from skyloom.functions import scalar as S
from skyloom.operators import cloud, interp, raster, recurrences, scorecards, stats, windows
from skyloom.plans.stages import Stage, StagedRun, deep_merge, get_path, parse_override
from skyloom.streaming import tracks


def track(spark, n=200, seed=1):
    rng = np.random.default_rng(seed)
    t = np.arange(n) * 0.5
    return spark.createDataFrame(pd.DataFrame({"k": 1, "t": t, "x": 5 * t + rng.normal(0, 2, n), "y": rng.normal(0, 2, n), "z": 50 + rng.normal(0, 4, n)}))


def test_kalman_lowers_noise_and_segments_agree(spark):
    df = track(spark, 400)
    whole = recurrences.kalman_smooth(df, ["k"], "t", ["x", "y", "z"], 0.5, [2.0, 2.0, 4.0]).orderBy("t").toPandas()
    parts = recurrences.kalman_smooth(df, ["k"], "t", ["x", "y", "z"], 0.5, [2.0, 2.0, 4.0], rows=100, margin=60).orderBy("t").toPandas()
    assert len(parts) == 400 and np.abs(whole.s_x - 5 * whole.t).std() < 1.2
    assert np.allclose(whole.s_x, parts.s_x, atol=0.05)


def test_envelope_flags_a_gross_outlier_alone(spark):
    df = track(spark).withColumn("x", F.when(F.col("t") == 20, 9000.0).otherwise(5 * F.col("t"))).withColumn("y", F.lit(0.0)).withColumn("z", F.lit(50.0))
    rows = recurrences.envelope_outliers(df, ["k"], "t", ["x", "y", "z"], 30.0, 15.0).where("outlier").collect()
    assert [r.t for r in rows] == [20.0]


def test_altitude_keeps_shape_and_datum(spark):
    df = track(spark).withColumn("baro", F.col("t") / 5).withColumn("gps", F.col("t") / 5 + 860 + (F.col("y")))
    made = recurrences.fuse_altitude(df, ["k"], "t", "gps", "baro", 0.98).orderBy("t").toPandas()
    assert np.abs(made.altitude - (made.t / 5 + 860)).max() < 2.5


def test_robust_line_and_similarity(spark):
    rng = np.random.default_rng(5)
    x = rng.uniform(0, 50, 600)
    y = 2.5 * x + 7 + rng.normal(0, 0.1, 600)
    y[::4] += rng.uniform(20, 90, 150)
    df = spark.createDataFrame(pd.DataFrame({"k": 1, "x": x, "y": y}))
    r = recurrences.scale_shift(df, "k", "x", "y", 1.0).first()
    assert r.scale == pytest.approx(2.5, abs=0.02) and r.shift == pytest.approx(7, abs=0.4) and r.inliers >= 440
    p = rng.normal(size=(60, 3))
    a = 0.7
    rot = np.array([[np.cos(a), -np.sin(a), 0], [np.sin(a), np.cos(a), 0], [0, 0, 1]])
    q = 3 * p @ rot.T + [1, 2, 3]
    df = spark.createDataFrame(pd.DataFrame(np.c_[p, q], columns=list("abcuvw")).assign(k=1))
    r = recurrences.similarity(df, ["k"], list("abc"), list("uvw")).first()
    assert r.scale == pytest.approx(3) and np.allclose(np.reshape(r.rotation, (3, 3)), rot) and np.allclose(r["shift"], [1, 2, 3])


def test_known_roll_is_found(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(size=(32, 32))
    for _ in range(2):
        a = (a + np.roll(a, 1, 0) + np.roll(a, 1, 1)) / 3
    b = np.roll(a, (2, 3), (0, 1))
    rows = [(1, i, j, float(a[i, j]), float(b[i, j])) for i in range(32) for j in range(32)]
    r = recurrences.phase_shift(spark.createDataFrame(rows, "k long, row long, col long, a double, b double"), "k", "row", "col", "a", "b").first()
    assert abs(r.d_row - 2) < 0.5 and abs(r.d_col - 3) < 0.5


def test_frames_keep_the_overlap(spark):
    df = spark.range(300).selectExpr("1 as k", "id", "id * 0.02 as travel", "cast(id % 7 as double) as score", "id % 10 = 0 as key")
    kept = recurrences.select_frames(df, ["k"], "id", "travel", "score", "key").where("selected").orderBy("id").toPandas()
    assert kept.overlap.dropna().between(0.66, 0.78).all() and len(kept) > 15


def test_exposure_chain_clamps(spark):
    df = spark.range(50).selectExpr("1 as k", "id", "1.2D as gain", "0D as bias", "id <> 10 as ok")
    made = recurrences.exposure_chain(df, ["k"], "id", "gain", "bias", "ok").orderBy("id").toPandas()
    assert made.chain_gain.max() == 2.0 and made.clamped.any() and made.rejected.tolist().index(True) == 10
    assert made.chain_gain[0] == 1 and made.chain_gain[10] == pytest.approx(made.chain_gain[9] ** 0.98)


def test_interpolation_edges(spark):
    source = spark.createDataFrame([(1, 0.0, 359.0, None), (1, 2.0, 1.0, 5.0), (2, 1.0, 10.0, 7.0)], "k long, t double, yaw double, v double")
    targets = spark.createDataFrame([(1, 1.0), (1, 3.0), (2, 9.0)], "k long, t double")
    rows = {(r.k, r.t): r for r in interp.at_times(source, targets, ["k"], "t", ["v"], ["yaw"]).collect()}
    assert rows[1, 1.0].yaw % 360 == pytest.approx(0, abs=1e-9) or rows[1, 1.0].yaw == pytest.approx(360)
    assert rows[1, 1.0].v == 5.0 and rows[1, 3.0].yaw is None and rows[2, 9.0].v == 7.0
    held = interp.at_times(source, targets, ["k"], "t", ["yaw"], clamp=True).where("t = 3").first()
    assert held.yaw == 1.0


def test_geodesy_round_trip(spark):
    df = spark.createDataFrame([(12.97, 77.59)], "lat double, lon double").withColumns({"a": F.lit(12.9), "o": F.lit(77.5), "h": F.lit(0.0)})
    e, n, _ = S.enu_wgs84("lat", "lon", F.lit(0.0), "a", "o", "h")
    lat, lon = S.geodetic_of_enu("e", "n", "a", "o", "h")
    r = df.select("*", e.alias("e"), n.alias("n")).select(lat.alias("lat"), lon.alias("lon"), S.utm_epsg("lon", "lat").alias("z"), *(c.alias(f"u{k}") for k, c in enumerate(S.utm("lon", "lat")))).first()
    assert r.lat == pytest.approx(12.97) and r.lon == pytest.approx(77.59) and r.z == 32643
    assert 700_000 < r.u0 < 800_000 and 1_430_000 < r.u1 < 1_440_000
    k = df.select(S.utm(F.lit(3.0), F.lit(0.0))[0].alias("e"), S.utm(F.lit(3.0), F.lit(45.0))[1].alias("n")).first()
    assert k.e == pytest.approx(500000) and k.n == pytest.approx(4982950.400, abs=0.01)


def test_camera_projection_inverts(spark):
    df = spark.createDataFrame([(1.0, 2.0, 10.0, [100.0, 0.0, 50.0, 0.0, 100.0, 40.0, 0.0, 0.0, 1.0], [1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 1.0])], "x double, y double, z double, k array<double>, r array<double>")
    zero = [F.lit(0.0)] * 3
    u, v, d = S.project(["x", "y", "z"], "k", "r", zero)
    r = df.select(u.alias("u"), v.alias("v"), d.alias("d"), "k", "r").select("*", *(c.alias(f"q{i}") for i, c in enumerate(S.pixel_ray("u", "v", "k", "r")))).first()
    assert (r.u, r.v, r.d) == (60.0, 60.0, 10.0) and r.q0 / r.q2 == pytest.approx(0.1) and r.q1 / r.q2 == pytest.approx(0.2)


def test_widest_angle_is_a_bounded_estimate(spark):
    rng = np.random.default_rng(4)
    p = rng.normal(size=(60, 3)) + [0, 0, 3]
    df = spark.createDataFrame(pd.DataFrame(p, columns=list("xyz")).assign(k=lambda d: d.index % 3, i=lambda d: d.index))
    for r in cloud.widest_angle(df, "k", "i", list("xyz")).collect():
        u = p[r.k :: 3] / np.linalg.norm(p[r.k :: 3], axis=1)[:, None]
        true = np.degrees(np.arccos(np.clip(u @ u.T, -1, 1))).max()
        assert true / 2 - 1e-6 <= r.angle <= true + 1e-6


def test_set_cover_components_and_opening(spark):
    pairs = spark.createDataFrame([(1, c) for c in range(10)] + [(2, c) for c in range(5, 14)] + [(3, 1)], "cam long, cell long")
    assert cloud.set_cover(pairs, "cam", "cell", 5, 2) == [1, 2]
    cells = [(0, k) for k in range(30)] + [(k, 29) for k in range(1, 20)] + [(5, 5), (6, 6), (-3, -3)]
    found = raster.components(spark.createDataFrame(cells, "row long, col long")).toPandas()
    assert sorted(found.groupby("label").size()) == [1, 2, 49]
    assert [r.cells for r in raster.regions(spark.createDataFrame(cells, "row long, col long"), 1.0, 2.0).orderBy("number").collect()] == [49, 2]


def test_dome_is_found(spark):
    rng = np.random.default_rng(0)
    x, y = rng.uniform(-5, 5, (2, 400))
    df = spark.createDataFrame(pd.DataFrame({"k": 1, "x": x, "y": y, "z": 2 + 0.1 * x - 0.2 * y + 0.03 * (x * x + y * y)}))
    r = stats.doming(df, ["k"], "x", "y", "z").first()
    assert [round(v, 6) for v in (r.offset, r.tilt_x, r.tilt_y, r.dome)] == [2.0, 0.1, -0.2, 0.03]


def test_chunks_merge_short_tails():
    assert windows.chunks(10, 4, 1) == [(0, 4), (3, 7), (6, 10)]
    assert windows.chunks(9, 4, 1) == [(0, 4), (3, 7), (6, 9)] and windows.chunks(8, 4, 1) == [(0, 4), (3, 8)] and windows.chunks(0, 4, 1) == []


def test_stages_resume_and_invalidate(spark, tmp_path):
    ran = []

    def stage(name, *settings):
        return Stage(name, lambda s, done, c: (ran.append(name), s.range(3).withColumn("v", F.lit(len(done))))[1], settings)

    stages = [stage("a", "x.y"), stage("b"), stage("c", "z")]
    config = {"x": {"y": 1}, "z": 2}
    go = lambda c, **k: StagedRun(spark, str(tmp_path), stages, c).run(**k)
    assert go(config)["c"].first().v == 2 and ran == ["a", "b", "c"]
    go(config)
    assert ran == ["a", "b", "c"]
    go(deep_merge(config, {"z": 3}))
    assert ran == ["a", "b", "c", "c"]
    go(deep_merge(config, {"z": 3, "x": {"y": 2}}))
    assert ran[4:] == ["a", "b", "c"]
    bad = [*stages[:2], Stage("c", lambda *_: 1 / 0, ("q",))]
    with pytest.raises(ZeroDivisionError):
        StagedRun(spark, str(tmp_path), bad, deep_merge(config, {"z": 3, "x": {"y": 2}})).run(force="c")
    assert {r.stage: r.status for r in StagedRun(spark, str(tmp_path), stages, config).manifest().collect()} == {"a": "done", "b": "done", "c": "failed"}
    assert parse_override("a.b=[1]") == ("a.b", [1]) and get_path(config, "x.q", 5) == 5


def test_scorecard_rows(spark):
    df = spark.createDataFrame([(1, 0.7, 0.3, 20.0, 9.0), (2, None, 0.05, 90.0, 1.0)], "v long, overlap_median double, blur_rejected double, frames_kept double, duration double")
    rows = {(r.v, r.key): r.status for r in scorecards.scorecard(df, ["v"], scorecards.CARDS["ingest"]()).collect()}
    assert rows[1, "overlap_median"] == "pass" and rows[1, "blur_rejected"] == "fail" and rows[2, "overlap_median"] == "info" and rows[2, "frames_kept"] == "fail"


def test_streams_equal_batches(spark, tmp_path):
    rng = np.random.default_rng(8)
    rows = pd.DataFrame({"k": np.repeat([1, 2], 60), "t": np.tile(np.arange(60), 2), "v": rng.normal(10, 3, 120)})
    for part in range(3):
        spark.createDataFrame(rows[rows.t // 20 == part]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("k long, t long, v double").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    for name, made in (("base", tracks.trailing_baseline(stream, "k", "t", "v", 10, 3)), ("runs", tracks.rejection_runs(stream.withColumn("bad", F.col("v") > 10), "k", "t", "bad", 1))):
        q = made.writeStream.format("parquet").option("path", f"{tmp_path}/{name}").option("checkpointLocation", f"{tmp_path}/c_{name}").trigger(availableNow=True).start()
        q.awaitTermination(120)
    batch = spark.createDataFrame(rows)
    want = windows.trailing_baseline(batch, ["k"], ["t"], "v", 10, 3).select("k", "t", F.round("baseline", 9).alias("b"))
    got = spark.read.parquet(f"{tmp_path}/base").select("k", "t", F.round("baseline", 9).alias("b"))
    assert got.count() == 120 and got.exceptAll(want).count() == 0
    runs = windows.islands(batch, ["k"], ["t"], F.col("v") > 10, "t", "t").where("n > 1")
    ended = spark.read.parquet(f"{tmp_path}/runs").select("k", "start", "end", "n")
    assert ended.exceptAll(runs.select("k", "start", "end", "n")).count() == 0 and ended.count() >= runs.count() - 2


def test_scratch_removes_what_was_written_within(spark):
    import os

    from skyloom.session import materialise, scratch

    with scratch(spark) as made:
        a = materialise(spark.range(3), "first")
        b = materialise(a.selectExpr("id + 1 as id"), "second")
        kept, gone = made.pop(), made[0]
    place = lambda p: p.removeprefix("file://")
    assert b.count() == 3 and os.path.isdir(place(kept)) and not os.path.exists(place(gone))


@pytest.mark.parametrize("many", [1_000_000, 20])
def test_quantiles_with_and_without_narrower_bins(spark, monkeypatch, many):
    import numpy as np

    monkeypatch.setattr(stats, "MANY", many)
    rng = np.random.default_rng(many)
    groups = {"a": rng.normal(0, 1, 400), "b": np.repeat([-2.5, 0.0, 3e12], 70), "c": [7.0], "d": rng.integers(-3, 3, 300) * 1e-9}
    rows = [(k, float(v)) for k, g in groups.items() for v in g] + [("a", None), (None, 1.0)]
    found = {r.k: r for r in stats.quantiles(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", [0.0, 0.13, 0.5, 1.0]).collect()}
    for k, g in groups.items():
        assert [found[k][f"q{i}"] for i in range(4)] == pytest.approx(np.quantile(g, [0.0, 0.13, 0.5, 1.0]).tolist(), rel=1e-12, abs=1e-24) and found[k].n == len(g)
