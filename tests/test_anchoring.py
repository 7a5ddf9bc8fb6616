"""Distance transforms against brute force; anchored depth on planted scales, shifts, holes and steps."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.operators.anchoring import AnchorLimits, anchor_frames, consensus_lines
from skyloom.operators.distance import lower_envelope, nearest_cells

LIMITS = AnchorLimits(least_region=20, least_band=30, band=4, pairs=64, blend=8, near=0.05, near_share=0.0)


@pytest.mark.parametrize("seed", range(30))
def test_lower_envelope(seed):
    rng = random.Random(seed)
    columns = sorted(rng.sample(range(-20, 60), rng.randrange(1, 40)))
    seeds = sorted(rng.sample(range(-20, 60), rng.randrange(1, 30)))
    heights = [rng.randrange(40) ** 2 for _ in seeds]
    want = [min(range(len(seeds)), key=lambda k: ((c - seeds[k]) ** 2 + heights[k], k)) for c in columns]
    assert lower_envelope(columns, seeds, heights) == want


def test_nearest_cells(spark):
    rng = np.random.default_rng(1)
    rows = [(k, r, c, bool(rng.random() < (0.05, 0.4, 0.0)[k])) for k in range(3) for r in range(17) for c in range(23)]
    df = spark.createDataFrame(rows, "k int, row int, col int, on boolean")
    for r in nearest_cells(df, ["k"], "row", "col", F.col("on")).collect():
        near = [((r.row - y) ** 2 + (r.col - x) ** 2, x, y) for k, y, x, on in rows if k == r.k and on]
        want = min(near) if near else (None, None, None)
        assert (r.d2, r.near_col, r.near_row) == want


def frame(spark, mono_of, hole=True, n=48, seed=0, step=0.0):
    """A slanted surface with a square hole; ``mono_of(truth)`` is the depth of unknown scale."""
    rng = np.random.default_rng(seed)
    y, x = np.mgrid[:n, :n]
    truth = 50 + 0.05 * x + 0.1 * np.sin(y / 5)
    inside = (abs(x - 24) < 7) & (abs(y - 22) < 6)
    mono = mono_of(truth + np.where(inside, step, 0), rng)
    rows = [(1, int(r), int(c), float(mono[r, c]), 1.0, None if hole and inside[r, c] else float(truth[r, c])) for r in range(n) for c in range(n)]
    return spark.createDataFrame(rows, "frame int, row int, col int, mono double, conf double, measured double"), truth, int(inside.sum())


def test_a_planted_scale_is_found_and_the_hidden_surface_too(spark):
    pixels, truth, n = frame(spark, lambda d, rng: (d - 12) / 25 + np.where(rng.random(d.shape) < 0.2, rng.uniform(-1, 1, d.shape), 0))
    report, filled = anchor_frames(pixels, LIMITS)
    r, rows = report.first(), filled.collect()
    assert r.status == "anchored" and r.scale == pytest.approx(25, rel=0.02) and r.shift == pytest.approx(12, abs=1)
    assert r.holdout_pct < 0.5 and 0.7 < r.inlier_share < 0.95
    assert len(rows) > 0.6 * n  # outliers that leave the band's depths are dropped
    assert np.median([abs(x.depth - truth[x.row, x.col]) for x in rows]) < 0.05
    assert max(x.weight for x in rows) <= LIMITS.most_weight


def test_no_step_at_the_seam(spark):
    # half the frame reads 0.4 too deep: the fit lies between, the misfit of the nearest band pixel closes the step
    pixels, truth, _ = frame(spark, lambda d, rng: (d + 0.4 * (np.mgrid[:48, :48][1] < 24) - 12) / 25)
    rows = anchor_frames(pixels, AnchorLimits(**{**LIMITS.__dict__, "near": 0.5}))[1].collect()
    edge = [abs(x.depth - truth[x.row, x.col]) for x in rows if x.col in (18, 30)]
    assert edge and max(edge) < 0.1


@pytest.mark.parametrize(
    "mono, hole, limits, expected, status, reason",
    [
        (lambda d, rng: rng.uniform(1, 2, d.shape), True, AnchorLimits(**{**LIMITS.__dict__, "near": 0.02, "near_share": 0.0}), None, "refused", "too few agree"),
        (lambda d, rng: (d - 12) / 25, False, LIMITS, None, "skipped", "nothing to fill"),
        (lambda d, rng: (d - 12) / 25, True, LIMITS, 1.0, "refused", "scale is not the expected one"),
        (lambda d, rng: (d - 12) / 25, True, LIMITS, 24.0, "anchored", None),
        (lambda d, rng: -d, True, LIMITS, None, "skipped", "nothing to fill"),
        # right on the band, wrong on the ring behind it
        (lambda d, rng: (d + 3 * ((abs(np.mgrid[:48, :48][1] - 24) > 10) | (abs(np.mgrid[:48, :48][0] - 22) > 9)) - 12) / 25, True, AnchorLimits(**{**LIMITS.__dict__, "holdout_share": 0.01}), None, "refused", "held-out ring missed"),
    ],
)
def test_gates(spark, mono, hole, limits, expected, status, reason):
    pixels, _, _ = frame(spark, mono, hole)
    report, filled = anchor_frames(pixels, limits, expected)
    assert (report.first().status, report.first().reason) == (status, reason)
    assert (filled.count() > 0) == (status == "anchored")


def test_depths_far_from_the_band_are_dropped(spark):
    pixels, _, n = frame(spark, lambda d, rng: (d - 12) / 25, step=20.0)
    report, filled = anchor_frames(pixels, LIMITS)
    assert report.first().status == "anchored" and filled.count() < 0.1 * n


def test_consensus_survives_outliers(spark):
    rng = np.random.default_rng(0)
    x = rng.uniform(1, 3, 2000)
    y = 20 * x + 7 + rng.normal(0, 0.05, 2000) + np.where(rng.random(2000) < 0.3, rng.uniform(-20, 20, 2000), 0)
    df = spark.createDataFrame([(i % 1, i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))], "k int, i int, x double, y double")
    r = consensus_lines(df, "k", "x", "y", F.lit(0.25), ["i"], 128).first()
    assert r.scale == pytest.approx(20, rel=0.01) and r.shift == pytest.approx(7, abs=0.1)
    assert consensus_lines(df.where("i = 0"), "k", "x", "y", F.lit(0.25), ["i"], 128).count() == 0


def test_halves_are_rounded_as_in_the_sql(spark):
    """Values whose shortest decimals are just below a half, as of a median of two values with six decimals."""
    duckdb = pytest.importorskip("duckdb")
    from skyloom.plans.tables import halves_up

    values = [float(np.nextafter(k / 1e6 + 46, side)) for k in range(5, 2000, 10) for side in (0, 99)]
    values += [-v for v in values]
    got = spark.createDataFrame([(v,) for v in values], "v double").select(halves_up(F.col("v"), 5).alias("new"), F.round("v", 5).alias("old")).collect()
    want = [duckdb.execute("select round(?::double, 5)", [v]).fetchone()[0] for v in values]
    assert [r.new for r in got] == want and [r.old for r in got] != want
