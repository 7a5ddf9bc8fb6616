"""Rigid pairs on planted scenes: relief, a plane, moving points, a warp that no rigid scene explains."""

import numpy as np
import pytest

from skyloom.operators.rigid import rigid_pairs

W, H, N = 640, 480, 240


def views(seed, plane=False, moving=0.0, warp=0.0, turn=0.0, noise=0.2):
    rng = np.random.default_rng(seed)
    x, y = rng.uniform(0, W, N), rng.uniform(0, H, N)
    z = np.full(N, 50.0) if plane else rng.uniform(25, 80, N)
    ray = np.stack([(x - W / 2) / 600, (y - H / 2) / 600, np.ones(N)]) * z
    c, s = np.cos(turn), np.sin(turn)
    p = np.array([[c, -s, 0], [s, c, 0], [0, 0, 1]]) @ ray + np.array([[4.0], [1.5], [-1.0]])
    u, v = 600 * p[0] / p[2] + W / 2, 600 * p[1] / p[2] + H / 2
    u, v = u + rng.normal(0, noise, N), v + rng.normal(0, noise, N)
    off = rng.random(N) < moving
    u[off] += rng.uniform(-80, 80, off.sum())
    v[off] += rng.choice([-1, 1], off.sum()) * rng.uniform(20, 80, off.sum())
    u, v = u + warp * np.sin(y / 23), v + warp * np.sin(x / 19)
    return [(float(a), float(b), float(d), float(e)) for a, b, d, e in zip(x, y, u, v)], N - int(off.sum())


@pytest.fixture(scope="module")
def found(spark):
    cases = {1: views(1), 2: views(2, moving=0.3), 3: views(3, plane=True, turn=0.1), 4: views(4, warp=14.0), 5: (views(5)[0][:11], 11), 6: views(6, plane=True, moving=0.2)}
    rows = [(k, *m) for k, (ms, _) in cases.items() for m in ms]
    got = rigid_pairs(spark.createDataFrame(rows, "pair int, x double, y double, u double, v double"), "pair", (W, H)).collect()
    return {r.pair: r for r in got}, cases


def test_rigid_scenes_and_moving_points(found):
    got, cases = found
    for k in (1, 2, 3, 6):
        assert abs(got[k].rigid - cases[k][1]) <= 0.06 * N, k
    assert got[3].share > 0.97 and got[1].share > 0.97


def test_a_warp_is_not_rigid(found):
    assert found[0][4].share < 0.6


def test_motion_of_a_plane_and_few_matches(found):
    r = found[0][3]
    assert r.rotation == pytest.approx(np.degrees(0.1), abs=0.3) and r.scale == pytest.approx(50 / 49, abs=0.01) and 40 < r.shift < 60
    assert found[0][5].share is None and found[0][5].matches == 11 and found[0][5].rigid == 0


def test_many_matches_of_which_a_fifth_moved(spark):
    rng = np.random.default_rng(9)
    n, rows = 2000, []
    for k in range(3):
        x, y, depth = rng.uniform(20, 620, n), rng.uniform(20, 460, n), rng.uniform(1, 3, n)
        v = y + np.where(np.arange(n) % 5 == 0, 25 + np.arange(n) % 17 * 3, 0)
        rows += [(k, *map(float, r)) for r in zip(x, y, x - 40 / depth, v)]
    got = rigid_pairs(spark.createDataFrame(rows, "pair int, x double, y double, u double, v double"), "pair", (W, H), candidates=32)
    assert [(r.pair, r.rigid) for r in got.orderBy("pair").collect()] == [(k, 1600) for k in range(3)]


def test_candidates_are_judged_in_blocks_as_by_columns(spark, monkeypatch):
    from pyspark.sql import functions as F

    from skyloom.operators import rigid

    monkeypatch.setattr(rigid, "BLOCK", 50)
    rng = np.random.default_rng(11)
    matches = spark.createDataFrame([(k % 2, *map(float, rng.normal(0, 0.3, 4))) for k in range(400)], ["pair", *rigid.SCALED])
    models = spark.createDataFrame([(p, [(k, [float(x) for x in rng.normal(0, 1, 9)]) for k in range(80)]) for p in (0, 1)], "pair long, __models array<struct<__k long, m array<double>>>")
    blocks = rigid._blocks(matches, "pair")
    assert blocks.select(F.max(F.size("__rows"))).first()[0] < 100 and blocks.count() > 4
    for off, judge in ((rigid.sampson, rigid._sampson), (rigid.transfer, rigid._transfer)):
        got = rigid._agreeing(blocks, models, "pair", 0.2, judge).collect()
        each = matches.join(models, "pair").withColumn("c", F.explode("__models"))
        want = each.where(off(F.col("c.m"), *map(F.col, rigid.SCALED)) < 0.2).groupBy("pair", "c.__k").count().collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(want) > 20
