"""Image conditioning: blocks go and the rest stays, curves against NumPy, noise falls and edges stay."""

import numpy as np
import pytest

from skyloom.operators import conditioning as C


def frame(spark, *images):
    rows = [(k, r, c, float(g[r, c])) for k, g in enumerate(images) for r in range(g.shape[0]) for c in range(g.shape[1])]
    return spark.createDataFrame(rows, "frame int, row int, col int, v double")


def images(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.frame, {})[r.row, r.col] = r.v
    return {k: np.array([[cells[i, j] for j in range(max(c for _, c in cells) + 1)] for i in range(max(r for r, _ in cells) + 1)]) for k, cells in out.items()}


def test_blockiness_falls_and_cells_off_the_grid_stay(spark):
    rng = np.random.default_rng(2)
    noise = rng.normal(0, 2, (40, 40))
    blocky = 100 + np.kron(rng.normal(0, 12, (5, 5)), np.ones((8, 8))) + noise
    clean = 100 + noise
    df = frame(spark, blocky, clean)
    before = {r.frame: r.blockiness for r in C.block_scores(df, 8).collect()}
    got = C.suppress_blocks(df)
    after = {r.frame: r.blockiness for r in C.block_scores(got, 8).collect()}
    made = images(got)
    assert before[0] > 2 and after[0] < 0.8 * before[0] and before[1] < 1.3
    assert np.array_equal(made[1], clean)
    y, x = np.mgrid[:40, :40]
    near = lambda v: (v >= 6) & ((v % 8 <= 2) | (v % 8 >= 6))
    assert np.array_equal(made[0][~(near(y) | near(x))], blocky[~(near(y) | near(x))])


@pytest.mark.parametrize("clip", [1.0, 3.0])
def test_curves_against_numpy(spark, clip):
    rng = np.random.default_rng(5)
    g = np.clip(rng.normal(90, 15, (24, 30)), 0, 255).round()
    got = images(C.local_contrast(frame(spark, g), 8, clip))[0]
    curves = {}
    for tr in range(3):
        for tc in range(4):
            part = g[8 * tr : 8 * tr + 8, 8 * tc : 8 * tc + 8]
            n = np.bincount(part.astype(int).ravel(), minlength=256)
            limit = max(1, int(clip * part.size / 256))
            over = np.maximum(n - limit, 0).sum()
            n = np.minimum(n, limit) + over // 256
            rest = over % 256
            if rest:
                n[:: max(256 // rest, 1)][:rest] += 1
            curves[tr, tc] = np.minimum(np.rint(np.cumsum(n) * 255 / part.size), 255)
    for r in range(24):
        for c in range(30):
            y, x = r / 8 - 0.5, c / 8 - 0.5
            want = 0.0
            for i in (0, 1):
                for j in (0, 1):
                    t = (min(max(int(np.floor(y)) + i, 0), 2), min(max(int(np.floor(x)) + j, 0), 3))
                    wy, wx = y - np.floor(y), x - np.floor(x)
                    want += (wy if i else 1 - wy) * (wx if j else 1 - wx) * curves[t][int(g[r, c])]
            assert got[r, c] == pytest.approx(want, abs=1e-5)


def test_low_light(spark):
    rng = np.random.default_rng(8)
    edge = np.where(np.arange(24) < 12, 20.0, 60.0) * np.ones((24, 1))
    dark = np.clip(edge + rng.normal(0, 2, (24, 24)), 0, 255)
    bright = np.full((24, 24), 150.0)
    got, labels = C.low_light(frame(spark, dark, bright), strength=12.0)
    label = {r.frame: (r.low_light, r.weight) for r in labels.collect()}
    assert label == {0: (True, 0.5), 1: (False, 1.0)}
    made = images(got)
    assert np.array_equal(made[1], bright)
    lifted = np.floor(255 * (dark.round() / 255) ** 0.6)
    assert made[0][:, :10].std() < 0.6 * lifted[:, :10].std()
    assert made[0][:, 13:].mean() - made[0][:, :11].mean() > 0.9 * (lifted[:, 13:].mean() - lifted[:, :11].mean())


def around(g, i, j, reach):
    return [(a, b) for a in range(max(i - reach, 0), min(i + reach + 1, g.shape[0])) for b in range(max(j - reach, 0), min(j + reach + 1, g.shape[1]))]


def test_filters_over_tiles_against_plain_loops(spark):
    g = np.random.default_rng(3).integers(0, 40, (9, C.TILE + 7)).astype(float)
    at = [(4, C.TILE - 1), (0, C.TILE), (8, C.TILE + 6), (5, 2)]
    df = frame(spark, g)
    marked = df.selectExpr("frame", "cast(row as long) row", "cast(col as long) col", "v", "array_contains(array(" + ",".join(f"'{r}:{c}'" for r, c in at) + "), concat(row, ':', col)) at")
    smooth, calm = images(C.smoothed(marked, "at", 3, 5.0, 35.0))[0], images(C.denoised(df, 6.0, 1, 2))[0]
    assert smooth.shape == calm.shape == g.shape and (smooth != g).sum() == len(at)
    for i, j in at:
        w = {(a, b): np.exp(-((a - i) ** 2 + (b - j) ** 2) / 50 - (g[a, b] - g[i, j]) ** 2 / 2450) for a, b in around(g, i, j, 3)}
        assert smooth[i, j] == pytest.approx(sum(x * g[k] for k, x in w.items()) / sum(w.values()))
        w = {}
        for a, b in around(g, i, j, 2):
            moved = [(r + a - i, c + b - j, r, c) for r, c in around(g, i, j, 1)]
            away = [(g[r, c] - g[x, y]) ** 2 for x, y, r, c in moved if 0 <= x < g.shape[0] and 0 <= y < g.shape[1]]
            w[a, b] = np.exp(-np.mean(away) / 36)
        assert calm[i, j] == pytest.approx(sum(x * g[k] for k, x in w.items()) / sum(w.values()))


def test_filters_make_no_row_for_each_neighbour(spark):
    df = frame(spark, np.ones((9, 9)))
    for got in (C.denoised(df, 6.0), C.smoothed(df.selectExpr("*", "row > 2 as at"), "at", 3, 5.0, 35.0)):
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Window" not in plan


def test_local_contrast_over_tiles_makes_no_row_for_each_corner(spark):
    g = np.clip(np.random.default_rng(6).normal(90, 15, (24, C.TILE + 19)), 0, 255).round()
    got = C.local_contrast(frame(spark, g), 8, 2.0)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate inline" not in plan and "Window" not in plan
    # what is right of the first tile's margin sees no cell of it: as a frame of its own, moved by whole tiles
    part, made = images(C.local_contrast(frame(spark, g[:, 104:]), 8, 2.0))[0], images(got)[0]
    assert made.shape == g.shape and np.array_equal(made[:, 112:], part[:, 8:])
