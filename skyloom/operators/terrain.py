"""Terrain under what stands on it (inventory R1): linear interpolation of ground cells, and classes of points by height.

A cell without ground lies in one triangle of the Delaunay triangulation of the ground cells. That triangle is the
facet of the lower hull of the cells lifted onto a paraboloid, so it is found for each cell by itself: start from a
triangle around the cell, take the lifted point furthest below its plane, let it replace the corner that leaves the
cell inside, and go on until no point lies below. Corners of the facet lie on the rim of an empty disc, so only ground
cells within two cells of one without ground can be corners: those are dealt to tiles with a margin, and a triangle whose disc
leaves the margin is looked for again with twice the margin. Grid cells often lie on one circle; a small lift by a
hash of the cell decides between triangulations, the same in every tile.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.operators.distance import nearest_cells
from skyloom.session import materialise

# ASPRS codes of point classes.
UNCLASSIFIED, GROUND, LOW_NOISE = 1, 2, 7
#: The most by which the lift of a cell is moved; less than what keeps every cell on the lower hull.
NUDGE = 0.2


def _around(y: np.ndarray, x: np.ndarray) -> np.ndarray | None:
    """Three of the points (y, x) whose triangle holds the origin, which is none of them; None where there are none.

    The first is the nearest; the others are those nearest to its opposite direction on either side.
    """
    angle, away, small = np.arctan2(y, x), y * y + x * x, 1e-12
    first = int(away.argmin())
    turn = (angle - angle[first]) % (2 * np.pi)
    left, right = np.flatnonzero((turn > small) & (turn < np.pi - small)), np.flatnonzero((turn > np.pi + small) & (turn < 2 * np.pi - small))
    opposite = np.flatnonzero(np.abs(turn - np.pi) <= small)
    if len(opposite):
        beside = np.append(left, right)
        return np.array([first, opposite[away[opposite].argmin()], beside[away[beside].argmin()]]) if len(beside) else None
    if not len(left) or not len(right):
        return None
    p, q = left[turn[left].argmax()], right[turn[right].argmin()]
    return np.array([first, p, q]) if turn[q] - turn[p] <= np.pi + small else None


def nudges(rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Small lifts by a hash of the cells, so that no four cells lie on one circle."""
    h = (rows.astype(np.uint64) * np.uint64(0x9E3779B1) + cols.astype(np.uint64) * np.uint64(0x85EBCA77)) & np.uint64(0xFFFFFFFF)
    for shift, factor in ((15, 0x2C1B3C6D), (12, 0x297A2D39)):
        h = (h ^ h >> np.uint64(shift)) * np.uint64(factor) & np.uint64(0xFFFFFFFF)
    return NUDGE * (h >> np.uint64(8)).astype(float) / 2**24


def facet(rows: np.ndarray, cols: np.ndarray, row: int, col: int) -> tuple[np.ndarray, np.ndarray, float] | None:
    """(three corners, their weights, radius of the disc through them) of the triangle around (row, col); None outside the hull."""
    y, x = rows - row, cols - col
    lift = (y * y + x * x) + nudges(rows, cols)
    y, x = y.astype(float), x.astype(float)
    tri = _around(y, x)
    if tri is None:
        return None
    for _ in range(10 * (len(rows) + 3)):
        a = np.stack([y[tri], x[tri], np.ones(3)], 1)
        plane = np.linalg.solve(a, lift[tri])
        below = lift - (plane[0] * y + plane[1] * x + plane[2])
        below[tri] = 0.0
        p = int(below.argmin())
        if below[p] > -1e-9:
            break
        # of the triangles with p and two corners, one holds the cell
        weights = []
        for k in range(3):
            t = tri.copy()
            t[k] = p
            area = (y[t[1]] - y[t[0]]) * (x[t[2]] - x[t[0]]) - (y[t[2]] - y[t[0]]) * (x[t[1]] - x[t[0]])
            if abs(area) < 1e-12:
                continue
            w = np.array([(y[t[(j + 1) % 3]] * x[t[(j + 2) % 3]] - y[t[(j + 2) % 3]] * x[t[(j + 1) % 3]]) / area for j in range(3)])
            weights.append((w.min(), t))
        tri = max(weights, key=lambda wt: wt[0])[1]
    a = np.stack([y[tri], x[tri], np.ones(3)], 1)
    w = np.linalg.solve(a.T, np.array([0.0, 0.0, 1.0]))
    # the disc's centre is half the plane's slope, of the lift without its nudge
    p0, p1, _ = np.linalg.solve(a, y[tri] ** 2 + x[tri] ** 2)
    reach = np.hypot(y[tri[0]] - p0 / 2, x[tri[0]] - p1 / 2) + np.hypot(p0 / 2, p1 / 2)
    return tri, w, float(reach)


def linear_terrain(cells: DataFrame, keys: list[str], z: str, ground: Column, *, tile: int = 32, reach: int = 512) -> DataFrame:
    """(keys, row, col, terrain, linear) of ``cells(keys, row, col, z)``, every cell of a raster a row.

    Ground cells keep their height; others lie on the plane of their triangle of ground cells. Cells outside the hull,
    or in gaps wider than ``reach``, take the nearest ground cell's (``linear`` is false); without ground there is none.
    """
    key = [*keys, "row", "col"]
    kinds = dict(cells.dtypes)
    held = cells.select(*keys, F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), F.col(z).cast("double").alias("z"), F.coalesce(ground & F.col(z).isNotNull(), F.lit(False)).alias("g"))
    held = materialise(held, "terrain-cells")
    open_ = held.where("not g").select(*key)
    around = F.explode(F.expr("flatten(transform(sequence(-2, 2), i -> transform(sequence(-2, 2), j -> struct(i, j))))"))
    beside = open_.select(*key, around.alias("o")).select(*keys, (F.col("row") + F.col("o.i")).alias("row"), (F.col("col") + F.col("o.j")).alias("col")).distinct()
    rim = materialise(held.where("g").join(beside, key).select(*key, "z"), "terrain-rim")
    head = "".join(f"`{k}` {kinds[k]}, " for k in keys)
    margin, found = tile, []

    def looked_up(margin: int):
        def run(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
            out = np.full(len(asked), np.nan)
            if len(known) < 3:
                return asked[key].assign(terrain=out)
            rows, cols, height = (known[c].to_numpy() for c in ("row", "col", "z"))
            for i, (r, c) in enumerate(zip(asked["row"], asked["col"], strict=True)):
                got = facet(rows, cols, r, c)
                if got is not None and got[2] + 1 <= margin:  # the nudge may widen the disc by less than a cell
                    out[i] = got[1] @ height[got[0]]
            return asked[key].assign(terrain=out)

        return run

    while margin <= reach:
        t = lambda c: F.floor(F.col(c) / tile)
        near = lambda c: F.sequence(F.floor((F.col(c) - margin) / tile), F.floor((F.col(c) + margin) / tile))
        asked = open_.withColumns({"__r": t("row"), "__c": t("col")})
        tiles = asked.select(*keys, "__r", "__c").distinct()
        known = rim.withColumn("__r", F.explode(near("row"))).withColumn("__c", F.explode(near("col"))).join(tiles, [*keys, "__r", "__c"])
        by = [*keys, "__r", "__c"]
        got = asked.groupBy(*by).cogroup(known.groupBy(*by)).applyInPandas(looked_up(margin), f"{head}row long, col long, terrain double")
        got = materialise(got.withColumn("terrain", F.nanvl("terrain", F.lit(None).cast("double"))), "terrain-found")
        found.append(got.where("terrain is not null"))
        open_ = got.where("terrain is null").select(*key)
        if open_.isEmpty():
            break
        margin *= 2
    made = held.where("g").select(*key, F.col("z").alias("terrain"), F.lit(True).alias("linear"))
    for part in found:
        made = made.unionByName(part.withColumn("linear", F.lit(True)))
    nearest = nearest_cells(held, keys, "row", "col", F.col("g")).join(open_, key)
    heights = held.where("g").select(*keys, F.col("row").alias("near_row"), F.col("col").alias("near_col"), F.col("z").alias("terrain"))
    rest = nearest.join(heights, [*keys, "near_row", "near_col"], "left")
    return made.unionByName(rest.select(*key, "terrain", F.lit(False).alias("linear")))


def ground_classes(points: DataFrame, terrain: DataFrame, keys: list[str], z: str, *, near: float = 0.5, noise: float = 2.0) -> DataFrame:
    """``points(.., row, col, z)`` with ``height`` above the terrain of their cell and class: ground within ``near`` of
    it, low noise more than ``noise`` under it, unclassified else and where there is no terrain."""
    rows = points.join(terrain.select(*keys, "row", "col", "terrain"), [*keys, "row", "col"], "left").withColumn("height", F.col(z) - F.col("terrain"))
    code = F.when(F.col("height") < -noise, LOW_NOISE).when(F.abs("height") <= near, GROUND).otherwise(UNCLASSIFIED)
    return rows.withColumn("class", code).drop("terrain")
