"""Conditioning of images kept as rows of cells (inventory R14, R22, R31, R32): (frame, row, col, v), v from 0 to 255.

Filters over the cells around a cell work on tiles of bounded size with a margin, curves on grouped counts, steps between
cells on windows along rows and columns, so an image is never gathered. Offsets and bins are bounded by parameters.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyloom.session import materialise

CELL = ["frame", "row", "col"]
BINS = 256
#: Rows and columns of a tile of cells; its margin comes on top.
TILE = 128


def _cells(df: DataFrame) -> DataFrame:
    return df.select("frame", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), F.col("v").cast("double").alias("v"))


def block_scores(cells: DataFrame, block: int) -> DataFrame:
    """(frame, blockiness): mean step over the block grid against the mean step elsewhere, the mean of both axes.

    The outermost ``block`` seams don't count; images under three blocks, or flat off the grid, score 1.
    """
    size = F.struct((F.max("row") + 1).alias("h"), (F.max("col") + 1).alias("w")).alias("s")
    p = _cells(cells)
    ratios = []
    for at, line, length in (("col", "row", "s.w"), ("row", "col", "s.h")):
        step = F.abs(F.lead("v").over(Window.partitionBy("frame", line).orderBy(at)) - F.col("v"))
        rows = p.withColumn("__d", step).join(p.groupBy("frame").agg(size), "frame")
        inner = rows.where(F.col("__d").isNotNull() & (F.col(at) >= block) & (F.col(at) < F.col(length) - 1 - block))
        on = (F.col(at) + 1) % block == 0
        ratio = F.avg(F.when(on, F.col("__d"))) / F.nullif(F.when(F.avg(F.when(~on, F.col("__d"))) > 1e-6, F.avg(F.when(~on, F.col("__d")))), F.lit(0.0))
        ratios.append(inner.groupBy("frame").agg(F.coalesce(ratio, F.lit(1.0)).alias(f"__{at}")))
    sizes = p.groupBy("frame").agg(size).join(ratios[0], "frame", "left").join(ratios[1], "frame", "left")
    small = F.least("s.h", "s.w") < 3 * block
    both = (F.coalesce("__col", F.lit(1.0)) + F.coalesce("__row", F.lit(1.0))) / 2
    return sizes.select("frame", F.when(small, 1.0).otherwise(both).alias("blockiness"))


def _by_tiles(cells: DataFrame, margin: int, work: Callable[[np.ndarray, np.ndarray, pd.Series], np.ndarray], at: str | None = None, tile: int = TILE) -> DataFrame:
    """``cells`` with ``v`` of those marked by ``at`` (all, if None) as ``work`` makes it; other columns stay.

    A group is a tile with the ``margin`` of cells around it, so its size is bounded and each cell crosses one shuffle
    with few copies. ``work(grid, marked, of)`` gets values, not a number where there is no cell, and gives the new ones;
    ``of`` is one of the rows, with the place of the grid's first cell as ``__r0`` and ``__c0``.
    """
    ends = lambda c: [F.floor((F.col(c) + d) / tile).cast("long") for d in (-margin, margin)]
    names = cells.columns
    dealt = cells.withColumn("__tr", F.explode(F.sequence(*ends("row")))).withColumn("__tc", F.explode(F.sequence(*ends("col"))))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        row, col = pdf["row"].to_numpy(), pdf["col"].to_numpy()
        y, x = row - row.min(), col - col.min()
        grid, marked = np.full((y.max() + 1, x.max() + 1), np.nan), np.zeros((y.max() + 1, x.max() + 1), bool)
        grid[y, x] = pdf["v"]
        own = (row // tile == key[1]) & (col // tile == key[2])
        marked[y[own], x[own]] = True if at is None else pdf[at].to_numpy()[own]
        if marked.any():
            of = pd.concat([pdf.iloc[0], pd.Series({"__r0": row.min(), "__c0": col.min()})])
            grid = np.where(marked, work(grid, marked, of), grid)
        return pdf[own].assign(v=grid[y[own], x[own]])[names]

    key = ["frame", "__tr", "__tc"]
    # a number, as a tile's work is much more than its bytes say
    dealt = dealt.repartition(int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions")), *key)
    return dealt.groupBy(*key).applyInPandas(run, cells.schema)


def _moved(grid: np.ndarray, i: int, j: int) -> np.ndarray:
    """The value ``i`` rows below and ``j`` columns to the right of each place."""
    out, (h, w) = np.full(grid.shape, np.nan), grid.shape
    to = lambda k, n: slice(max(-k, 0), max(min(n - k, n), 0))
    if abs(i) < h and abs(j) < w:
        out[to(i, h), to(j, w)] = grid[to(-i, h), to(-j, w)]
    return out


def _offsets(radius: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(-radius, radius + 1) for j in range(-radius, radius + 1)]


def smoothed(cells: DataFrame, at: str, radius: int, sigma_space: float, sigma_value: float) -> DataFrame:
    """``cells`` with ``v`` of those marked by ``at`` as means of the cells around, weighted by distance and by likeness."""

    def work(grid: np.ndarray, marked: np.ndarray, of: pd.Series) -> np.ndarray:
        y, x = np.nonzero(marked)
        wide, own = np.pad(grid, radius, constant_values=np.nan), grid[y, x]
        total, sums = np.zeros(len(y)), np.zeros(len(y))
        for i, j in _offsets(radius):
            v = wide[y + radius + i, x + radius + j]
            weight = np.exp(-(i * i + j * j) / (2 * sigma_space**2) - (v - own) ** 2 / (2 * sigma_value**2))
            total += np.nan_to_num(weight)
            sums += np.nan_to_num(weight * v)
        made = grid.copy()
        made[y, x] = np.divide(sums, total, out=np.full(len(y), np.nan), where=total > 0)
        return made

    return _by_tiles(cells, radius, work, at)


def suppress_blocks(cells: DataFrame, block: int = 8, *, threshold: float = 1.3, reach: int = 2, radius: int = 3, sigma_space: float = 5.0, sigma_value: float = 35.0) -> DataFrame:
    """Images whose blockiness reaches the threshold, smoothed within ``reach`` of the block grid; others as they are.

    At the grid a step between blocks counts as noise (a wide ``sigma_value``), a second, narrower pass settles what the
    first left, and the result is blended in by how far the image is over the threshold. Cells off the grid don't change.
    """
    p = _cells(cells)
    scores = block_scores(p, block)
    bad = scores.where(F.col("blockiness") >= threshold)
    severity = F.least(F.greatest((F.col("blockiness") - threshold) / threshold, F.lit(0.0)), F.lit(1.0))
    p = materialise(p.join(bad.select("frame", (0.5 + 0.5 * severity).alias("__share")), "frame", "left"), "blocks")
    close = lambda c: (F.col(c) >= block - reach) & ((F.col(c) % block <= reach) | (F.col(c) % block >= block - reach))
    p = p.withColumns({"__grid": F.col("__share").isNotNull() & (close("row") | close("col")), "__v": F.col("v")})
    for sigma in (2.5 * sigma_value, sigma_value):
        p = smoothed(p, "__grid", radius, sigma_space, sigma)
    mixed = F.col("__share") * F.col("v") + (1 - F.col("__share")) * F.col("__v")
    return p.select(*CELL, F.when(F.col("__grid"), mixed).otherwise(F.col("__v")).alias("v"))


def tile_curves(tiles: np.ndarray, bins: np.ndarray, n: int, clip: float) -> np.ndarray:
    """(n, 256): the clipped and equalised curve of each tile, given the tile and the bin of each cell.

    Counts above the limit are spread over all bins, what does not divide over bins at even steps from the first.
    """
    counts = np.bincount(tiles * BINS + bins, minlength=n * BINS).reshape(n, BINS)
    area = counts.sum(1, keepdims=True)
    limit = np.maximum(np.floor(clip * area / BINS).astype(int), 1)
    over = np.maximum(counts - limit, 0).sum(1, keepdims=True)
    rest, at = over % BINS, np.arange(BINS)
    step = np.maximum(BINS // np.maximum(rest, 1), 1)
    held = np.minimum(counts, limit) + over // BINS + ((rest > 0) & (at % step == 0) & (at / step < rest))
    return np.where(area > 0, np.minimum(np.rint(held.cumsum(1) * 255.0 / np.maximum(area, 1)), 255.0), 0.0)


def local_contrast(cells: DataFrame, tile: int = 8, clip: float = 2.0) -> DataFrame:
    """Contrast equalised by tiles: each cell by the curves of the four tiles whose centres are around it, blended."""
    bin_ = F.least(F.greatest(F.round("v"), F.lit(0.0)), F.lit(255.0))
    p = _cells(cells).select(*CELL, bin_.alias("v"))
    last = p.groupBy("frame").agg(F.floor(F.max("row") / tile).alias("__y1"), F.floor(F.max("col") / tile).alias("__x1"))

    def work(grid: np.ndarray, marked: np.ndarray, of: pd.Series) -> np.ndarray:
        y, x = np.nonzero(~np.isnan(grid))
        bins, y0, x0 = grid[y, x].astype(int), int(of["__r0"]), int(of["__c0"])
        ty, tx = (y + y0) // tile - y0 // tile, (x + x0) // tile - x0 // tile
        wide, n = tx.max() + 1, (ty.max() + 1) * (tx.max() + 1)
        curves = tile_curves(ty * wide + tx, bins, n, clip)
        inner = marked[y, x]
        y, x, bins, made = y[inner], x[inner], bins[inner], grid.copy()
        fy, fx = (y + y0) / tile - 0.5, (x + x0) / tile - 0.5
        made[y, x] = 0.0
        for i in (0, 1):
            for j in (0, 1):
                r = np.clip(np.floor(fy).astype(int) + i, 0, int(of["__y1"])) - y0 // tile
                c = np.clip(np.floor(fx).astype(int) + j, 0, int(of["__x1"])) - x0 // tile
                here = (r >= 0) & (r <= ty.max()) & (c >= 0) & (c < wide)  # else the tile has no cells
                w = np.abs(1 - i - (fy - np.floor(fy))) * np.abs(1 - j - (fx - np.floor(fx)))
                made[y, x] += np.where(here, w * curves[np.where(here, r * wide + c, 0), bins], 0.0)
        return made

    made = _by_tiles(p.join(last, "frame"), tile, work, tile=tile * max(TILE // tile, 1))
    return made.select(*CELL, F.round("v", 6).alias("v"))


def denoised(cells: DataFrame, strength: float, patch: int = 1, search: int = 3) -> DataFrame:
    """Non-local means: each cell as the mean of the cells within ``search``, weighted by how alike the patches of
    ``patch`` cells around both are. The patches' distances are sums along rows, then columns, for each offset."""

    def box(g: np.ndarray) -> np.ndarray:
        for axis in (0, 1):
            wide = np.pad(g, [(patch, patch) if k == axis else (0, 0) for k in (0, 1)])
            g = sum(wide.take(range(k, k + g.shape[axis]), axis) for k in range(2 * patch + 1))
        return g

    def work(grid: np.ndarray, marked: np.ndarray, of: pd.Series) -> np.ndarray:
        total, sums = np.zeros(grid.shape), np.zeros(grid.shape)
        for i, j in _offsets(search):
            v = _moved(grid, i, j)
            away = (v - grid) ** 2
            pairs = ~np.isnan(away)
            near = box(np.where(pairs, away, 0.0)) / np.maximum(box(pairs.astype(float)), 1)
            weight = np.where(pairs, np.exp(-near / strength**2), 0.0)
            total += weight
            sums += weight * np.nan_to_num(v)
        return np.divide(sums, total, out=np.full(grid.shape, np.nan), where=total > 0)

    return _by_tiles(_cells(cells), search + patch, work)


def low_light(cells: DataFrame, *, below: float = 0.22, gamma: float = 0.6, strength: float = 6.0, weight: float = 0.5, patch: int = 1, search: int = 3) -> tuple[DataFrame, DataFrame]:
    """(images, (frame, mean_luma, low_light, weight)): dark images are brightened, then denoised, as brightening lifts
    the noise; they keep their label and count less. Others stay as they are."""
    p = _cells(cells)
    labels = p.groupBy("frame").agg((F.avg("v") / 255).alias("mean_luma"))
    dark = F.col("mean_luma") < below
    labels = materialise(labels.select("frame", "mean_luma", dark.alias("low_light"), F.when(dark, weight).otherwise(1.0).alias("weight")), "low-light")
    rows = p.join(labels.select("frame", "low_light"), "frame")
    brighter = F.floor(255 * F.pow(F.least(F.greatest(F.round("v"), F.lit(0.0)), F.lit(255.0)) / 255, gamma))
    lifted = materialise(rows.where("low_light").select(*CELL, brighter.alias("v")), "low-light-lifted")
    return rows.where("not low_light").select(*CELL, "v").unionByName(denoised(lifted, strength, patch, search)), labels
