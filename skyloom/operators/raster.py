"""Rasters as tables of cells: surfaces, sampling, morphology, components (inventory A17 to A21, J19, R rows)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyloom.operators import windows
from skyloom.session import materialise


def rasterise(points: DataFrame, x: str, y: str, size: float, aggregates: list[Column]) -> DataFrame:
    """One row for each occupied cell (row, col) with the given aggregates; row 0 is the south edge."""
    col, row = F.floor(F.col(x) / size).cast("long"), F.floor(F.col(y) / size).cast("long")
    return points.withColumns({"row": row, "col": col}).groupBy("row", "col").agg(*aggregates)


def low_percentile(df: DataFrame, keys: list[str], value: str, q: float) -> DataFrame:
    """The value at rank floor(q * (n - 1)) of each cell, not interpolated."""
    w = Window.partitionBy(*keys)
    ranked = df.select(*keys, value, (F.row_number().over(w.orderBy(value)) - 1).alias("__k"), F.count(value).over(w).alias("n"))
    return ranked.where(F.col("__k") == F.floor(q * (F.col("n") - 1))).select(*keys, "n", value)


def bilinear(samples: DataFrame, sample_id: str, grid: DataFrame, x: str, y: str, z: str = "z") -> DataFrame:
    """Bilinear value of ``grid(row, col, z)`` at cell coordinates; null next to a missing cell.

    Each cell first gathers its four corners, so a sample meets one row in one join, whatever the samples repeat.
    """
    corner = lambda dr, dc: F.struct((F.col("row") - dr).alias("row"), (F.col("col") - dc).alias("col"), F.lit(2 * dr + dc).alias("k"))
    parts = grid.select(F.explode(F.array(corner(0, 0), corner(0, 1), corner(1, 0), corner(1, 1))).alias("p"), F.col(z).alias("v"))
    quads = parts.groupBy(F.col("p.row").alias("__row"), F.col("p.col").alias("__col")).agg(*(F.max(F.when(F.col("p.k") == k, F.col("v"))).alias(f"__z{k}") for k in range(4)))
    fx, fy = F.col(x) - F.floor(x), F.col(y) - F.floor(y)
    at = samples.withColumns({"__row": F.floor(y).cast("long"), "__col": F.floor(x).cast("long")}).join(quads, ["__row", "__col"], "left")
    top = F.col("__z0") * (1 - fx) + F.col("__z1") * fx
    bottom = F.col("__z2") * (1 - fx) + F.col("__z3") * fx
    return at.select(sample_id, (top * (1 - fy) + bottom * fy).alias(z))


def dilate(cells: DataFrame, by: int = 1, square: bool = True) -> DataFrame:
    """Cells (row, col) and all within ``by`` of them, as a square or a disc."""
    offsets = [(a, b) for a in range(-by, by + 1) for b in range(-by, by + 1) if square or a * a + b * b <= by * by]
    near = F.array(*(F.struct((F.col("row") + a).alias("row"), (F.col("col") + b).alias("col")) for a, b in offsets))
    return cells.select(F.explode(near).alias("k")).select("k.row", "k.col").distinct()


def erode(cells: DataFrame, by: int = 1) -> DataFrame:
    """Cells whose whole square neighbourhood is there."""
    offsets = [(a, b) for a in range(-by, by + 1) for b in range(-by, by + 1)]
    near = F.array(*(F.struct((F.col("row") + a).alias("row"), (F.col("col") + b).alias("col")) for a, b in offsets))
    votes = cells.select("row", "col").distinct().select(F.explode(near).alias("k")).groupBy("k.row", "k.col").agg(F.count("*").alias("n"))
    return votes.where(F.col("n") == len(offsets)).select("row", "col")


def fill_near(grid: DataFrame, wanted: DataFrame, reach: int, z: str = "z") -> DataFrame:
    """Missing ``wanted(row, col)`` cells take the nearest valid value within ``reach`` cells; ties to the lower (row, col)."""
    offsets = sorted((a * a + b * b, a, b) for a in range(-reach, reach + 1) for b in range(-reach, reach + 1) if a * a + b * b <= reach * reach)
    near = F.array(*(F.struct(F.lit(d).alias("d"), (F.col("row") + a).alias("row"), (F.col("col") + b).alias("col")) for d, a, b in offsets))
    source = grid.select(F.explode(near).alias("k"), F.col("row").alias("r"), F.col("col").alias("c"), F.col(z).alias("v"))
    best = source.select("k.d", "k.row", "k.col", "r", "c", "v").join(wanted.select("row", "col").distinct(), ["row", "col"])
    return best.groupBy("row", "col").agg(F.min(F.struct("d", "r", "c", "v")).alias("b")).select("row", "col", F.col("b.v").alias(z))


def shift_scores(ours: DataFrame, theirs: DataFrame, tile: int, reach: int, least: int, z: str = "z") -> DataFrame:
    """Correlation of each tile with the other surface at each shift within ``reach`` cells."""
    steps = F.explode(F.sequence(F.lit(-reach), F.lit(reach)))
    moved = ours.select("row", "col", F.col(z).alias("a")).withColumn("dr", steps).withColumn("dc", steps)
    moved = moved.select((F.floor(F.col("row") / tile)).alias("tile_row"), (F.floor(F.col("col") / tile)).alias("tile_col"), "dr", "dc", (F.col("row") + F.col("dr")).alias("row"), (F.col("col") + F.col("dc")).alias("col"), "a")
    joined = moved.join(theirs.select("row", "col", F.col(z).alias("b")), ["row", "col"])
    return joined.groupBy("tile_row", "tile_col", "dr", "dc").agg(F.count("*").alias("n"), F.corr("a", "b").alias("score")).where(F.col("n") >= least)


def components(cells: DataFrame, eight: bool = True) -> DataFrame:
    """R2: (row, col, label) of connected cells; label is the smallest id of its component.

    Labels spread to neighbours and jump to their label's label, so rounds grow with the logarithm of a
    region's width; each round is written to the shared folder.
    """
    ids = cells.select("row", "col").distinct()
    offsets = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a, b) != (0, 0) and (eight or 0 in (a, b))]
    key = lambda r, c: r * F.lit(1 << 32) + c
    nodes = ids.select("row", "col", key(F.col("row"), F.col("col")).alias("id"))
    near = F.array(*(key(F.col("row") + a, F.col("col") + b) for a, b in offsets))
    edges = nodes.select("id", F.explode(near).alias("other")).join(nodes.select(F.col("id").alias("other")), "other", "left_semi")
    edges = materialise(edges, "cell-edges")
    labels = materialise(nodes.select("id", F.col("id").alias("label")), "cell-labels")
    while True:
        spread = edges.join(labels.select(F.col("id").alias("other"), "label"), "other").groupBy("id").agg(F.min("label").alias("near"))
        new = labels.join(spread, "id", "left").select("id", "label", F.least("label", F.coalesce("near", "label")).alias("new"))
        # the root of a cell's old label learns the smaller label too, then every cell takes its label's label
        roots = new.groupBy(F.col("label").alias("root")).agg(F.min("new").alias("to"))
        hooked = new.select("id", F.col("new").alias("root")).join(roots, "root", "left").select("id", F.coalesce("to", "root").alias("label"))
        moved = hooked.join(labels.withColumnRenamed("label", "old"), "id")
        after = materialise(moved, "cell-labels")
        changed = after.where("label <> old").limit(1).count()
        labels = after.select("id", "label")
        if not changed:
            break
    return nodes.join(labels, "id").select("row", "col", "label")


def regions(cells: DataFrame, size: float, least_area: float) -> DataFrame:
    """R2, O2: components as numbered regions (number, cells, area, centroid), the largest first."""
    found = components(cells).groupBy("label").agg(F.count("*").alias("cells"), F.avg("row").alias("row"), F.avg("col").alias("col"))
    found = found.withColumn("area", F.col("cells") * size * size).where(F.col("area") >= least_area)
    return windows.numbered_by(found, [F.desc("area"), F.col("label")]).select("number", "cells", "area", "row", "col")


def opened(grid: DataFrame, half: int, z: str = "z") -> DataFrame:
    """Grey opening of a surface by a square: minimum then maximum, each separable into two window passes."""
    for f in (F.min, F.max):
        for line, along in (("row", "col"), ("col", "row")):
            w = Window.partitionBy(line).orderBy(along).rangeBetween(-half, half)
            grid = grid.withColumn(z, f(z).over(w))
    return grid


def ground_cells(grid: DataFrame, widths: list[int], slope: float, first: float, z: str = "z") -> DataFrame:
    """Progressive morphological filter: a cell is ground while each wider opening lowers it little enough."""
    out = grid.withColumn("__z", F.col(z)).withColumn("ground", F.lit(True))
    previous = 0
    for k, half in enumerate(widths):
        limit = first if k == 0 else slope * (half - previous) * 2 + first
        low = opened(out.select("row", "col", F.col("__z").alias("o")), half, "o")
        out = out.join(low, ["row", "col"])
        out = out.withColumn("ground", F.col("ground") & (F.col("__z") - F.col("o") <= limit)).withColumn("__z", F.col("o")).drop("o")
        previous = half
    return out.drop("__z")


def coverage(covered: DataFrame, seen: DataFrame) -> DataFrame:
    """Share of seen cells that are covered, in per cent."""
    both = seen.select("row", "col").distinct().join(covered.select("row", "col").distinct().withColumn("on", F.lit(1)), ["row", "col"], "left")
    return both.agg(F.count("*").alias("seen"), F.count("on").alias("covered"), (100 * F.count("on") / F.nullif(F.count("*"), F.lit(0))).alias("pct"))
