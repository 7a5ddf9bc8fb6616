"""Measures of sampled frames and regions of images (inventory A62, J1, R13, R19, R27)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.operators import raster, windows
from skyloom.operators.stats import quantiles
from skyloom.session import materialise


def with_pairs(frames: DataFrame, pairs: DataFrame, keys: list[str], time: str, start: str, end: str, rates: dict[str, str]) -> DataFrame:
    """Frames with the measures of the pair that starts at them, as rates a second (``rates``: column -> name)."""
    moved = pairs.select(*keys, F.col(start).alias(time), *((F.col(c) / (F.col(end) - F.col(start))).alias(n) for c, n in rates.items()))
    return frames.join(moved, [*keys, time], "left")


def frame_quality(frames: DataFrame, keys: list[str], below: dict[str, float], above: dict[str, float], medians: list[str]) -> DataFrame:
    """Share of frames below and above limits, and medians, of each key."""
    share = lambda c: F.avg(F.coalesce(c, F.lit(False)).cast("double"))
    made = frames.groupBy(*keys).agg(
        F.count("*").alias("n"), *(share(F.col(c) < v).alias(f"{c}_below") for c, v in below.items()), *(share(F.col(c) > v).alias(f"{c}_above") for c, v in above.items())
    )
    for c in medians:
        made = made.join(quantiles(frames, keys, c, [0.5]).select(*keys, F.col("q0").alias(f"{c}_median")), keys, "left")
    return made


def _around(cells: DataFrame, by: list[str], half: int) -> DataFrame:
    """Each cell copied to the square of cells around it."""
    offsets = [F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r in range(-half, half + 1) for c in range(-half, half + 1)]
    rest = [c for c in cells.columns if c not in ("row", "col")]
    spread = cells.withColumn("__o", F.explode(F.array(*offsets)))
    return spread.select(*rest, (F.col("row") + F.col("__o.r")).alias("row"), (F.col("col") + F.col("__o.c")).alias("col")).dropDuplicates([*by, "row", "col"])


def static_overlay(edges: DataFrame, keys: list[str], frame: str, edge: Column, persist: float = 0.9, half: int = 2) -> DataFrame:
    """Share and box of the cells whose edges stay while the scene moves, grown by a square; 0 for a still scene.

    ``edges`` has a row for each (keys, frame, row, col).
    """
    cells = edges.groupBy(*keys, "row", "col").agg(F.avg(edge.cast("double")).alias("__stay"))
    cells = materialise(cells, "edge-cells")
    still = cells.groupBy(*keys).agg(F.count("*").alias("cells"), (F.count_if(F.col("__stay") >= persist) > 0.5 * F.count_if(F.col("__stay") > 0.3)).alias("still"))
    held = _around(cells.where(F.col("__stay") >= persist).select(*keys, "row", "col"), keys, half)
    grown = held.join(cells.select(*keys, "row", "col"), [*keys, "row", "col"], "left_semi")
    found = grown.groupBy(*keys).agg(F.count("*").alias("n"), F.min("col").alias("x0"), F.min("row").alias("y0"), F.max("col").alias("x1"), F.max("row").alias("y1"))
    rows = still.join(found, keys, "left")
    moving = ~F.col("still") & F.col("n").isNotNull()
    return rows.select(*keys, F.when(moving, F.col("n") / F.col("cells")).otherwise(0.0).alias("share"), *(F.when(moving, F.col(c)).alias(c) for c in ("x0", "y0", "x1", "y1")))


def shadow_regions(pixels: DataFrame, image: str, *, blue_delta: float = 0.12, ceiling: float = 1.05, most_saturation: float = 0.6, least_cells: int = 4, dark_ratio: float = 0.9, ring: int = 1) -> DataFrame:
    """(image, label, cells, inside, around): regions of cast shadow in ``pixels(image, row, col, r, g, b)``, values 0 to 1.

    A candidate is bluer than its image's median, not brighter and of low saturation. A connected region stays if it
    has ``least_cells`` and is darker than ``dark_ratio`` times the ring of other cells around it, or has no ring.
    """
    bright, dim = F.greatest("r", "g", "b"), F.least("r", "g", "b")
    rows = pixels.select(image, "row", "col", bright.alias("v"), F.when(bright > 0, (bright - dim) / bright).otherwise(0.0).alias("s"), ((F.col("b") * 255 + 1) / (F.col("r") * 255 + 1)).alias("blue"))
    rows = materialise(rows, "shadow-pixels")
    middle = quantiles(rows, [image], "blue", [0.5]).select(image, F.col("q0").alias("blue_m")).join(quantiles(rows, [image], "v", [0.5]).select(image, F.col("q0").alias("v_m")), image)
    candidate = (F.col("blue") > F.col("blue_m") + max(blue_delta, 0.08)) & (F.col("v") < F.col("v_m") * ceiling) & (F.col("s") <= most_saturation)
    marked = rows.join(middle, image).where(candidate).select(image, "row", "col", "v")
    # images side by side, a free row between them, are one grid for the components
    places = materialise(windows.numbered_by(rows.select(image).distinct(), [F.col(image)]).withColumnRenamed("number", "__at"), "shadow-images")
    span = rows.agg((F.max("row") + 2).alias("__span"))
    grid = marked.join(places.select(image, "__at"), image).crossJoin(F.broadcast(span)).withColumn("row0", F.col("row") + F.col("__at") * F.col("__span"))
    grid = materialise(grid.select(image, "row", "col", "v", "row0"), "shadow-cells")
    labels = raster.components(grid.select(F.col("row0").alias("row"), "col")).select(F.col("row").alias("row0"), "col", "label")
    regions = materialise(grid.join(labels, ["row0", "col"]).select(image, "label", "row", "col", "v"), "shadow-regions")
    inside = regions.groupBy(image, "label").agg(F.count("*").alias("cells"), F.avg("v").alias("inside"), F.min(F.struct("row", "col")).alias("first")).where(F.col("cells") >= least_cells)
    near = _around(regions.select(image, "label", "row", "col"), [image, "label"], ring).join(rows.select(image, "row", "col", "v"), [image, "row", "col"])
    near = near.join(grid.select(image, "row", "col"), [image, "row", "col"], "left_anti").groupBy(image, "label").agg(F.avg("v").alias("around"))
    found = inside.join(near, [image, "label"], "left").where(F.col("around").isNull() | (F.col("inside") < dark_ratio * F.col("around")))
    return found.select(image, F.col("first.row").alias("row"), F.col("first.col").alias("col"), "cells", "inside", "around")
