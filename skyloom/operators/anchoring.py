"""Depth of unknown scale anchored to measured depth, frame by frame (inventory R11, R12, A35).

A frame is a raster of pixels: a depth that is right up to scale and shift, its confidence, and the measured depth
where a surface was measured. The fit is made on a band of measured pixels around those without, judged on a ring
behind it that it never saw, and refused rather than trusted where a gate fails.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyloom.operators.cloud import weighted_fusion
from skyloom.operators.distance import nearest_cells
from skyloom.operators.stats import hash_pairs
from skyloom.session import materialise


@dataclass(frozen=True)
class AnchorLimits:
    """Limits of a fit. Tolerances are the larger of a length and a share of the measured depth."""

    drop_confidence: float = 0.3
    least_region: int = 200
    least_band: int = 200
    band: int = 24
    pairs: int = 500
    near: float = 0.25
    near_share: float = 0.02
    least_inliers: float = 0.35
    residual: float = 0.6
    residual_share: float = 0.02
    holdout_share: float | None = None
    scale_factor: float = 1.25
    blend: int = 32
    beyond_share: float = 0.15
    most_weight: float = 0.5


PIXEL = ["frame", "row", "col"]


def consensus_lines(rows: DataFrame, key: str, x: str, y: str, tolerance: Column, place: list[str], pairs: int) -> DataFrame:
    """(key, scale, shift, inliers) of ``y = scale x + shift``, the least-squares line over the rows near the best of up to
    ``pairs`` lines through two rows; only rising lines count.

    Pairs are ``stats.hash_pairs`` by ``place``.
    """
    kept = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull()).withColumn("__t", tolerance)
    ends = hash_pairs(kept, key, F.concat_ws(":", key, *place), [x, y], pairs)
    slope = (F.col(f"q.{y}") - F.col(f"p.{y}")) / F.nullif(F.col(f"q.{x}") - F.col(f"p.{x}"), F.lit(0.0))
    lines = ends.withColumn("s", slope).where("s > 0").select(key, "__k", "s", (F.col(f"p.{y}") - F.col("s") * F.col(f"p.{x}")).alias("t"))
    lines = lines.groupBy(key).agg(F.collect_list(F.struct("__k", "s", "t")).alias("__lines"))  # ``pairs`` and few more
    lines = materialise(lines, "consensus-tries")  # so that rows stay where they are if keys are few
    near = F.abs(F.col("l.s") * F.col(x) + F.col("l.t") - F.col(y)) < F.col("__t")
    tried = kept.join(lines, key).select(key, x, y, "__t", F.explode("__lines").alias("l")).where(near)
    best = tried.groupBy(key, "l").agg(F.count("*").alias("n")).groupBy(key).agg(F.max(F.struct(F.col("n"), -F.col("l.__k"), F.col("l"))).alias("m"))
    best = materialise(best.select(key, F.col("m.l").alias("l"), F.col("m.n").alias("n")), "consensus-best")
    fit = kept.join(best, key).where(near).groupBy(key).agg(F.regr_slope(y, x).alias("scale"), F.regr_intercept(y, x).alias("shift"), F.count("*").alias("__n"))
    return fit.where("__n >= 2 and scale > 0").select(key, "scale", "shift", F.col("__n").alias("inliers"))


def anchor_frames(pixels: DataFrame, limits: AnchorLimits = AnchorLimits(), expected_scale: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(report of each frame, filled pixels) of ``pixels(frame, row, col, mono, conf, measured)``, every pixel of a frame a row.

    Filled are pixels without a measured depth whose own depth is positive and not among the least confident: the fitted
    depth, with the misfit of the nearest band pixel faded out over ``blend`` pixels, so that it meets the measured
    surface without a step. Depths too far from the band's are dropped. A weight is the pixel's rank by confidence times
    the share of inliers. ``expected_scale``: the scale of depths that are already metric, where they are.
    """
    lim = limits
    low = pixels.groupBy("frame").agg(F.percentile("conf", lim.drop_confidence).alias("__low"))
    p = pixels.select(*PIXEL, *(F.col(c).cast("double").alias(c) for c in ("mono", "conf", "measured"))).join(low, "frame")
    p = p.withColumn("valid", F.coalesce((F.col("mono") > 0) & ~F.isnan("mono") & (F.col("conf") >= F.col("__low")), F.lit(False))).drop("__low")
    p = materialise(p.withColumn("region", F.col("valid") & F.col("measured").isNull()), "anchor-pixels")
    d2 = nearest_cells(p, ["frame"], "row", "col", F.col("region")).select(*PIXEL, "d2")
    usable = F.col("valid") & F.col("measured").isNotNull()
    zone = F.when(usable & (F.col("d2") <= lim.band**2), "band").when(usable & (F.col("d2") <= (2 * lim.band) ** 2), "ring")
    p = materialise(p.join(d2, PIXEL).withColumn("zone", zone), "anchor-zones")

    tolerance = lambda c: F.greatest(F.lit(lim.near), lim.near_share * F.col(c))
    fits = consensus_lines(p.where("zone = 'band'"), "frame", "mono", "measured", tolerance("measured"), ["row", "col"], lim.pairs)
    p = p.join(materialise(fits.drop("inliers"), "anchor-fits"), "frame", "left").withColumn("off", F.col("scale") * F.col("mono") + F.col("shift") - F.col("measured"))
    p = p.withColumn("inlier", F.coalesce((F.col("zone") == "band") & (F.abs("off") < tolerance("measured")), F.lit(False)))
    when = lambda cond, x: F.when(cond, x)
    ring, band = F.col("zone") == "ring", F.col("zone") == "band"
    ends = F.percentile(when(F.col("inlier"), F.col("measured")), F.array(F.lit(0.02), F.lit(0.98)))
    report = p.groupBy("frame").agg(
        F.count_if("region").alias("region_px"), F.count_if(F.col("measured").isNotNull()).alias("measured_px"), F.count_if(band).alias("band_px"),
        F.first("scale").alias("scale"), F.first("shift").alias("shift"), F.count_if("inlier").alias("__in"),
        F.sqrt(F.avg(when(F.col("inlier"), F.col("off") * F.col("off")))).alias("residual"), F.median(when(band, F.col("measured"))).alias("band_depth"),
        F.median(when(ring, F.abs("off"))).alias("holdout"), F.median(when(ring, 100 * F.abs("off") / F.col("measured"))).alias("holdout_pct"), ends.alias("__ends"),
    )
    share = F.coalesce(F.col("__in") / F.nullif(F.col("band_px"), F.lit(0)), F.lit(0.0))
    most = F.greatest(F.lit(lim.residual), lim.residual_share * F.col("band_depth"))
    apart = F.abs(F.log(F.col("scale") / expected_scale)) > F.log(F.lit(lim.scale_factor)) if expected_scale else F.lit(False)
    missed = F.col("holdout_pct") > 100 * lim.holdout_share if lim.holdout_share is not None else F.lit(False)
    reason = (
        F.when(F.col("region_px") < lim.least_region, "nothing to fill")
        .when(F.col("band_px") < lim.least_band, "no measured pixels around")
        .when(share < lim.least_inliers, "too few agree")
        .when(F.col("residual") > most, "residual above the limit")
        .when(F.coalesce(missed, F.lit(False)), "held-out ring missed")
        .when(F.coalesce(apart, F.lit(False)), "scale is not the expected one")
    )
    report = report.withColumns({"inlier_share": share, "reason": reason})
    report = report.withColumn("status", F.when(F.col("reason").isNull(), "anchored").when(F.col("region_px") < lim.least_region, "skipped").otherwise("refused"))
    report = materialise(report, "anchor-report")

    good = report.where("status = 'anchored'").select("frame", "inlier_share", "band_depth", "__ends")
    p = materialise(p.join(good, "frame"), "anchor-good")
    near = nearest_cells(p, ["frame"], "row", "col", F.col("inlier"))
    seam = p.where("inlier").select("frame", F.col("row").alias("near_row"), F.col("col").alias("near_col"), (-F.col("off")).alias("__fix"))
    rows = p.where("region").drop("d2").join(near, PIXEL).join(seam, ["frame", "near_row", "near_col"])
    fade = F.greatest(F.lit(0.0), 1 - F.sqrt("d2") / max(lim.blend, 1))
    rows = rows.withColumn("depth", F.col("scale") * F.col("mono") + F.col("shift") + F.col("__fix") * fade)
    reach = lim.beyond_share * F.col("band_depth")
    rows = rows.where(F.col("depth").between(F.col("__ends")[0] - reach, F.col("__ends")[1] + reach))
    order = Window.partitionBy("frame")
    rank = F.row_number().over(order.orderBy("conf", "row", "col")) / F.count("*").over(order)
    filled = rows.select(*PIXEL, "depth", (lim.most_weight * rank * F.col("inlier_share")).alias("weight"))
    names = ["frame", "status", "reason", "region_px", "measured_px", "band_px", "scale", "shift", "inlier_share", "residual", "band_depth", "holdout", "holdout_pct"]
    return report.select(*names), filled


def fill(filled: DataFrame, cameras: DataFrame, ground: DataFrame, measured: DataFrame, size: float, cell: float, heights: tuple[float, float], *, stride: int = 1, least_weight: float = 0.3, cap: float = 0.5) -> DataFrame:
    """Voxels (i, j, k, w, frames, x, y, z) from filled pixels of anchored frames.

    ``cameras(frame, f, cu, cv, rotation, cx, cy, cz)`` place a pixel at its depth along the optical axis. Points count
    where ``ground(g_row, g_col)`` lists their ground cell as a gap or thin and their height lies in ``heights``. A voxel
    of ``measured(i, j, k)`` is never filled; others need ``least_weight`` in total, and their weight is capped.
    """
    p = filled.where((F.col("row") % stride == 0) & (F.col("col") % stride == 0)).join(cameras, "frame")
    d = [(F.col("col") + 0.5 - F.col("cu")) / F.col("f"), (F.col("row") + 0.5 - F.col("cv")) / F.col("f"), F.lit(1.0)]
    world = [F.col(c) + F.col("depth") * sum((F.col("rotation")[3 * j + i] * d[j] for j in range(3)), F.lit(0.0)) for i, c in enumerate(("cx", "cy", "cz"))]
    p = p.select("frame", "weight", *(w.alias(c) for w, c in zip(world, "xyz", strict=True))).where(F.col("z").between(*heights))
    p = p.withColumns({"g_row": F.floor(F.col("y") / cell).cast("long"), "g_col": F.floor(F.col("x") / cell).cast("long")}).join(ground.select("g_row", "g_col").distinct(), ["g_row", "g_col"])
    voxel = ["i", "j", "k"]
    p = p.withColumns({v: F.floor(F.col(c) / size).cast("long") for v, c in zip(voxel, "xyz", strict=True)})
    p = p.join(measured.select(*voxel).distinct(), voxel, "left_anti").where("weight > 0").withColumn("v", F.concat_ws(":", *voxel))
    made = weighted_fusion(p, "v", "frame", "weight", ["x", "y", "z"], least_weight, cap)
    at = F.split("v", ":")
    return made.select(*(at[n].cast("long").alias(v) for n, v in enumerate(voxel)), "w", "frames", "x", "y", "z")
