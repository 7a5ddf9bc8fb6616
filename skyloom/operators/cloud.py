"""Point clouds: voxels, neighbours, visibility, zones (inventory A11 to A23, J8 to J22, P9, R10)."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyloom.operators.stats import quantiles
from skyloom.session import materialise, parts


def cells(df: DataFrame, coords: list[str], size: Column | float, prefix: str = "c_") -> DataFrame:
    """Grid indices of the coordinates."""
    s = F.lit(size) if isinstance(size, int | float) else size
    return df.withColumns({f"{prefix}{c}": F.floor(F.col(c) / s).cast("long") for c in coords})


def voxel_aggregate(df: DataFrame, coords: list[str], size: float, extra: list[Column] = ()) -> DataFrame:
    """Count and centroid of each occupied voxel; combined before the shuffle."""
    keys = [f"c_{c}" for c in coords]
    return cells(df, coords, size).groupBy(*keys).agg(F.count("*").alias("n"), *(F.avg(c).alias(f"m_{c}") for c in coords), *extra)


def occupied_cells(df: DataFrame, coords: list[str], sizes: list[float]) -> DataFrame:
    """Occupied cells at several sizes in one pass."""
    rows = df.select(*coords, F.explode(F.array(*map(F.lit, sizes))).alias("size"))
    keys = [f"c_{c}" for c in coords]
    return cells(rows, coords, F.col("size")).select("size", *keys).distinct().groupBy("size").agg(F.count("*").alias("cells"))


def choose_voxel_size(df: DataFrame, coords: list[str], start: float, most: int, tries: int = 8) -> DataFrame:
    """The first size, growing by half, at which no more than ``most`` cells are occupied."""
    found = occupied_cells(df, coords, [start * 1.5**k for k in range(tries)])
    return found.agg(F.coalesce(F.min(F.when(F.col("cells") <= most, F.col("size"))), F.max("size")).alias("size"))


def _with_neighbours(df: DataFrame, coords: list[str], radius: float) -> DataFrame:
    """Rows under the cell of each coordinate and all cells next to it."""
    df = cells(df, coords, radius)
    for c in coords:
        df = df.withColumn(f"c_{c}", F.explode(F.array(*(F.col(f"c_{c}") + k for k in (-1, 0, 1)))))
    return df


def radius_pairs(left: DataFrame, right: DataFrame, left_id: str, right_id: str, coords: list[str], radius: float) -> DataFrame:
    """All pairs within ``radius``: an equi-join on grid cells, exact as a cell is as wide as the radius."""
    a = cells(left.select(left_id, *coords), coords, radius)
    b = _with_neighbours(right.select(F.col(right_id).alias("__rid"), *(F.col(c).alias(f"__{c}") for c in coords)).withColumns({c: F.col(f"__{c}") for c in coords}), coords, radius).drop(*coords)
    d2 = sum((F.pow(F.col(c) - F.col(f"__{c}"), 2) for c in coords), F.lit(0.0))
    joined = a.join(b, [f"c_{c}" for c in coords]).withColumn("distance", F.sqrt(d2)).where(F.col("distance") <= radius)
    return joined.select(left_id, F.col("__rid").alias(right_id if right_id != left_id else "other"), "distance")


def _crowds(right: DataFrame, coords: list[str], radius: float) -> tuple[float, int]:
    """Pairs of rows that share a cell, and rows."""
    n = cells(right, coords, 2 * radius).groupBy(*(f"c_{c}" for c in coords)).count()
    near, rows = n.agg(F.sum(F.col("count").cast("double") * F.col("count")), F.sum("count")).first()
    return near or 0.0, rows or 0


def _first_radius(right: DataFrame, coords: list[str], radius: float, crowd: int, pairs: int) -> float:
    """``radius``, halved until a row shares its cell with few others, or until all cells together hold few pairs."""
    for _ in range(20):
        near, rows = _crowds(right, coords, radius)
        if near <= pairs or near <= crowd * rows:
            break
        radius /= 2
    return radius


def k_nearest(left: DataFrame, right: DataFrame, left_id: str, right_id: str, coords: list[str], radius: float, k: int, *, exclude_self: bool = False, crowd: int = 32, pairs: int = 10_000_000, task: int = 2_000_000) -> DataFrame:
    """(left_id, __k, other, distance): the ``k`` nearest rows of ``right`` within ``radius``, ties by ``right_id``, exact.

    Pairs within ``radius`` grow with the square of a cloud's density, so places are first searched within a small radius;
    those with too few rows in it are searched again within twice as much, up to ``radius``. Each distinct place is searched
    once, and of rows in one place only those that can be among the nearest count. Cells are dealt to as many tasks as
    leave each about ``task`` pairs of a place and a row of its cells.
    """
    least = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keep, bare = k + exclude_self, [f"__{c}" for c in coords]
    sound = lambda df: df.where(reduce(lambda a, c: a & F.col(c).isNotNull() & ~F.isnan(c), coords, F.lit(True)))
    rows = sound(right.select(F.col(right_id).alias("other"), *(F.col(c).cast("double").alias(c) for c in coords)))
    rows = rows.withColumn("__k", F.row_number().over(Window.partitionBy(*coords).orderBy("other"))).where(F.col("__k") <= keep).drop("__k")
    rows = materialise(rows, "near-rows")
    spots = left.select(F.col(left_id).alias(left_id), *(F.col(c).cast("double").alias(b) for c, b in zip(coords, bare, strict=True)))
    todo = materialise(sound(left.select(*(F.col(c).cast("double").alias(c) for c in coords))).distinct().toDF(*bare), "near-places")
    r, found = _first_radius(rows, coords, radius, crowd, pairs), None
    while True:
        last = r >= radius
        r = radius if last else r
        crowded, n = _crowds(rows, coords, r)
        tasks = max(least, math.ceil(todo.count() * 2 ** len(coords) * crowded / max(n, 1) / task))
        reach, at, held = r * (1 + 1e-9), todo, [f"c_{c}" for c in coords]
        for c, b in zip(coords, bare, strict=True):  # two cells of an axis at most
            ends = F.array(*(F.floor((F.col(b) + side * reach) / (2 * r)).cast("long") for side in (-1, 1)))
            at = at.withColumn(f"c_{c}", F.explode(F.array_distinct(ends)))
        d2 = sum((F.pow(F.col(b) - F.col(c), 2) for c, b in zip(coords, bare, strict=True)), F.lit(0.0))
        near = at.repartition(tasks, *held).join(cells(rows, coords, 2 * r).repartition(tasks, *held), held).select(*bare, "other", F.sqrt(d2).alias("distance")).where(F.col("distance") <= r)
        near = near.withColumn("__k", F.row_number().over(Window.partitionBy(*bare).orderBy("distance", "other"))).where(F.col("__k") <= keep)
        near = materialise(near, "near")
        if last:
            found = near if found is None else found.unionByName(near)
            break
        done = near.where(F.col("__k") == keep).select(*bare)
        whole = near.join(done, bare, "left_semi")
        found = whole if found is None else found.unionByName(whole)
        todo = materialise(todo.join(done, bare, "left_anti"), "near-places")
        r *= 2
    made = spots.join(found.drop("__k"), bare).drop(*bare)
    if exclude_self:
        made = made.where(F.col(left_id) != F.col("other"))
    return made.withColumn("__k", F.row_number().over(Window.partitionBy(left_id).orderBy("distance", "other"))).where(F.col("__k") <= k)


def nearest_within(left: DataFrame, right: DataFrame, left_id: str, right_id: str, coords: list[str], radius: float, *, exclude_self: bool = False) -> DataFrame:
    """Nearest row of ``right`` within ``radius`` of each row of ``left``, null where there is none."""
    best = k_nearest(left, right, left_id, right_id, coords, radius, 1, exclude_self=exclude_self).select(left_id, F.col("other").alias("nearest"), "distance")
    return left.select(left_id).join(best, left_id, "left")


def knn_spacing(df: DataFrame, id_: str, coords: list[str], radius: float, k: int = 1) -> DataFrame:
    """Distance to the k-th neighbour within ``radius``."""
    return k_nearest(df, df, id_, id_, coords, radius, k, exclude_self=True).where(F.col("__k") == k).select(id_, "distance")


def distinct_views(points: DataFrame, voxel: str, view: str) -> DataFrame:
    """Distinct (voxel, view) pairs; negative views are unposed."""
    return points.where(F.col(view) >= 0).select(voxel, view).distinct()


def zones(points: DataFrame, voxel: str, view: str, confidence: str, min_views: int, min_confidence: float) -> DataFrame:
    """Zone of each voxel from its distinct views and mean confidence, to 12 digits: a mean that equals the limit
    reaches it, in whatever order its terms were added."""
    mean = F.round(F.avg(confidence), 12).alias("confidence")
    per = points.groupBy(voxel).agg(F.countDistinct(F.when(F.col(view) >= 0, F.col(view))).alias("views"), mean)
    zone = F.when((F.col("views") >= min_views) & (F.col("confidence") >= min_confidence), 1).when(F.col("views") >= 1, 2).otherwise(3)
    return per.withColumn("zone", zone)


def best_zone_per_cell(df: DataFrame, keys: list[str], zone: str) -> DataFrame:
    """The best zone of each ground cell; 1 beats 2 beats 3."""
    return df.groupBy(*keys).agg(F.min(zone).alias("zone"), F.count("*").alias("n"))


def widest_angle(rays: DataFrame, key: str, ray_id: str, coords: list[str]) -> DataFrame:
    """Widest angle among a key's unit rays by the two-pass estimate: the ray farthest from the mean
    direction, then the one farthest from that. Grouped aggregates and joins by key, no pairs."""
    length = F.sqrt(sum((F.col(c) * F.col(c) for c in coords), F.lit(0.0)))
    unit = rays.where(length > 0).select(key, ray_id, *((F.col(c) / length).alias(c) for c in coords))
    mean = unit.groupBy(key).agg(*(F.avg(c).alias(f"m_{c}") for c in coords), F.count("*").alias("n"))
    dot = lambda p: sum((F.col(c) * F.col(f"{p}{c}") for c in coords), F.lit(0.0))
    first = unit.join(mean, key).groupBy(key).agg(F.first("n").alias("n"), F.min_by(F.struct(*coords), F.struct(F.round(dot("m_"), 12), F.col(ray_id))).alias("__f"))
    first = first.select(key, "n", *(F.col(f"__f.{c}").alias(f"f_{c}") for c in coords))
    return unit.join(first, key).groupBy(key).agg(F.first("n").alias("n"), F.degrees(F.acos(F.least(F.greatest(F.min(dot("f_")), F.lit(-1.0)), F.lit(1.0)))).alias("angle"))


def photometric(df: DataFrame, key: str, value: str, scale: float) -> DataFrame:
    """1 less the deviation over ``scale``, clipped to 0..1; null under two samples."""
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - F.stddev_pop(value) / scale))
    return df.groupBy(key).agg(F.count(value).alias("n"), F.when(F.count(value) >= 2, score).alias("consistency"))


def visible(projected: DataFrame, cam: str, u: str, v: str, depth: str, tolerance: float) -> DataFrame:
    """Rows of (cam, pixel) at most ``tolerance`` behind the nearest in the 3 x 3 pixels around.

    The z-buffer is a minimum per pixel, its 3 x 3 minimum a grouped aggregate over shifted keys.
    """
    zbuf = projected.groupBy(cam, u, v).agg(F.min(depth).alias("__z"))
    for axis in (u, v):
        shifted = zbuf.withColumn(axis, F.explode(F.array(*(F.col(axis) + k for k in (-1, 0, 1)))))
        zbuf = shifted.groupBy(cam, u, v).agg(F.min("__z").alias("__z"))
    return projected.join(zbuf, [cam, u, v]).where(F.col(depth) <= F.col("__z") + tolerance).drop("__z")


def weighted_fusion(df: DataFrame, key: str, frame: str, weight: str, values: list[str], least_weight: float, cap: float, without: DataFrame | None = None) -> DataFrame:
    """Weighted means of each voxel over its frames, with enough weight, the weight capped; not of voxels in ``without``.

    Weights and values count to six decimals: the sums are exact, so their order doesn't show. Rows are dealt once, by voxel,
    to as many tasks as they need, as few share a voxel and a frame.
    """
    df = df.select(key, frame, weight, *values).repartition(parts(df), key)
    if without is not None:  # its real size decides, as an anti join comes before rows are dealt
        df = df.join(materialise(without, "fusion-without"), key, "left_anti")
    exact = lambda c: F.col(c).cast("decimal(12,6)")
    sums = [F.sum((exact(weight) * exact(v)).cast("decimal(24,12)")).cast("double").alias(v) for v in values]
    made = df.groupBy(key).agg(F.sum(exact(weight)).alias("w"), F.countDistinct(frame).alias("frames"), *sums).where(F.col("w") >= least_weight)
    w = F.col("w").cast("double")
    return made.select(key, F.least(w, F.lit(float(cap))).alias("w"), "frames", *((F.col(v) / F.nullif(w, F.lit(0.0))).alias(v) for v in values))


def near_camera(points: DataFrame, cameras: DataFrame, point_id: str, cam_id: str, coords: list[str], clearance: float) -> DataFrame:
    """Points nearer than ``clearance`` to any camera; a radius join, so no product of the two tables."""
    pairs = radius_pairs(points, cameras, point_id, cam_id, coords, clearance)
    return pairs.groupBy(point_id).agg(F.min("distance").alias("distance"))


def cloud_to_cloud(left: DataFrame, right: DataFrame, left_id: str, right_id: str, coords: list[str], radius: float) -> DataFrame:
    """Share of points matched within ``radius`` and their median and RMS distance."""
    near = materialise(nearest_within(left, right, left_id, right_id, coords, radius).select("distance"), "distances")
    d = F.col("distance")
    made = near.agg(F.count("*").alias("n"), (100 * F.avg(d.isNotNull().cast("double"))).alias("matched_pct"), F.sqrt(F.avg(d * d)).alias("rms"))
    middle = quantiles(near, [], "distance", [0.5]).select(F.col("q0").alias("median"))
    return made.join(middle, F.lit(True), "left").select("n", "matched_pct", "median", "rms")  # one row each


def set_cover(pairs: DataFrame, cam: str, cell: str, most: int, least_gain: int) -> list:
    """O3: cameras by greedy cover; a round counts and writes what is left, and rounds are bounded by ``most``."""
    chosen: list = []
    left = materialise(pairs.select(cam, cell).distinct(), "uncovered")
    for _ in range(most):
        best = left.groupBy(cam).agg(F.count("*").alias("n")).orderBy(F.desc("n"), cam).first()
        if best is None or best["n"] < least_gain:
            break
        chosen.append(best[cam])
        left = materialise(left.join(left.where(F.col(cam) == best[cam]).select(cell), cell, "left_anti").select(cam, cell), "uncovered")
    return chosen
