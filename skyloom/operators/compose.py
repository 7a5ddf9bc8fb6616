"""Passes composed of the other operators, and readers with fallbacks (inventory G rows, S30 to S51, K22, Y rows)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException
from pyspark.sql.window import Window

from skyloom.functions import scalar as S
from skyloom.operators import cloud, interp, raster, recurrences, windows


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table, or an empty one with its schema where there is none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def load_history(spark: SparkSession, path: str, schema: str, stage: str | None = None) -> DataFrame:
    """An append-only history, of one stage where asked, its runs numbered in order."""
    try:
        rows = spark.read.schema(schema).json(path)
    except AnalysisException:
        rows = spark.createDataFrame([], schema)
    rows = rows.where(F.col("stage") == stage) if stage else rows
    return rows.withColumn("run", F.row_number().over(Window.partitionBy("stage").orderBy("started")))


def widened(df: DataFrame, keys: list[str], column: str, names: list[str]) -> DataFrame:
    """Chosen entries of a map as columns."""
    return df.select(*keys, *(F.col(column)[n].alias(n) for n in names))


def first_seen_groups(df: DataFrame, group: str, place: str) -> DataFrame:
    """Groups in the order in which they are first met."""
    return df.groupBy(group).agg(F.min(place).alias("first"), F.count("*").alias("n"))


def first_folder_wins(df: DataFrame, kind: str, order: str) -> DataFrame:
    """For each kind the row of the first folder."""
    return windows.last_per_key(df, [kind], [F.col(order)])


def strip_input(df: DataFrame, keys: list[str], time: str, columns: list[str], start: float, end: float) -> DataFrame:
    """A track cut to [start, end] on its own clock, with an interpolated first row at the cut."""
    cut = interp.at_times(df, df.select(*keys).distinct().withColumn(time, F.lit(float(start))), keys, time, columns).drop("interpolated")
    rest = df.where((F.col(time) > start) & (F.col(time) <= end)).select(*keys, F.col(time).cast("double").alias(time), *columns)
    return cut.unionByName(rest).withColumn(time, F.col(time) - start)


def geodetic_of_utm(east: Column, north: Column, zone: Column, south: Column) -> list[Column]:
    """M9: longitude and latitude of UTM coordinates, by the inverse Krueger series and a fixed number of refinements."""
    n = S.WGS84_F / (2 - S.WGS84_F)
    radius = S.WGS84_A / (1 + n) * (1 + n**2 / 4 + n**4 / 64) * 0.9996
    beta = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480]
    xi, eta = (north - F.when(south, 10000000.0).otherwise(0.0)) / radius, (east - 500000) / radius
    x = xi - sum((b * F.sin(2 * (k + 1) * xi) * F.cosh(2 * (k + 1) * eta) for k, b in enumerate(beta)), F.lit(0.0))
    y = eta - sum((b * F.cos(2 * (k + 1) * xi) * F.sinh(2 * (k + 1) * eta) for k, b in enumerate(beta)), F.lit(0.0))
    chi = F.asin(F.sin(x) / F.cosh(y))
    delta = [2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15]
    lat = chi + sum((d * F.sin(2 * (k + 1) * chi) for k, d in enumerate(delta)), F.lit(0.0))
    return [F.degrees(F.atan2(F.sinh(y), F.cos(x))) + zone * 6 - 183, F.degrees(lat)]


def to_map(xyz: list[Column], offset: list[Column]) -> list[Column]:
    """Local coordinates on the map."""
    return [a + b for a, b in zip(xyz, offset, strict=True)]


def piecewise(x: Column, knots: list[tuple[float, float]]) -> Column:
    """A piecewise linear curve, flat beyond its ends."""
    out = F.when(x <= knots[0][0], F.lit(float(knots[0][1])))
    for (a, fa), (b, fb) in zip(knots, knots[1:], strict=False):
        out = out.when(x <= b, F.lit(float(fa)) + (x - a) * ((fb - fa) / (b - a)))
    return out.otherwise(F.lit(float(knots[-1][1])))


def condition_track(df: DataFrame, keys: list[str], time: str, *, max_speed: float, max_accel: float, half: int = 5, tolerance: float = 5.0, noise: float = 0.5, sigmas: tuple[float, float, float] = (3.0, 3.0, 6.0)) -> DataFrame:
    """Fixes (lat, lon, alt) conditioned: envelope, rolling median, smoothing, back to degrees, flags.

    Outliers keep their rows; their fixes are left out of the smoothing, which coasts over them.
    """
    first = df.groupBy(*keys).agg(*(F.min_by(c, time).alias(f"{c}0") for c in ("lat", "lon", "alt")))
    e, n, u = S.enu_wgs84("lat", "lon", "alt", "lat0", "lon0", "alt0")
    rows = df.select(*keys, time, "lat", "lon", "alt").join(first, keys).withColumns({"e": e, "n": n, "u": u})
    wild = recurrences.envelope_outliers(rows, keys, time, ["e", "n", "u"], max_speed, max_accel)
    rows = rows.join(wild, [*keys, time])
    held = rows.withColumns({c: F.when(~F.col("outlier"), F.col(c)) for c in ("e", "n")})
    for c in ("e", "n"):
        held = windows.rolling_median(held, keys, [time], c, half, f"m_{c}")
    stray = F.sqrt(F.pow(F.col("e") - F.col("m_e"), 2) + F.pow(F.col("n") - F.col("m_n"), 2)) > tolerance
    held = held.withColumn("outlier", F.col("outlier") | F.coalesce(stray, F.lit(False)))
    held = held.withColumns({c: F.when(~F.col("outlier"), F.col(c)) for c in ("e", "n", "u")})
    smooth = recurrences.kalman_smooth(held, keys, time, ["e", "n", "u"], noise, list(sigmas))
    out = held.select(*keys, time, "outlier", "lat0", "lon0", "alt0").join(smooth, [*keys, time])
    lat, lon = S.geodetic_of_enu("s_e", "s_n", "lat0", "lon0", "alt0")
    flags = S.validity_flags({"gps": F.lit(True), "alt_gps": F.lit(True), "smoothed": F.lit(True), "outlier": F.col("outlier")})
    return out.select(*keys, time, lat.alias("lat"), lon.alias("lon"), (F.col("s_u") + F.col("alt0")).alias("alt"), flags.alias("flags"))


def classify_cloud(points: DataFrame, cameras: DataFrame, size: float, *, min_views: int = 4, min_angle: float = 5.0) -> DataFrame:
    """Zones of voxels of ``points(point_id, x, y, z, view)`` seen by ``cameras(view, cx, cy, cz)``.

    Centroids, distinct views, widest ray angle, then the zone; each step is an aggregate or a join by voxel or view.
    """
    keys = ["c_x", "c_y", "c_z"]
    held = cloud.cells(points, ["x", "y", "z"], size)
    voxels = held.groupBy(*keys).agg(F.count("*").alias("n"), *(F.avg(c).alias(f"m_{c}") for c in "xyz"))
    voxels = voxels.withColumn("voxel", F.concat_ws(":", *keys))
    pairs = held.withColumn("voxel", F.concat_ws(":", *keys)).select("voxel", "view").distinct().join(cameras, "view")
    rays = pairs.join(voxels.select("voxel", "m_x", "m_y", "m_z"), "voxel")
    rays = rays.select("voxel", "view", *((F.col(f"c{c}") - F.col(f"m_{c}")).alias(c) for c in "xyz"))
    angle = cloud.widest_angle(rays, "voxel", "view", ["x", "y", "z"])
    made = voxels.join(angle.select("voxel", F.col("n").alias("views"), "angle"), "voxel", "left").fillna(0, ["views"])
    return made.withColumn("zone", S.zone_label("views", F.coalesce("angle", F.lit(0.0)), min_views, min_angle)).select(*keys, "n", "views", "angle", "zone")


def fusion_pass(points: DataFrame, cameras: DataFrame, size: float, cell: int, least_area: float, sure: int = 2, most: int = 10**9) -> dict[str, DataFrame]:
    """Zones of voxels, best zone of ground cells, and as regions the gaps inside the seen box: cells that are
    missing or whose best zone is beyond ``sure``. A box of more than ``most`` cells is an error: points far off
    must be cut away first."""
    zones = classify_cloud(points, cameras, size)
    ground = cloud.best_zone_per_cell(zones.select(F.floor(F.col("c_y") / cell).alias("row"), F.floor(F.col("c_x") / cell).alias("col"), "zone"), ["row", "col"], "zone")
    box = ground.agg(F.min("row").alias("r0"), F.max("row").alias("r1"), F.min("col").alias("c0"), F.max("col").alias("c1"))
    r0, r1, c0, c1 = box.first()
    if r0 is not None and (r1 - r0 + 1) * (c1 - c0 + 1) > most:
        raise ValueError(f"a box of {r1 - r0 + 1} x {c1 - c0 + 1} cells; at most {most}")
    # rows of the box are dealt to tasks, each makes the cells of its rows
    lines = points.sparkSession.range(r0 or 0, (r1 if r1 is not None else -1) + 1).select(F.col("id").alias("row"))
    every = lines.select("row", F.explode(F.sequence(F.lit(c0 or 0).cast("long"), F.lit(c1 or 0).cast("long"))).alias("col"))
    gaps = every.join(ground.where(F.col("zone") <= sure).select("row", "col"), ["row", "col"], "left_anti")
    return {"zones": zones, "ground": ground, "gaps": raster.regions(gaps, cell * size, least_area)}


def verified_gaps(features: DataFrame, text: str, claimed: DataFrame) -> DataFrame:
    """Whether a set of GeoJSON features has the claimed number and area and lies on the globe."""
    f = features.select(F.from_json(text, "properties struct<area: double>, geometry struct<coordinates: array<array<array<double>>>>").alias("f"))
    place = F.forall(F.flatten(F.col("f.geometry.coordinates")), lambda p: p[0].between(-180, 180) & p[1].between(-90, 90))
    found = f.agg(F.count("*").alias("n"), F.sum("f.properties.area").alias("area"), F.bool_and(place).alias("on_globe"))
    return found.crossJoin(F.broadcast(claimed.select(F.col("n").alias("cn"), F.col("area").alias("ca")))).select("n", "area", ((F.col("n") == F.col("cn")) & (F.abs(F.col("area") - F.col("ca")) <= 0.01 * F.abs(F.col("ca"))) & F.col("on_globe")).alias("ok"))
