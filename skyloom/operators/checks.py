"""Input checks and summaries of frame, telemetry and camera tables (inventory P, J, A, O and S rows)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyloom.functions.scalar import band, haversine, soft
from skyloom.operators.stats import quantiles
from skyloom.session import materialise


def check(group: str, key: str, status: Column, value: Column, detail: str = "") -> Column:
    """One check as a struct."""
    return F.struct(F.lit(group).alias("grp"), F.lit(key).alias("key"), status.alias("status"), value.cast("double").alias("value"), F.lit(detail).alias("detail"))


def check_rows(df: DataFrame, keys: list[str], checks: list[Column]) -> DataFrame:
    """A row for each check of each input, in one pass."""
    return df.select(*keys, F.inline(F.array(*checks)))


def video_checks(width: str, height: str, fps: str, duration: str, bitrate: str) -> list[Column]:
    """Resolution, frame rate, duration and bits for each pixel."""
    pixels, bpp = F.col(width) * F.col(height), F.col(bitrate) / F.nullif(F.col(width) * F.col(height) * F.col(fps), F.lit(0))
    return [
        check("video", "resolution", band(pixels, 1920 * 1080, 1280 * 720), pixels, "pixels"),
        check("video", "fps", soft(band(fps, 24, 15)), F.col(fps), "frames a second"),
        check("video", "duration", band(duration, 20, 5), F.col(duration), "seconds"),
        check("video", "bits_per_pixel", soft(band(bpp, 0.05, 0.02)), bpp, "bits"),
    ]


def format_checks(projection: str, interlaced: str, hdr: str, rotation: str, real_fps: str, fps: str) -> list[Column]:
    """Projection, scan type, HDR, rotation and variable frame rate."""
    vary = F.abs(F.col(real_fps) - F.col(fps)) / F.nullif(F.col(fps), F.lit(0))
    flag = lambda bad, status="WARN": F.when(F.coalesce(bad, F.lit(False)), status).otherwise("PASS")
    return [
        check("format", "projection", flag(F.col(projection) != "flat", "BLOCK"), F.lit(None), "flat images only"),
        check("format", "scan", flag(F.col(interlaced)), F.col(interlaced).cast("int"), "interlaced"),
        check("format", "hdr", flag(F.col(hdr)), F.col(hdr).cast("int"), "tone curve"),
        check("format", "rotation", flag(F.col(rotation) % 360 != 0), F.col(rotation), "degrees"),
        check("format", "frame_rate", flag(vary > 0.02), vary, "variable frame rate"),
    ]


def decode_check(decoded: str, reached: str, errors: str) -> Column:
    """How much of a video could be decoded."""
    r = F.col(reached)
    status = F.when((F.col(decoded) < 2) | (r < 0.5), "BLOCK").when((r < 0.9) | (F.col(errors) > 0), "WARN").otherwise("PASS")
    return check("video", "decode", status, r, "share reached")


def extension_mismatch(suffix: str, container: str, known: dict[str, tuple[str, ...]]) -> Column:
    """Whether a file's suffix isn't one of its container's."""
    m = F.create_map(*(x for k, v in known.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    return F.coalesce(~F.array_contains(m[F.col(container)], F.lower(F.col(suffix))), F.lit(False))


def placeholder_columns(df: DataFrame, keys: list[str], columns: list[str], least: int = 20) -> DataFrame:
    """Columns that hold one value, or only zeros, over more than ``least`` rows."""
    agg = [F.struct(F.lit(c).alias("column"), F.count(c).alias("n"), F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias(c) for c in columns]
    rows = df.groupBy(*keys).agg(*agg).select(*keys, F.inline(F.array(*columns)))
    fixed = (F.col("n") > least) & (F.col("lo") == F.col("hi"))
    return rows.select(*keys, "column", F.coalesce(fixed, F.lit(False)).alias("placeholder"), F.coalesce(fixed & (F.col("lo") == 0), F.lit(False)).alias("zeros"))


def camera_pitch(df: DataFrame, keys: list[str], slant: str, height: str, elevation: str, gimbal: str) -> DataFrame:
    """Median pitch from slant range and height, else sensor elevation, else the gimbal, with its source."""
    ratio = F.col(height) / F.nullif(F.col(slant), F.lit(0.0))
    by_range = F.median(F.when((ratio > 0) & (ratio <= 1), -F.degrees(F.asin(ratio))))
    per = df.groupBy(*keys).agg(by_range.alias("a"), F.median(elevation).alias("b"), F.median(gimbal).alias("c"))
    source = F.when(F.col("a").isNotNull(), "slant_range").when(F.col("b").isNotNull(), "sensor").when(F.col("c").isNotNull(), "gimbal")
    return per.select(*keys, F.coalesce("a", "b", "c").alias("pitch"), source.alias("pitch_source"))


def nearest_place(df: DataFrame, key: str, lat: str, lon: str, home_lat: str, home_lon: str) -> DataFrame:
    """Least distance from a recorded place to any fix of its track."""
    return df.groupBy(key).agg(F.min(haversine(lat, lon, home_lat, home_lon)).alias("metres"))


def feasibility(df: DataFrame, keys: list[str], x: str, y: str, height: str, focal_px: str) -> DataFrame:
    """Extent, height and ground sample distance of a flight."""
    return df.groupBy(*keys).agg(
        F.greatest(F.max(x) - F.min(x), F.max(y) - F.min(y)).alias("extent"), F.median(height).alias("height"), F.median(F.col(height) / F.nullif(F.col(focal_px), F.lit(0.0))).alias("gsd")
    )


def mesh_is_broken(vertices: DataFrame, keys: list[str], bounds: DataFrame, coords: list[str], factor: float) -> DataFrame:
    """Vertices that aren't finite or lie beyond ``factor`` extents of the cloud's box; ``bounds`` is one row."""
    far = F.lit(False)
    for c in coords:
        span = F.col(f"max_{c}") - F.col(f"min_{c}")
        far = far | ~F.col(c).between(F.col(f"min_{c}") - factor * span, F.col(f"max_{c}") + factor * span)
    lost = F.lit(False)
    for c in coords:
        lost = lost | F.col(c).isNull() | F.isnan(c)
    rows = vertices.crossJoin(F.broadcast(bounds))
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.count_if(lost).alias("lost"), F.count_if(F.coalesce(far & ~lost, F.lit(False))).alias("far"))


def verdict_summary(df: DataFrame, keys: list[str], verdict: str, score: str, names: list[str]) -> DataFrame:
    """Counts of verdicts and median, least and most of a score."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"), *(F.count_if(F.col(verdict) == v).alias(f"n_{v}") for v in names), F.median(score).alias("median"), F.min(score).alias("least"), F.max(score).alias("most"))


def map_totals(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Totals by key of a map column."""
    rows = df.select(*keys, F.explode(column).alias("name", "value"))
    return rows.groupBy(*keys, "name").agg(F.sum("value").alias("total"))


def fill_summary(df: DataFrame, keys: list[str], status: str, reason: str, value: str) -> DataFrame:
    """Frames used and dropped, the distinct reasons in order and a median."""
    return df.groupBy(*keys).agg(F.count_if(F.col(status) == "used").alias("used"), F.count_if(F.col(status) != "used").alias("dropped"), F.array_sort(F.collect_set(F.when(F.col(status) != "used", F.col(reason)))).alias("reasons"), F.median(F.when(F.col(status) == "used", F.col(value))).alias("median"))


def nonzero_median(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Medians of the values that aren't zero."""
    return df.groupBy(*keys).agg(*(F.median(F.when(F.col(c) != 0, F.col(c))).alias(c) for c in columns))


def rms_by_kind(df: DataFrame, kind: Column, error: str) -> DataFrame:
    """RMS of control and check points."""
    return df.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"), F.sqrt(F.avg(F.col(error) * F.col(error))).alias("rms"))


def quantile_fit(df: DataFrame, keys: list[str], x: str, y: str, steps: int = 19) -> DataFrame:
    """Gain and bias that bring the quantiles of x onto those of y."""
    shares = F.array(*(F.lit((k + 1) / (steps + 1)) for k in range(steps)))
    q = df.groupBy(*keys).agg(F.percentile(x, shares).alias("a"), F.percentile(y, shares).alias("b"))
    pairs = q.select(*keys, F.inline(F.arrays_zip("a", "b")))
    return pairs.groupBy(*keys).agg(F.regr_slope("b", "a").alias("gain"), F.regr_intercept("b", "a").alias("bias"))


def trimmed_fit(df: DataFrame, keys: list[str], x: str, y: str, rounds: int = 3, keep: float = 0.9) -> DataFrame:
    """Least-squares line refitted without the largest residuals; a group may hold any share of the rows."""
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*keys, x, y)
    fit = rows.groupBy(*keys).agg(F.regr_slope(y, x).alias("gain"), F.regr_intercept(y, x).alias("bias"), F.count("*").alias("n"))
    for _ in range(rounds):
        fit = materialise(fit, "trimmed-fit")
        judged = rows.join(fit.drop("n"), keys).withColumn("r", F.abs(F.col(y) - F.col("gain") * F.col(x) - F.col("bias")))
        cut = materialise(quantiles(judged, keys, "r", [keep]).select(*keys, F.col("q0").alias("cut")), "trimmed-cut")
        fit = judged.join(cut, keys).where("r <= cut").groupBy(*keys).agg(F.regr_slope(y, x).alias("gain"), F.regr_intercept(y, x).alias("bias"), F.count("*").alias("n"))
    return fit


def selected_flag(df: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """Whether each row's key is among the kept ones."""
    return df.join(kept.select(key).distinct().withColumn("selected", F.lit(True)), key, "left").fillna(False, ["selected"])


def requested_rows(df: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows that are asked for, once each; what is out of range is skipped."""
    return df.join(wanted.select(key).distinct(), key, "left_semi")


def evenly_sampled(df: DataFrame, keys: list[str], order: str, n: int) -> DataFrame:
    """Every k-th row of each track such that about ``n`` stay."""
    w = Window.partitionBy(*keys)
    place, count = F.row_number().over(w.orderBy(order)) - 1, F.count("*").over(w)
    return df.withColumns({"__p": place, "__s": F.greatest(F.lit(1), F.floor(count / n))}).where("__p % __s = 0").drop("__p", "__s")


def best_per(df: DataFrame, keys: list[str], value: str, tie: str) -> DataFrame:
    """The row with the largest value of each key, the first of equals."""
    others = [c for c in df.columns if c not in keys]
    made = df.groupBy(*keys).agg(F.min_by(F.struct(*others), F.struct(-F.col(value), F.col(tie))).alias("r"))
    return made.select(*keys, *(F.col(f"r.{c}") for c in others))


def centre_deviation(a: DataFrame, b: DataFrame, name: str, coords: list[str]) -> DataFrame:
    """Errors of camera centres by name; null under three shared names."""
    other = b.select(name, *(F.col(c).alias(f"__{c}") for c in coords))
    d2 = sum((F.pow(F.col(c) - F.col(f"__{c}"), 2) for c in coords), F.lit(0.0))
    d = a.join(other, name).select(F.sqrt(d2).alias("d"))
    return d.agg(F.count("*").alias("shared"), F.when(F.count("*") >= 3, F.sqrt(F.avg(F.col("d") * F.col("d")))).alias("rms"), F.when(F.count("*") >= 3, F.max("d")).alias("worst"))


def nearest_colour(df: DataFrame, key: str, rgb: list[str], palette: dict[str, tuple[int, int, int]]) -> DataFrame:
    """Name of the nearest colour of a small fixed palette."""
    d = lambda c: sum((F.pow(F.col(x) - v, 2) for x, v in zip(rgb, c, strict=True)), F.lit(0.0))
    best = F.array_min(F.array(*(F.struct(d(c).alias("d"), F.lit(k).alias("k"), F.lit(n).alias("n")) for k, (n, c) in enumerate(palette.items()))))
    return df.select(key, best["n"].alias("name"))


def noisy_fixes(df: DataFrame, key: str, columns: list[str], sigma: float, outlier_rate: float, outlier: float, seed: int = 0) -> DataFrame:
    """Noise that follows from the key and a seed, so it is the same for any partitioning."""
    digits = lambda salt: F.substring(F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)), F.lit(salt))), 1, 10)
    unit = lambda salt: (F.conv(digits(salt), 16, 10).cast("double") + 0.5) / float(1 << 40)
    made = {}
    for k, c in enumerate(columns):
        normal = F.sqrt(-2 * F.log(unit(f"{k}a"))) * F.cos(2 * 3.141592653589793 * unit(f"{k}b"))
        jump = F.when(unit("out") < outlier_rate, F.when(unit(f"{k}s") < 0.5, -outlier).otherwise(outlier)).otherwise(0.0)
        made[c] = F.col(c) + sigma * normal + jump
    return df.withColumns(made)


def grid_around(df: DataFrame, x: str, y: str, res: float, pad: int = 1) -> DataFrame:
    """One row (x0, y1, width, height) of a grid around all points, its edges on multiples of ``res``."""
    x0, y1 = F.floor(F.min(x) / res) - pad, F.ceil(F.max(y) / res) + pad
    made = df.agg(x0.alias("a"), y1.alias("b"), (F.ceil(F.max(x) / res) + pad).alias("c"), (F.floor(F.min(y) / res) - pad).alias("d"))
    return made.select((F.col("a") * res).alias("x0"), (F.col("b") * res).alias("y1"), (F.col("c") - F.col("a")).cast("long").alias("width"), (F.col("b") - F.col("d")).cast("long").alias("height"))


def cropped(cells: DataFrame, value: str) -> DataFrame:
    """Cells moved so that the box of those that hold something starts at (0, 0)."""
    box = cells.where(F.col(value).isNotNull()).agg(F.min("row").alias("r0"), F.min("col").alias("c0"), F.max("row").alias("r1"), F.max("col").alias("c1"))
    inside = cells.crossJoin(F.broadcast(box)).where("row between r0 and r1 and col between c0 and c1")
    return inside.select((F.col("row") - F.col("r0")).alias("row"), (F.col("col") - F.col("c0")).alias("col"), value)


def mark_filled(cells: DataFrame, fill: DataFrame, zone: str) -> DataFrame:
    """Zone 3 becomes 2 where fill falls."""
    there = fill.select("row", "col").distinct().withColumn("__f", F.lit(True))
    mark = F.when((F.col(zone) == 3) & F.col("__f"), 2).otherwise(F.col(zone))
    return cells.join(there, ["row", "col"], "left").withColumn(zone, mark).drop("__f")


def posed_points(points: DataFrame, cameras: DataFrame, views: str, cam: str) -> DataFrame:
    """Exploded views with their camera, -1 where a view has no pose; the point's row travels along."""
    known = cameras.select(F.col(cam).alias("__v"), F.lit(True).alias("__k"))
    rows = points.withColumn("__v", F.explode(views)).join(known, "__v", "left")
    return rows.withColumn("view", F.when(F.col("__k"), F.col("__v")).otherwise(-1)).drop("__v", "__k")


def reference_cells(points: DataFrame, x: str, y: str, z: str, kind: str, res: float, ground: int = 2, noise: tuple[int, ...] = (7, 18)) -> DataFrame:
    """Highest point and lowest ground point of each cell, without noise classes."""
    held = points.where(~F.col(kind).isin(*noise)) if noise else points
    row, col = F.floor(F.col(y) / res).cast("long").alias("row"), F.floor(F.col(x) / res).cast("long").alias("col")
    return held.groupBy(row, col).agg(F.max(z).alias("dsm"), F.min(F.when(F.col(kind) == ground, F.col(z))).alias("dtm"))


def depth_agreement(df: DataFrame, cam: str, rank: str, pixel: list[str], depth: str, neighbours: int, tolerance: float, least: int) -> DataFrame:
    """Pixels whose depth agrees with that of enough of the next cameras; an equi-join on pixels and rank steps."""
    steps = F.array(*(F.col(rank) + k for k in range(-neighbours, neighbours + 1) if k))
    asked = df.withColumn("__r", F.explode(steps))
    other = df.select(*pixel, F.col(rank).alias("__r"), F.col(depth).alias("__d"))
    near = F.abs(F.col("__d") - F.col(depth)) <= tolerance * F.col(depth)
    votes = asked.join(other, [*pixel, "__r"]).groupBy(cam, *pixel).agg(F.count_if(near).alias("agree"))
    return votes.where(F.col("agree") >= least)


def contained_names(texts: DataFrame, text: str, names: DataFrame, name: str, head: int = 3) -> DataFrame:
    """Each row of ``texts`` with each row of ``names`` that its text contains, case aside.

    A join on the first ``head`` characters of the name, which stand at some place of the text.
    """
    t, n = F.lower(F.col(text)), F.lower(F.col(name))
    places = F.sequence(F.lit(1), F.greatest(F.length(t), F.lit(1)))
    heads = F.array_distinct(F.flatten(F.transform(F.array(*map(F.lit, range(1, head + 1))), lambda k: F.transform(places, lambda p: F.substring(t, p, k)))))
    spread = texts.withColumn("__head", F.explode(heads))
    keyed = names.where(F.length(n) > 0).withColumn("__key", F.substring(n, 1, head))
    return spread.join(keyed, (F.col("__head") == F.col("__key")) & F.contains(t, n)).drop("__head", "__key")


def sidecars(files: DataFrame, path: str, videos: tuple[str, ...], suffixes: tuple[str, ...]) -> DataFrame:
    """(video, sidecar) of a listing: for each video the file of its folder and stem, case aside, whose suffix comes first."""
    low = F.lower(F.col(path))
    rows = files.select(F.col(path).alias("p"), F.regexp_replace(low, r"\.[^./]*$", "").alias("stem"), F.regexp_extract(low, r"(\.[^./]*)$", 1).alias("suffix"))
    rank = F.array_position(F.array(*map(F.lit, suffixes)), F.col("suffix"))
    sides = rows.where(rank > 0).groupBy("stem").agg(F.min_by("p", F.struct(rank, F.col("p"))).alias("sidecar"))
    return rows.where(F.col("suffix").isin(*videos)).join(sides, "stem", "left").select(F.col("p").alias("video"), "sidecar")


def allotments(stages: DataFrame, run: str, weight: str, done: str, remaining: str) -> DataFrame:
    """Seconds of each open stage: its share of the weights of its run's open stages in the time that remains."""
    open_ = F.when(~F.col(done), F.col(weight))
    share = F.col(weight) / F.nullif(F.sum(open_).over(Window.partitionBy(run)), F.lit(0.0))
    return stages.withColumn("allotment", F.when(~F.col(done), share * F.greatest(F.col(remaining), F.lit(0.0))))
