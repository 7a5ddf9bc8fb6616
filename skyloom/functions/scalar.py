"""Scalar expressions: text, time, geodesy, projection (inventory F, D, M, P rows).

Every function takes columns or names and returns a column, so Catalyst sees plain expressions.
"""

from __future__ import annotations

from math import pi

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS84, the sphere radii of the local-metre models, metres of a degree for plots.
WGS84_A, WGS84_F = 6378137.0, 1 / 298.257223563
SPHERE_R, HAVERSINE_R, PLOT_M_PER_DEG = 6378137.0, 6371000.0, 111320.0
# Validity bits of a telemetry row.
FLAGS = {"gps": 1, "alt_gps": 2, "alt_baro": 4, "attitude": 8, "focal": 16, "rtk": 32, "outlier": 64, "interpolated": 128, "smoothed": 256}

C = Column | str


def col(c: C) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- text (F) ---------------------------------------------------------------


def normalise_header(c: C) -> Column:
    """lower case, letters and digits only."""
    return F.regexp_replace(F.lower(col(c)), "[^a-z0-9]", "")


def safe_double(c: C) -> Column:
    """a number, or null where the text isn't one."""
    return F.trim(col(c).cast("string")).try_cast("double")


def cue_seconds(c: C) -> Column:
    """``hh:mm:ss,mmm`` as seconds; a short fraction counts from the left."""
    part = lambda k: F.regexp_extract(col(c), r"(\d+):(\d+):(\d+)[,.](\d{1,3})", k)
    n = lambda k: part(k).try_cast("double")
    return F.when(part(1) != "", n(1) * 3600 + n(2) * 60 + n(3) + F.rpad(part(4), 3, "0").try_cast("double") / 1000)


def format_cue(seconds: C) -> Column:
    """seconds as ``hh:mm:ss,mmm``."""
    ms = F.round(col(seconds) * 1000).cast("long")
    return F.format_string("%02d:%02d:%02d,%03d", F.expr("0") + F.floor(ms / 3600000), F.floor(ms / 60000) % 60, F.floor(ms / 1000) % 60, ms % 1000)


def wall_time(c: C) -> Column:
    """the first ``yyyy-mm-dd hh:mm:ss[.ffffff]`` of a text as a UTC timestamp."""
    found = F.regexp_extract(col(c), r"(\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}(?:[.,]\d{1,6})?)", 1)
    return F.try_to_timestamp(F.regexp_replace(F.regexp_replace(found, ",", "."), "T", " "))


def iso6709(c: C) -> Column:
    """``+lat+lon`` as struct<lat, lon>."""
    pattern = r"([+-]\d+(?:\.\d+)?)([+-]\d+(?:\.\d+)?)"
    part = lambda k: F.regexp_extract(col(c), pattern, k).try_cast("double")
    return F.when(part(1).isNotNull(), F.struct(part(1).alias("lat"), part(2).alias("lon")))


def dms_degrees(d: C, m: C, s: C, ref: C) -> Column:
    """degrees from degrees, minutes, seconds and hemisphere."""
    v = col(d) + col(m) / 60 + col(s) / 3600
    return F.when(F.upper(F.trim(col(ref))).isin("S", "W"), -v).otherwise(v)


def local_name(c: C) -> Column:
    """F8: an XML name without its namespace."""
    return F.substring_index(col(c), "}", -1)


def stream_kind(text: C) -> Column:
    """kind of a data stream by what its codec, tag or handler names contain."""
    t = F.lower(col(text))
    return (
        F.when(t.contains("gpmd") | t.contains("gopro met"), "gpmf")
        .when(t.contains("klv"), "klv")
        .when(t.contains("djmd") | t.contains("dji meta"), "dji")
        .when(t.contains("camm"), "camm")
        .when(t.contains("text") | t.contains("subt"), "srt")
    )


def clean_tag(c: C) -> Column:
    """F16: printable characters only."""
    return F.trim(F.regexp_replace(col(c), r"[^\x20-\x7E]", ""))


def fingerprint(c: C, digits: int = 16) -> Column:
    """first hex digits of the SHA-256 of a canonical text."""
    return F.substring(F.sha2(col(c), 256), 1, digits)


def unsigned_range(raw: C, bits: int, low: float, high: float) -> Column:
    """an unsigned fixed-point number mapped onto [low, high]."""
    return F.lit(low) + col(raw) * ((high - low) / (2**bits - 1))


def signed_range(raw: C, bits: int, limit: float) -> Column:
    """a two's complement number mapped onto +-limit; the most negative one is null."""
    v = F.when(col(raw) >= 2 ** (bits - 1), col(raw) - 2**bits).otherwise(col(raw))
    return F.when(v != -(2 ** (bits - 1)), v * (limit / (2 ** (bits - 1) - 1)))


def truthy(c: C, values: tuple[str, ...] = ("1", "true", "yes", "on", "recording", "start", "video")) -> Column:
    """Whether a text is one of the true values."""
    return F.coalesce(F.lower(F.trim(col(c).cast("string"))).isin(*values), F.lit(False))


# --- time (D) ---------------------------------------------------------------


def gps_time(week: C, ms: C, leap_s: int = 18) -> Column:
    """GPS week and milliseconds as a UTC timestamp."""
    seconds = F.lit(315964800) + col(week) * 604800 + col(ms) / 1000 - leap_s
    return F.timestamp_micros((seconds * 1000000).cast("long"))


def video_start(*tags: C) -> Column:
    """D3: the first tag that is a time after the year 2000."""
    times = [F.try_to_timestamp(col(t).cast("string")) for t in tags]
    return F.coalesce(*(F.when(F.year(t) > 2000, t) for t in times))


def frame_time(index: C, fps: C) -> Column:
    """Seconds of a frame."""
    return F.when(col(fps) > 0, col(index) / col(fps))


def zone_residual(diff_s: C, step_s: float = 900.0) -> Column:
    """A clock difference without the whole time-zone steps in it."""
    d = col(diff_s)
    return d - F.bround(d / step_s) * step_s


# --- geodesy and projection (M) -----------------------------------------------


def enu_wgs84(lat: C, lon: C, alt: C, lat0: C, lon0: C, alt0: C) -> list[Column]:
    """M1: east, north, up about an origin with the ellipsoid's radii there."""
    e2 = WGS84_F * (2 - WGS84_F)
    s = F.sin(F.radians(col(lat0)))
    w = 1 - e2 * s * s
    meridian, normal = WGS84_A * (1 - e2) / F.pow(w, 1.5), WGS84_A / F.sqrt(w)
    return [
        F.radians(col(lon) - col(lon0)) * (normal + col(alt0)) * F.cos(F.radians(col(lat0))),
        F.radians(col(lat) - col(lat0)) * (meridian + col(alt0)),
        col(alt) - col(alt0),
    ]


def geodetic_of_enu(east: C, north: C, lat0: C, lon0: C, alt0: C) -> list[Column]:
    """M2: latitude and longitude; inverse of ``enu_wgs84``."""
    e2 = WGS84_F * (2 - WGS84_F)
    s = F.sin(F.radians(col(lat0)))
    w = 1 - e2 * s * s
    meridian, normal = WGS84_A * (1 - e2) / F.pow(w, 1.5), WGS84_A / F.sqrt(w)
    return [
        col(lat0) + F.degrees(col(north) / (meridian + col(alt0))),
        col(lon0) + F.degrees(col(east) / ((normal + col(alt0)) * F.cos(F.radians(col(lat0))))),
    ]


def enu_sphere(lat: C, lon: C, lat0: C, lon0: C, radius: float = SPHERE_R) -> list[Column]:
    """M3, M4: equirectangular metres on a sphere about an origin."""
    return [F.radians(col(lon) - col(lon0)) * F.cos(F.radians(col(lat0))) * radius, F.radians(col(lat) - col(lat0)) * radius]


def plot_metres(lat: C, lon: C, lat0: C, lon0: C) -> list[Column]:
    """M5: metres for plots."""
    return [(col(lon) - col(lon0)) * PLOT_M_PER_DEG * F.cos(F.radians(col(lat0))), (col(lat) - col(lat0)) * PLOT_M_PER_DEG]


def haversine(lat1: C, lon1: C, lat2: C, lon2: C) -> Column:
    """M6: great-circle metres."""
    a, b = F.radians(col(lat1)), F.radians(col(lat2))
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(col(lon2) - col(lon1)) / 2), 2)
    return 2 * HAVERSINE_R * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def utm_epsg(lon: C, lat: C) -> Column:
    """M7: EPSG code of the UTM zone."""
    zone = (F.floor((col(lon) + 180) / 6) % 60 + 1).cast("int")
    return F.when(col(lat) >= 0, zone + 32600).otherwise(zone + 32700)


def utm(lon: C, lat: C) -> list[Column]:
    """M8: UTM easting and northing by the Krueger series to the sixth order in the third flattening."""
    n = WGS84_F / (2 - WGS84_F)
    radius = WGS84_A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240]
    e = (WGS84_F * (2 - WGS84_F)) ** 0.5
    zone = F.floor((col(lon) + 180) / 6) % 60 + 1
    lam = F.radians(col(lon) - (zone * 6 - 183))
    s = F.sin(F.radians(col(lat)))
    t = F.sinh(F.atanh(s) - e * F.atanh(e * s))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    east = eta + sum((a * F.cos(2 * (k + 1) * xi) * F.sinh(2 * (k + 1) * eta) for k, a in enumerate(alpha)), F.lit(0.0))
    north = xi + sum((a * F.sin(2 * (k + 1) * xi) * F.cosh(2 * (k + 1) * eta) for k, a in enumerate(alpha)), F.lit(0.0))
    k0 = 0.9996
    return [500000 + k0 * radius * east, k0 * radius * north + F.when(col(lat) < 0, 10000000.0).otherwise(0.0)]


def slippy_tile(lon: C, lat: C, zoom: int) -> list[Column]:
    """Tile x and y of a web map."""
    n = 2**zoom
    lat_r = F.radians(col(lat))
    return [
        F.floor((col(lon) + 180) / 360 * n).cast("int"),
        F.floor((1 - F.ln(F.tan(lat_r) + 1 / F.cos(lat_r)) / pi) / 2 * n).cast("int"),
    ]


def apply_similarity(xyz: list[C], scale: C, rotation: C, shift: C) -> list[Column]:
    """Scale * R x + t, with R as nine numbers by rows and t as three."""
    r, t = col(rotation), col(shift)
    return [col(scale) * sum((r[3 * i + j] * col(xyz[j]) for j in range(3)), F.lit(0.0)) + t[i] for i in range(3)]


def project(xyz: list[C], k: C, rotation: C, centre: list[C]) -> list[Column]:
    """Pixel u, v and depth of a point in a pinhole camera."""
    k, r = col(k), col(rotation)
    d = [col(p) - col(c) for p, c in zip(xyz, centre, strict=True)]
    cam = [sum((r[3 * i + j] * d[j] for j in range(3)), F.lit(0.0)) for i in range(3)]
    return [F.when(cam[2] != 0, k[0] * cam[0] / cam[2] + k[2]), F.when(cam[2] != 0, k[4] * cam[1] / cam[2] + k[5]), cam[2]]


def pixel_ray(u: C, v: C, k: C, rotation: C) -> list[Column]:
    """Unit ray of a pixel in the world."""
    k, r = col(k), col(rotation)
    d = [(col(u) - k[2]) / k[0], (col(v) - k[5]) / k[4], F.lit(1.0)]
    w = [sum((r[3 * j + i] * d[j] for j in range(3)), F.lit(0.0)) for i in range(3)]
    length = F.sqrt(sum((x * x for x in w), F.lit(0.0)))
    return [x / length for x in w]


def inside_image(u: C, v: C, depth: C, width: C, height: C) -> Column:
    """In front of the camera and within its image."""
    return (col(depth) > 0) & (col(u) >= 0) & (col(u) < col(width)) & (col(v) >= 0) & (col(v) < col(height))


def focal_px(hfov_deg: C, focal35_mm: C, width: C) -> Column:
    """Focal length in pixels from the field of view, else from the 35 mm equivalent."""
    return F.coalesce(F.when(col(hfov_deg) > 0, col(width) / (2 * F.tan(F.radians(col(hfov_deg)) / 2))), F.when(col(focal35_mm) > 0, col(focal35_mm) / 36 * col(width)))


def cell(c: C, origin: C | float, size: C | float) -> Column:
    """Index of the grid cell that holds a coordinate."""
    o = F.lit(origin) if isinstance(origin, int | float) else col(origin)
    s = F.lit(size) if isinstance(size, int | float) else col(size)
    return F.floor((col(c) - o) / s).cast("long")


def voxel_key(ijk: list[C], dims: list[C]) -> Column:
    """One number for a voxel, -1 outside the grid."""
    i, j, k = (col(c) for c in ijk)
    nx, ny, nz = (col(c) for c in dims)
    inside = (i >= 0) & (j >= 0) & (k >= 0) & (i < nx) & (j < ny) & (k < nz)
    return F.when(inside, (i * ny + j) * nz + k).otherwise(F.lit(-1)).cast("long")


def true_overlap(a: C, b: C, step_px: C, width: C) -> Column:
    """Overlap of two frames of a straight synthetic track."""
    return F.greatest(F.lit(0.0), 1 - F.abs(col(b) - col(a)) * col(step_px) / col(width))


def normalise_affine(m: C, w: C, h: C) -> Column:
    """A 2 x 3 affine with its shift in frame widths and heights."""
    a = col(m)
    return F.array(a[0], a[1], a[2] / col(w), a[3], a[4], a[5] / col(h))


# --- flags, bands, verdicts (P) ------------------------------------------------


def validity_flags(present: dict[str, Column], sticky: C | None = None) -> Column:
    """Bits of what is present, with the bits that stay from before."""
    out = F.lit(0).cast("long")
    for name, ok in present.items():
        out = out.bitwiseOR(F.when(ok, F.lit(FLAGS[name])).otherwise(F.lit(0)).cast("long"))
    keep = FLAGS["rtk"] | FLAGS["outlier"] | FLAGS["smoothed"]
    return out if sticky is None else out.bitwiseOR(F.coalesce(col(sticky), F.lit(0)).bitwiseAND(F.lit(keep)).cast("long"))


def repaired_focal(c: C, limit: float = 80.0) -> Column:
    """Focal lengths that some dialects give in tenths."""
    return F.when(col(c) > limit, col(c) / 10).otherwise(col(c))


def valid_fix(lat: C, lon: C) -> Column:
    """A fix that is there and isn't (0, 0)."""
    return col(lat).isNotNull() & col(lon).isNotNull() & ~((col(lat) == 0) & (col(lon) == 0))


def band(value: C, good: float, ok: float, higher_is_better: bool = True) -> Column:
    """PASS, WARN or BLOCK; INFO where there is no value."""
    v = col(value)
    at_least = (lambda x: v >= x) if higher_is_better else (lambda x: v <= x)
    return F.when(v.isNull(), "INFO").when(at_least(good), "PASS").when(at_least(ok), "WARN").otherwise("BLOCK")


def soft(status: C) -> Column:
    """A BLOCK counts as a WARN."""
    return F.when(col(status) == "BLOCK", "WARN").otherwise(col(status))


def band_status(value: C, lo: float, hi: float, slack: float) -> Column:
    """Pass within the band, warn within its slack."""
    v = col(value)
    return F.when(v.isNull(), "info").when(v.between(lo, hi), "pass").when(v.between(lo - slack, hi + slack), "warn").otherwise("fail")


def threshold_status(value: C, warn_above: float, fail_above: float) -> Column:
    """Status by two upper limits."""
    v = col(value)
    return F.when(v.isNull(), "info").when(v > fail_above, "fail").when(v > warn_above, "warn").otherwise("pass")


def lower_better(value: C, pass_at: float, warn_at: float) -> Column:
    """Status of a value that should be low."""
    v = col(value)
    return F.when(v.isNull(), "info").when(v <= pass_at, "pass").when(v <= warn_at, "warn").otherwise("fail")


def decide_datum(ground_alt: C, terrain: C, undulation: C, tolerance_m: float) -> Column:
    """Which height datum brings the ground nearer to the terrain, if that can be told."""
    g, t, n = col(ground_alt), col(terrain), col(undulation)
    geoid, ellipsoid = F.abs(g - t), F.abs(g - t - n)
    known = g.isNotNull() & t.isNotNull() & n.isNotNull()
    return (
        F.when(~known, F.lit(None).cast("string"))
        .when(F.abs(n) < 2 * tolerance_m, None)
        .when((geoid <= tolerance_m) & (geoid < ellipsoid), "orthometric")
        .when((ellipsoid <= tolerance_m) & (ellipsoid < geoid), "ellipsoidal")
    )


def zone_label(views: C, angle_deg: C, min_views: int = 4, min_angle: float = 5.0) -> Column:
    """Zone 1 is seen often and from wide angles, zone 2 is seen, zone 3 is not."""
    return F.when((col(views) >= min_views) & (col(angle_deg) >= min_angle), 1).when(col(views) >= 1, 2).otherwise(3)


def view_confidence(views: C, full_views: float) -> Column:
    """Share of the views that count as full, 0 to 1."""
    return F.least(F.greatest(col(views) / full_views, F.lit(0.0)), F.lit(1.0))


def huber_weight(residual: C, delta: float) -> Column:
    """Weight of a residual under Huber's loss."""
    r = F.abs(col(residual))
    return F.when(r <= delta, F.lit(1.0)).otherwise(F.lit(delta) / F.greatest(r, F.lit(1e-9)))


def keypoint_near_grid(x: C, y: C, block: int, px: int) -> Column:
    """Whether a keypoint lies on a block boundary."""
    near = lambda v: F.least(F.pmod(col(v), F.lit(block)), block - F.pmod(col(v), F.lit(block))) <= px
    return near(x) | near(y)


def candidate_score(sharpness: C, is_keyframe: C, gain: float = 1.15) -> Column:
    """Sharpness, a little more for keyframes."""
    return col(sharpness) * F.when(col(is_keyframe), gain).otherwise(1.0)


def hole_policy(area_m2: C, ground_like: C, neighbours_confident: C, max_fill_m2: float) -> Column:
    """What to do with a hole in the surface."""
    return (
        F.when(col(area_m2) > max_fill_m2, F.struct(F.lit("leave").alias("action"), F.lit("too large").alias("reason")))
        .when(~col(ground_like), F.struct(F.lit("leave").alias("action"), F.lit("not ground").alias("reason")))
        .when(~col(neighbours_confident), F.struct(F.lit("flag").alias("action"), F.lit("neighbours unsure").alias("reason")))
        .otherwise(F.struct(F.lit("fill").alias("action"), F.lit("small hole in sure ground").alias("reason")))
    )


def stride_frames(seconds: C, frames: C, fps: C) -> Column:
    """A stride in frames; the limit in seconds wins where the frame rate is known."""
    return F.when(col(fps) > 0, F.greatest(F.lit(1), F.bround(col(seconds) * col(fps)).cast("int"))).otherwise(col(frames))


def utc_time(c: C) -> Column:
    """A text as a UTC timestamp; null where it is none. A zone is taken off, no zone is UTC."""
    t = F.trim(col(c).cast("string"))
    return F.try_to_timestamp(F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), t))


def run_id(path: C, at: C) -> Column:
    """a run's name, the file's stem and its start."""
    name = F.regexp_extract(col(path), r"([^/\\]+)$", 1)
    return F.concat_ws("_", F.regexp_replace(name, r"(.)\.[^.]*$", "$1"), F.date_format(col(at), "yyyyMMdd_HHmmss"))


def shown_number(value: C, digits: int = 2, unit: str = "") -> Column:
    """a number with thousands apart, a dash where there is none."""
    return F.coalesce(F.concat(F.format_number(col(value), digits), F.lit(unit)), F.lit("—"))


def html_text(c: C) -> Column:
    """a text whose marks are no markup."""
    out = col(c)
    for mark, name in (("&", "amp"), ("<", "lt"), (">", "gt"), ('"', "quot"), ("'", "#x27")):
        out = F.replace(out, F.lit(mark), F.lit(f"&{name};"))
    return out


def budgeted_size(sizes: list[int], native: C, frames: C, seconds_at_1280: C, available: C) -> Column:
    """The first of falling ``sizes`` whose projected time is available, else the last that is under the native size.

    A frame smaller than the size is projected at its own; smaller sizes must be under both the first and the native.
    """
    cost = lambda s: col(frames) * col(seconds_at_1280) * F.pow(F.least(F.lit(s), col(native)) / 1280, 2)
    open_ = [F.lit(True), *(F.lit(s) < F.least(F.lit(sizes[0]), col(native)) for s in sizes[1:])]
    out = F.lit(sizes[0])
    for s, ok in list(zip(sizes, open_, strict=True))[1:]:
        out = F.when(ok, s).otherwise(out)
    for s, ok in list(zip(sizes, open_, strict=True))[::-1]:
        out = F.when(ok & (cost(s) <= col(available)), s).otherwise(out)
    return out


def chunk_frames(total_gb: C, knots: list[tuple[float, float]], headroom_gb: float = 4.0, requested: int | None = None, least: int = 8) -> Column:
    """The most frames whose peak memory, a rising piecewise linear curve (frames, GB), leaves the headroom free.

    Between two knots the largest whole number follows from the line; beyond the last the last line goes on.
    """
    budget = F.greatest(col(total_gb) - headroom_gb, F.lit(0.0))
    safe = F.lit(least)
    for (f0, g0), (f1, g1) in zip(knots, knots[1:], strict=False):
        within = F.floor(f0 + (budget - g0) * ((f1 - f0) / (g1 - g0)) + 1e-9)
        end = within if (f1, g1) == knots[-1] else F.least(within, F.lit(int(f1)))
        safe = F.when(budget >= g0, F.greatest(safe, end.cast("int"))).otherwise(safe)
    safe = F.when(budget <= knots[0][1], F.lit(least)).otherwise(safe)
    return F.greatest(F.least(safe, F.lit(requested)) if requested else safe, F.lit(least))


def tlog_frames(head: C) -> Column:
    """How many frames of a telemetry log follow each other in the first bytes, four at most: each eight bytes of
    time, a mark (254 or 253) and a length; two or more make a log."""
    digits = F.hex(col(head))
    size = F.length(digits) / 2
    byte = lambda k: F.conv(F.substring(digits, 2 * k + 1, F.lit(2)), 16, 10).cast("int")

    def step(s: Column, _: Column) -> Column:
        at = s["at"]
        mark, more = byte(at + 8), F.when(byte(at + 10).bitwiseAND(1) == 1, 13).otherwise(0)
        length = F.when(mark == 0xFE, byte(at + 9) + 8).when(mark == 0xFD, byte(at + 9) + 12 + more)
        ok = (at >= 0) & (at + 10 < size) & length.isNotNull()
        broken = (at >= 0) & (at + 10 < size) & length.isNull()
        return F.struct(F.when(ok, at + 8 + length).otherwise(-1).cast("int").alias("at"), F.when(broken, -100).otherwise(s["n"] + ok.cast("int")).cast("int").alias("n"))

    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("n"))
    return F.greatest(F.aggregate(F.sequence(F.lit(1), F.lit(4)), start, step)["n"], F.lit(0))


def refinement_kept(gps_before: C, gps_after: C, reproj_before: C, reproj_after: C, frames_before: C, frames_after: C, tolerance: float = 0.1) -> Column:
    """Whether a refined model replaces the one before: nearer to the fixes, hardly worse in its images, no frame lost."""
    nearer = col(gps_after) < col(gps_before)
    sharp = col(reproj_after) <= col(reproj_before) * (1 + tolerance)
    return F.coalesce(nearer & sharp & (col(frames_after) >= col(frames_before)), F.lit(False))
