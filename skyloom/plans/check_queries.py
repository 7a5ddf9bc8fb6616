"""Queries of input checks, summaries and image statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.functions import scalar as S
from skyloom.operators import checks, images, raster
from skyloom.plans.catalog import register
from skyloom.plans.tables import FRAMES_SQL, POINTS_SQL, SMALL_CLOUD_SQL, TELEMETRY_SQL, frames, points, rounded, small_cloud, table, telemetry

T, FR, P, E = TELEMETRY_SQL, FRAMES_SQL, POINTS_SQL, SMALL_CLOUD_SQL


@register("video_checks", """with v as (select p_partkey as video, p_size * 100 as w, p_size * 60 as h, p_size * 1.0e0 as fps, p_retailprice / 50 as dur, p_retailprice * 40000 as br from part),
    c as (select video, 'resolution' as key, w * h * 1.0e0 as value, case when w * h >= 2073600 then 'PASS' when w * h >= 921600 then 'WARN' else 'BLOCK' end as status from v
      union all select video, 'fps', fps, case when fps >= 24 then 'PASS' else 'WARN' end from v
      union all select video, 'duration', dur, case when dur >= 20 then 'PASS' when dur >= 5 then 'WARN' else 'BLOCK' end from v
      union all select video, 'bits_per_pixel', br / (w * h * fps), case when br / (w * h * fps) >= 0.05 then 'PASS' else 'WARN' end from v)
    select video, key, status, round(value, 6) as value from c""")
def video_checks(spark, sf_dir):
    """Resolution, frame rate, duration and bits for each pixel."""
    v = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("video"), (F.col("p_size") * 100).alias("w"), (F.col("p_size") * 60).alias("h"), F.col("p_size").cast("double").alias("fps"), (F.col("p_retailprice") / 50).alias("dur"), (F.col("p_retailprice") * 40000).alias("br"))
    return rounded(checks.check_rows(v, ["video"], checks.video_checks("w", "h", "fps", "dur", "br")).select("video", "key", "status", "value"))


@register("format_checks", """with c as (select p_partkey as video, unnest(['projection', 'scan', 'hdr', 'rotation', 'frame_rate', 'decode']) as key,
      unnest([case when p_size = 7 then 'BLOCK' else 'PASS' end, case when p_size % 5 = 0 then 'WARN' else 'PASS' end, case when p_size % 9 = 0 then 'WARN' else 'PASS' end,
        case when (p_size % 4) * 90 <> 0 then 'WARN' else 'PASS' end, case when abs(p_retailprice / 30 - p_size) / p_size > 0.02 then 'WARN' else 'PASS' end,
        case when p_size < 2 or p_size / 50e0 < 0.5 then 'BLOCK' when p_size / 50e0 < 0.9 or p_size % 10 = 3 then 'WARN' else 'PASS' end]) as status from part)
    select video, key, status from c""")
def format_checks(spark, sf_dir):
    """Format and decode checks."""
    s = F.col("p_size")
    v = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("video"), F.when(s == 7, "sphere").otherwise("flat").alias("pr"), (s % 5 == 0).alias("il"), (s % 9 == 0).alias("hdr"), (s % 4 * 90).alias("rot"),
        (F.col("p_retailprice") / 30).alias("rf"), s.cast("double").alias("fps"), s.alias("n"), (s / 50.0).alias("reach"), (s % 10 == 3).cast("int").alias("err"),
    )
    rows = checks.check_rows(v, ["video"], [*checks.format_checks("pr", "il", "hdr", "rot", "rf", "fps"), checks.decode_check("n", "reach", "err")])
    return rows.select("video", "key", "status")


@register("placeholder_columns", f"""with s as (select channel, count(*) as n, min(value) as a, max(value) as b from {T} group by channel)
    select channel, 'value' as "column", n > 20 and a = b as placeholder, n > 20 and a = b and a = 0 as zeros from s union all select channel, 'fixed', n > 20, n > 20 from s""")
def placeholder_columns(spark, sf_dir):
    """Columns that only hold a placeholder."""
    return checks.placeholder_columns(telemetry(spark, sf_dir).withColumn("fixed", F.lit(0.0)), ["channel"], ["value", "fixed"])


@register("camera_pitch", f"""with p as (select track, median(case when lat / 40 between 1e-12 and 1 and track % 3 = 0 then -degrees(asin(lat / 40)) end) as a, median(case when track % 3 = 1 then yaw - 180 end) as b, median(value - 300) as c from {T} group by track)
    select track, round(coalesce(a, b, c), 6) as pitch, case when a is not null then 'slant_range' when b is not null then 'sensor' when c is not null then 'gimbal' end as pitch_source from p""")
def camera_pitch(spark, sf_dir):
    """Camera pitch by precedence of its sources."""
    k = F.col("track") % 3
    rows = telemetry(spark, sf_dir).select("track", F.when(k == 0, 40.0).alias("slant"), "lat", F.when(k == 1, F.col("yaw") - 180).alias("el"), (F.col("value") - 300).alias("g"))
    return rounded(checks.camera_pitch(rows, ["track"], "slant", "lat", "el", "g"))


@register("feasibility", f"""select track, round(greatest(max(lat) - min(lat), max(lon) - min(lon)), 6) as extent, round(median(value), 6) as height, round(median(value / nullif(yaw, 0)), 6) as gsd from {T} group by track""")
def feasibility(spark, sf_dir):
    """Extent, height and ground sample distance."""
    return rounded(checks.feasibility(telemetry(spark, sf_dir), ["track"], "lat", "lon", "value", "yaw"))


@register("mesh_outliers", f"""with b as (select min(x) as a, max(x) as b from {P} where class = 'A') select source, count(*) as n, 0::bigint as lost, count(*) filter (z < a - 0.1e0 * (b - a) or z > b + 0.1e0 * (b - a)) as far from {P}, b group by source""")
def mesh_outliers(spark, sf_dir):
    """Vertices beyond a box."""
    p = points(spark, sf_dir)
    box = p.where("class = 'A'").agg(F.min("x").alias("min_z"), F.max("x").alias("max_z"))
    return checks.mesh_is_broken(p.select("source", "z"), ["source"], box, ["z"], 0.1)


@register("verdict_summary", f"""select priority, count(*) as n, count(*) filter (status = 'F') as "n_F", count(*) filter (status = 'O') as "n_O", round(median(overlap), 6) as median, round(min(overlap), 6) as least, round(max(overlap), 6) as most from {FR} group by priority""")
def verdict_summary(spark, sf_dir):
    """Verdict summary."""
    return rounded(checks.verdict_summary(frames(spark, sf_dir), ["priority"], "status", "overlap", ["F", "O"]))


@register("map_totals", f"""select channel, unnest(['value', 'yaw']) as name, round(unnest([sum(value), sum(yaw)]), 4) as total from {T} group by channel""")
def map_totals(spark, sf_dir):
    """Totals by class of a map column."""
    rows = telemetry(spark, sf_dir).select("channel", F.create_map(F.lit("value"), F.col("value"), F.lit("yaw"), F.col("yaw")).alias("m"))
    return rounded(checks.map_totals(rows, ["channel"], "m"), 4)


@register("fill_summary", f"""select priority, count(*) filter (status = 'F') as used, count(*) filter (status <> 'F') as dropped, list_sort(list(distinct status) filter (status <> 'F')) as reasons, round(median(case when status = 'F' then overlap end), 6) as median from {FR} group by priority""")
def fill_summary(spark, sf_dir):
    """Fill summary with its reasons."""
    rows = frames(spark, sf_dir).withColumn("s", F.when(F.col("status") == "F", "used").otherwise("dropped"))
    return rounded(checks.fill_summary(rows, ["priority"], "s", "status", "overlap"))


@register("home_record", f"""select track, round(median(case when value <> 0 then value end), 6) as value, round(median(case when yaw <> 0 then yaw end), 6) as yaw from {T} group by track""")
def home_record(spark, sf_dir):
    """Medians of values that aren't zero."""
    return rounded(checks.nonzero_median(telemetry(spark, sf_dir), ["track"], ["value", "yaw"]))


@register("control_rms", f"""select case when class = 'A' then 'check' else 'control' end as kind, count(*) as n, round(sqrt(avg((z - 35) * (z - 35))), 6) as rms from {P} group by 1""")
def control_rms(spark, sf_dir):
    """RMS of control and check points."""
    rows = points(spark, sf_dir).withColumn("e", F.col("z") - 35)
    return rounded(checks.rms_by_kind(rows, F.when(F.col("class") == "A", "check").otherwise("control"), "e"))


@register("quantile_fit", f"""with q as (select channel, unnest(range(1, 20)) / 20.0e0 as s from (select distinct channel from {T})), v as (select channel, list(value) as v, list(yaw) as y from {T} group by channel),
    p as (select q.channel, s, quantile_cont(t.value, 0.5) as dummy from q join {T} t on t.channel = q.channel group by 1, 2),
    a as (select channel, quantile_cont(value, [0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95]) as a, quantile_cont(yaw, [0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.45, 0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95]) as b from {T} group by channel),
    u as (select channel, unnest(a) as x, unnest(b) as y from a) select channel, round(regr_slope(y, x), 6) as gain, round(regr_intercept(y, x), 5) as bias from u group by channel""")
def quantile_fit(spark, sf_dir):
    """Gain and bias between quantiles."""
    found = checks.quantile_fit(telemetry(spark, sf_dir), ["channel"], "value", "yaw")
    return found.select("channel", F.round("gain", 6).alias("gain"), F.round("bias", 5).alias("bias"))


def _trimmed_sql(rounds: int = 3) -> str:
    fit = lambda rows: f"select class, regr_slope(z, x) as gain, regr_intercept(z, x) as bias, count(*) as n from {rows} group by class"
    parts = [f"f0 as ({fit(P)})"]
    for k in range(rounds):
        parts.append(f"r{k} as (select p.class, x, z, abs(z - gain * x - bias) as r from {P} p join f{k} using (class))")
        parts.append(f"c{k} as (select class, quantile_cont(r, 0.9) as cut from r{k} group by class)")
        parts.append(f"k{k} as (select r{k}.* from r{k} join c{k} using (class) where r <= cut)")
        parts.append(f"f{k + 1} as ({fit(f'k{k}')})")
    return f"with {', '.join(parts)} select class, round(gain, 5) as gain, round(bias, 5) as bias, n from f{rounds}"


@register("trimmed_fit", _trimmed_sql())
def trimmed_fit(spark, sf_dir):
    """Line refitted without the largest residuals."""
    return rounded(checks.trimmed_fit(points(spark, sf_dir), ["class"], "x", "z"), 5)


@register("selected_flag", f"""select frame, status = 'F' and overlap > 0.5 as selected from {FR}""")
def selected_flag(spark, sf_dir):
    """Frames with a flag for the selected ones."""
    f = frames(spark, sf_dir)
    return checks.selected_flag(f.select("frame"), f.where("status = 'F' and overlap > 0.5"), "frame").select("frame", "selected")


@register("even_samples", f"""with r as (select video, frame, row_number() over (partition by video order by frame) - 1 as p, count(*) over (partition by video) as n from {FR}) select video, frame from r where p % greatest(1, n // 3) = 0""")
def even_samples(spark, sf_dir):
    """Evenly spaced frames of each series."""
    return checks.evenly_sampled(frames(spark, sf_dir).select("video", "frame"), ["video"], "frame", 3)


@register("longest_strip", f"""select priority, arg_max(frame, sharpness) as frame, max(sharpness) as sharpness from {FR} group by priority""")
def longest_strip(spark, sf_dir):
    """The largest of each group, the first of equals."""
    return checks.best_per(frames(spark, sf_dir).select("priority", "frame", "sharpness"), ["priority"], "sharpness", "frame")


@register("centre_deviation", f"""with a as (select point_id, x, y, z from {E} where point_id % 3 <> 0), b as (select point_id, x * 1.01 as x, y, z + 0.1 as z from {E} where point_id % 2 = 0), d as (select sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2)) as d from a join b using (point_id))
    select count(*) as shared, round(sqrt(avg(d * d)), 6) as rms, round(max(d), 6) as worst from d""")
def centre_deviation(spark, sf_dir):
    """Errors of centres by shared names."""
    c = small_cloud(spark, sf_dir)
    other = c.where("point_id % 2 = 0").select("point_id", (F.col("x") * 1.01).alias("x"), "y", (F.col("z") + 0.1).alias("z"))
    return rounded(checks.centre_deviation(c.where("point_id % 3 <> 0"), other, "point_id", ["x", "y", "z"]))


@register("grid_around", f"""select round(floor(min(x) / 0.5) * 0.5 - 0.5, 6) as x0, round(ceil(max(y) / 0.5) * 0.5 + 0.5, 6) as y1, cast(ceil(max(x) / 0.5) - floor(min(x) / 0.5) + 2 as bigint) as width, cast(ceil(max(y) / 0.5) - floor(min(y) / 0.5) + 2 as bigint) as height from {E}""")
def grid_around(spark, sf_dir):
    """A grid around all points."""
    return rounded(checks.grid_around(small_cloud(spark, sf_dir), "x", "y", 0.5))


@register("filled_zones", f"""with c as (select distinct cast(floor(y) as bigint) as row, cast(floor(x) as bigint) as col from {P}), f as (select distinct cast(floor(y) as bigint) as row, cast(floor(x) as bigint) as col from {P} where class = 'A' and weight > 0.07)
    select c.row, c.col, case when (c.row + c.col) % 3 + 1 = 3 and f.row is not null then 2 else (c.row + c.col) % 3 + 1 end as zone from c left join f on c.row = f.row and c.col = f.col""")
def filled_zones(spark, sf_dir):
    """Zone 3 becomes 2 where fill falls."""
    cell = lambda df: df.select(F.floor("y").cast("long").alias("row"), F.floor("x").cast("long").alias("col"))
    p = points(spark, sf_dir)
    cells = cell(p).distinct().withColumn("zone", (F.col("row") + F.col("col")) % 3 + 1)
    return checks.mark_filled(cells, cell(p.where("class = 'A' and weight > 0.07")), "zone")


@register("reference_surfaces", f"""select cast(floor(y / 2) as bigint) as row, cast(floor(x / 2) as bigint) as col, max(z) as dsm, min(case when view % 20 = 2 then z end) as dtm from {P} where view % 20 not in (7, 18) group by 1, 2""")
def reference_surfaces(spark, sf_dir):
    """Highest points and lowest ground points of cells."""
    return checks.reference_cells(points(spark, sf_dir).withColumn("kind", F.col("view") % 20), "x", "y", "z", "kind", 2.0)


@register("depth_agreement", f"""with d as (select view, cast(floor(x / 5) as bigint) as u, cast(floor(y) as bigint) as v, avg(z) as z from {P} group by 1, 2, 3), s as (select unnest([-2, -1, 1, 2]) as k)
    select a.view, a.u, a.v, count(*) filter (abs(b.z - a.z) <= 0.1e0 * a.z) as agree from d a cross join s join d b on b.u = a.u and b.v = a.v and b.view = a.view + s.k group by 1, 2, 3 having count(*) filter (abs(b.z - a.z) <= 0.1e0 * a.z) >= 1""")
def depth_agreement(spark, sf_dir):
    """Depths that agree with those of neighbouring cameras."""
    d = points(spark, sf_dir).groupBy("view", F.floor(F.col("x") / 5).cast("long").alias("u"), F.floor("y").cast("long").alias("v")).agg(F.avg("z").alias("z"))
    return checks.depth_agreement(d.withColumn("rank", F.col("view")), "view", "rank", ["u", "v"], "z", 2, 0.1, 1)


@register("nearest_colour", """select p_partkey, arg_min(n, d * 10 + k) as name from (select p_partkey, n, k, pow(p_size * 5 - r, 2) + pow(p_size * 3 - g, 2) + pow(p_retailprice % 255 - b, 2) as d from part cross join (values ('zone1', 0, 0, 200, 0), ('zone2', 1, 255, 160, 0), ('zone3', 2, 220, 0, 0)) c(n, k, r, g, b)) group by p_partkey""")
def nearest_colour(spark, sf_dir):
    """Nearest colour of a palette."""
    rows = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") * 5).alias("r"), (F.col("p_size") * 3).alias("g"), (F.col("p_retailprice") % 255).alias("b"))
    return checks.nearest_colour(rows, "p_partkey", ["r", "g", "b"], {"zone1": (0, 200, 0), "zone2": (255, 160, 0), "zone3": (220, 0, 0)})


def _noisy_sql(c: str, k: int) -> str:
    unit = lambda salt: f"(cast('0x' || substr(md5(event_id || '|0|{salt}'), 1, 10) as bigint) + 0.5e0) / 1099511627776e0"
    jump = f"case when {unit('out')} < 0.01 then case when {unit(f'{k}s')} < 0.5 then -0.001e0 else 0.001e0 end else 0 end"
    return f"round({c} + 0.00001e0 * sqrt(-2 * ln({unit(f'{k}a')})) * cos(2 * 3.141592653589793e0 * {unit(f'{k}b')}) + {jump}, 9) as {c}"


@register("noisy_track", f"select event_id, {_noisy_sql('lat', 0)}, {_noisy_sql('lon', 1)} from {T}")
def noisy_track(spark, sf_dir):
    """Fixes with noise that follows from their ids."""
    return rounded(checks.noisy_fixes(telemetry(spark, sf_dir).select("event_id", "lat", "lon"), "event_id", ["lat", "lon"], 1e-5, 0.01, 1e-3), 9)


@register("image_sharpness", """with p as (select vec_id, unnest(embedding)::double * 255 as v, unnest(range(64)) as i from embeddings where len(embedding) = 64), g as (select vec_id, i // 8 as r, i % 8 as c, v from p),
    l as (select a.vec_id, sum(case when b.r = a.r and b.c = a.c then -4 * b.v else b.v end) as l from g a join g b on b.vec_id = a.vec_id and abs(a.r - b.r) + abs(a.c - b.c) <= 1 where a.r between 1 and 6 and a.c between 1 and 6 group by a.vec_id, a.r, a.c),
    t as (select a.vec_id, var_pop(b.v) as t from g a join g b on b.vec_id = a.vec_id and abs(a.r - b.r) <= 1 and abs(a.c - b.c) <= 1 where a.r between 1 and 6 and a.c between 1 and 6 group by a.vec_id, a.r, a.c),
    s as (select vec_id, var_pop(l) as sharpness from l group by vec_id), x as (select vec_id, avg(t) as texture from t group by vec_id)
    select vec_id, round(sharpness, 4) as sharpness, round(texture, 4) as texture from s join x using (vec_id)""")
def image_sharpness(spark, sf_dir):
    """Variance of the Laplacian and local variance of small images."""
    rows = table(spark, sf_dir, "embeddings").where(F.size("embedding") == 64).select("vec_id", F.transform("embedding", lambda v: v.cast("double") * 255).alias("p"), F.lit(8).alias("w"))
    return rounded(rows.select("vec_id", images.variance_of_laplacian("p", "w").alias("sharpness"), images.texture_variance("p", "w").alias("texture")), 4)


@register("image_statistics")
def image_statistics(spark, sf_dir):
    """Sharpness, blockiness, anisotropy and texture of small images."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda v: v.cast("double") * 255).alias("p"), F.lit(8).alias("w"))
    return rounded(rows.select("vec_id", images.variance_of_laplacian("p", "w").alias("sharpness"), images.anisotropy("p", "w").alias("anisotropy"), images.texture_variance("p", "w").alias("texture")), 5)


@register("saturation", """select vec_id, round(len(list_filter(embedding, lambda v: cast(v as double) >= 0.1)) / 64.0e0, 6) as share from embeddings""")
def saturation(spark, sf_dir):
    """Share of bright pixels."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("p"))
    return rounded(rows.select("vec_id", images.saturated_share(F.col("p"), 0.1).alias("share")))


@register("cropped_surface", f"""with g as (select cast(floor(y) as bigint) as row, cast(floor(x) as bigint) as col, count(*) as n from {P} group by 1, 2), v as (select row, col, case when row > 2 and col > 5 then n end as n from g), b as (select min(row) as r0, min(col) as c0, max(row) as r1, max(col) as c1 from v where n is not null)
    select row - r0 as row, col - c0 as col, n from v, b where row between r0 and r1 and col between c0 and c1""")
def cropped_surface(spark, sf_dir):
    """A surface cropped to what it holds."""
    g = raster.rasterise(points(spark, sf_dir), "x", "y", 1.0, [F.count("*").alias("n")])
    return checks.cropped(g.withColumn("n", F.when((F.col("row") > 2) & (F.col("col") > 5), F.col("n"))), "n")


@register("hash_sample", f"""select event_id, channel from {T} order by md5(event_id || '|7'), event_id limit 500""")
def hash_sample(spark, sf_dir):
    """A sample of fixed size that is the same each time."""
    from skyloom.operators.windows import sample_by_hash

    return sample_by_hash(telemetry(spark, sf_dir).select("event_id", "channel"), "event_id", 500, 7)


@register("sidecars", f"""select '/d/Clip' || event_id || '.MP4' as video, case when event_id % 4 = 0 then '/d/clip' || event_id || '.SRT' when event_id % 4 = 1 then '/d/CLIP' || event_id || '.klv' when event_id % 4 = 2 then '/d/clip' || event_id || '.csv' end as sidecar from {T}""")
def sidecars(spark, sf_dir):
    """The telemetry file beside each video of a listing."""
    i = F.col("event_id").cast("string")
    k = F.col("event_id") % 4
    names = F.array(F.concat(F.lit("/d/Clip"), i, F.lit(".MP4")), F.when(k == 0, F.concat(F.lit("/d/clip"), i, F.lit(".SRT"))), F.when(k == 1, F.concat(F.lit("/d/CLIP"), i, F.lit(".klv"))), F.when(k == 2, F.concat(F.lit("/d/clip"), i, F.lit(".csv"))), F.when(k < 2, F.concat(F.lit("/d/clip"), i, F.lit(".txt"))))
    files = telemetry(spark, sf_dir).select(F.explode(F.array_compact(names)).alias("path"))
    return checks.sidecars(files, "path", (".mp4", ".mov"), (".klv", ".srt", ".csv", ".txt"))


@register("allotments", f"""with s as (select video, frame, sharpness as w, status = 'F' as done from {FR}) select video, frame, round(case when not done then w / nullif(sum(w) filter (not done) over (partition by video), 0) * 600 end, 6) as allotment from s""")
def allotments(spark, sf_dir):
    """Seconds of each open stage of a run."""
    rows = frames(spark, sf_dir).select("video", "frame", "sharpness", (F.col("status") == "F").alias("done"), F.lit(600.0).alias("left"))
    return rounded(checks.allotments(rows, "video", "sharpness", "done", "left").select("video", "frame", "allotment"))


@register("tlog_heads", f"""select event_id, case event_id % 4 when 0 then 4 when 1 then 3 when 2 then 1 else 0 end as frames from {T}""")
def tlog_heads(spark, sf_dir):
    """Frames that follow each other at the start of a telemetry log."""
    k = F.col("event_id") % 4
    one = F.concat(F.lit("0000000000000001fe03"), F.repeat(F.lit("00"), F.lit(9)))  # 3 bytes and 6 of frame
    two = F.concat(F.lit("0000000000000001fd0401"), F.repeat(F.lit("00"), F.lit(26)))  # signed
    head = F.when(k == 0, F.concat(one, two, one, two, one)).when(k == 1, F.concat(one, two, two)).when(k == 2, one).otherwise(F.concat(one, F.repeat(F.lit("aa"), F.lit(40))))
    return telemetry(spark, sf_dir).select("event_id", S.tlog_frames(F.unhex(head)).cast("long").alias("frames"))
