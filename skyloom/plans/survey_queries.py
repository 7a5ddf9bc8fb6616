"""Queries of placing models, of exports and of footage."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.operators import cloud, exports, footage, georef, stats, windows
from skyloom.plans.catalog import register
from skyloom.plans.tables import FRAMES_SQL, POINTS_SQL, TELEMETRY_SQL, frames, halves_up, points, rounded, spread, spread_sql, table, telemetry
from skyloom.plans.track_queries import UTM_SQL

T, P, R = TELEMETRY_SQL, POINTS_SQL, FRAMES_SQL
XYZ = ["x", "y", "z"]
_OUT = "(point_id % 10 = 3)"  # rows that are moved away from where the similarity takes them


@register("ground_normal", f"""select class, round(-0.1e0 / sqrt(1.05e0), 5) as normal_0, round(0.2e0 / sqrt(1.05e0), 5) as normal_1, round(1 / sqrt(1.05e0), 5) as normal_2 from {P} group by class""")
def ground_normal(spark, sf_dir):
    """Normal of the plane z = 0.1 x - 0.2 y, towards cameras above."""
    p = points(spark, sf_dir).withColumn("z", 0.1 * F.col("x") - 0.2 * F.col("y"))
    found = georef.ground_normal(p, p.withColumn("z", F.lit(500.0)), ["class"], XYZ)
    return spread(found, {"normal": 3}, 5)


def _world(p):
    away = F.when(F.expr(_OUT), F.lit(300.0)).otherwise(F.lit(0.0))
    return p.withColumns({"u": 2 * F.col("y") + 1 + away, "v": -2 * F.col("x") + 5, "w": 2 * F.col("z") - 3})


@register("robust_similarity", f"""select class, 2.0e0 as scale, {spread_sql("rotation", [0, 1, 0, -1, 0, 0, 0, 0, 1])}, {spread_sql("shift", [1, 5, -3])}, count(*) as cameras, count(*) filter (not {_OUT}) as inliers,
      round(300 * sqrt(avg(case when {_OUT} then 1.0e0 else 0 end)), 4) as rms_all, 0.0e0 as rms_inliers from {P} group by class""")
def robust_similarity(spark, sf_dir):
    """Similarity that a tenth of wild pairs does not move, with ground pairs in every fit."""
    p = _world(points(spark, sf_dir))
    extra = p.where(f"not {_OUT} and point_id % 50 = 1").select("class", *XYZ, "u", "v", "w", F.lit(2.0).alias("weight"))
    found = georef.robust_similarity(p, ["class"], "point_id", XYZ, ["u", "v", "w"], threshold=1.0, extra=extra)
    return rounded(spread(found, {"rotation": 9, "shift": 3}), 4)


@register("posed_cameras", f"""select s_suppkey as cam, round(2.0e0 * (s_suppkey % 11) + 1, 6) as cx, round(-2.0e0 * (s_suppkey % 50) + 5, 6) as cy, round(2.0e0 * (s_suppkey % 3) - 3, 6) as cz, {spread_sql("rot", [0, -1, 0, 1, 0, 0, 0, 0, 1])} from supplier""")
def posed_cameras(spark, sf_dir):
    """Cameras in the local frame."""
    k = F.col("s_suppkey")
    eye = F.array(*(F.lit(1.0 if i % 4 == 0 else 0.0) for i in range(9)))
    cams = table(spark, sf_dir, "supplier").select(F.lit(1).alias("model"), k.alias("cam"), (k % 50).cast("double").alias("cx"), (k % 11).cast("double").alias("cy"), (k % 3).cast("double").alias("cz"), eye.alias("rot"))
    numbers = lambda *x: F.array(*map(F.lit, x))
    fit = cams.select("model").distinct().select("model", F.lit(2.0).alias("scale"), numbers(0.0, 1.0, 0.0, -1.0, 0.0, 0.0, 0.0, 0.0, 1.0).alias("rotation"), numbers(1.0, 5.0, -3.0).alias("shift"))
    return rounded(spread(georef.posed_cameras(cams, fit, ["model"], ["cx", "cy", "cz"], "rot").drop("model"), {"rot": 9}))


@register("merged_pieces", f"""with n as (select class, count(*) as n from {P} where weight < 0.05 or class <> 'N' group by class having count(*) >= 10),
    m as (select voxel, x, y, z, p.class, n, row_number() over (partition by voxel order by n desc, p.class) as k from (select class, voxel, min(x) as x, min(y) as y, min(z) as z from {P} group by class, voxel) p
      join (select class, count(*) as n from (select distinct class, voxel from {P}) group by class having count(*) >= 10) n on n.class = p.class)
    select voxel, class, round(voxel % 50 + 0.0e0, 4) as u, round(voxel % 37 + 0.0e0, 4) as v, round(voxel % 11 + 0.0e0, 4) as w from m where k = 1""")
def merged_pieces(spark, sf_dir):
    """Frames of three pieces, each in a frame of its own, placed by GPS."""
    gps = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("voxel"), *((F.col("p_partkey") % m).cast("double").alias(c) for c, m in (("u", 50), ("v", 37), ("w", 11))))
    held = points(spark, sf_dir).select("class", "voxel").distinct().join(gps, "voxel")
    size = F.when(F.col("class") == "A", 0.5).when(F.col("class") == "N", 4.0).otherwise(1.5)
    pieces = held.select("class", "voxel", (size * F.col("v") + 7).alias("x"), (-size * F.col("u")).alias("y"), (size * F.col("w") - 2).alias("z"))
    return rounded(georef.merged_pieces(pieces, gps, "class", "voxel", XYZ, ["u", "v", "w"], 10, 0.5), 4)


@register("control_on_map", f"""select event_id, round(e, 3) as e, round(n, 3) as n, round(value - 30 - event_id % 7, 6) as h, cast(32601 + floor((lon + 180) / 6) as int) as epsg from {UTM_SQL}""")
def control_on_map(spark, sf_dir):
    """Control points in map metres with orthometric heights."""
    rows = telemetry(spark, sf_dir).withColumn("und", (30 + F.col("event_id") % 7).cast("double"))
    made = georef.control_on_map(rows, "lon", "lat", "value", "und")
    return made.select("event_id", F.round("e", 3).alias("e"), F.round("n", 3).alias("n"), F.round("h", 6).alias("h"), "epsg")


@register("placement_report", f"""select channel, count(*) as n, round(sqrt(avg(r * r)), 6) as rms, round(median(r), 6) as median, case when sqrt(avg(r * r)) <= 100 then 'pass' when sqrt(avg(r * r)) <= 160 then 'warn' else 'fail' end as status
    from (select channel, abs(value - 200) as r from {T}) group by channel""")
def placement_report(spark, sf_dir):
    """How well a placement fits, with its status."""
    return rounded(georef.residual_bands(telemetry(spark, sf_dir).select("channel", F.abs(F.col("value") - 200).alias("r")), ["channel"], "r", 100.0, 160.0))


@register("auto_resolution", f"""select class, count(*) as n, count(distinct (floor(x), floor(y))) as occupied, median(view) as views,
      round(greatest(0.05, round_even(sqrt(count(distinct (floor(x), floor(y))) / greatest(count(*) / greatest(median(view), 1), 1)) / 0.05, 0) * 0.05), 6) as resolution from {P} group by class""")
def auto_resolution(spark, sf_dir):
    """Raster cell of each class."""
    return rounded(exports.auto_resolution(points(spark, sf_dir), ["class"], "x", "y", "view"))


@register("texel_size", f"""with a as (select class, (z + 1) * (y + 1) / 2 as ground, 64e0 * 32 * weight * (0.1 + weight) / 2 as texels from {P})
    select class, count(*) filter (ground > 0 and texels > 0) as faces, round(sqrt(median(ground / texels) filter (ground > 0 and texels > 0)), 6) as texel_m from a group by class""")
def texel_size(spark, sf_dir):
    """Metres of a texel over triangles made of each point."""
    p = points(spark, sf_dir)
    rows = p.select("class", F.lit(0.0).alias("o"), (F.col("z") + 1).alias("a"), (F.col("y") + 1).alias("b"), F.col("weight").alias("u"), (0.1 + F.col("weight")).alias("v"))
    return rounded(exports.texel_size(rows, ["class"], [("o", "o"), ("a", "o"), ("o", "b")], [("o", "o"), ("u", "o"), ("o", "v")], 64, 32))


@register("lite_mesh", f"""select class, round(x, 0) as x, round(y, 0) as y, round(z, 0) as z, count(*) as merged, round(avg(weight), 6) as weight, round(coalesce(avg(case when view % 3 > 0 then view % 7 end), -1), 6) as confidence, max(case when source = 'F' then 2 else 3 end) as zone from {P} group by all""")
def lite_mesh(spark, sf_dir):
    """Vertices welded by rounded places, the least trusted zone kept; weights count to six decimals, so that no order of rows shows."""
    p = points(spark, sf_dir).select("class", *XYZ, F.col("weight").cast("decimal(12,6)"), F.when(F.col("view") % 3 > 0, (F.col("view") % 7).cast("double")).otherwise(-1.0).alias("confidence"), F.when(F.col("source") == "F", 2).otherwise(3).alias("zone"))
    made = exports.welded(p, ["class"], XYZ, ["weight"], "confidence", "zone", 0)
    return made.withColumns({c: halves_up(F.col(c), 6) for c in ("weight", "confidence")})


@register("lite_faces", f"""select point_id from {P} where voxel % 10 <> view % 10 and view % 10 <> point_id % 10 and voxel % 10 <> point_id % 10""")
def lite_faces(spark, sf_dir):
    """Faces that are still triangles after welding."""
    rows = points(spark, sf_dir).select("point_id", *((F.col(c) % 10).alias(n) for c, n in (("voxel", "a"), ("view", "b"), ("point_id", "c"))))
    return exports.welded_faces(rows, ["a", "b", "c"]).select("point_id")


@register("fill_in_zone1", f"""select count(*) filter (voxel in (select voxel from {P} where class = 'A' and weight > 0.07)) as inside, count(*) as filled from {P} where class = 'R'""")
def fill_in_zone1(spark, sf_dir):
    """Filled points that lie in a sure voxel."""
    p = points(spark, sf_dir)
    zones = p.select("voxel", F.when((F.col("class") == "A") & (F.col("weight") > 0.07), 1).otherwise(2).alias("zone"))
    return exports.filled_in_sure(p.where("class = 'R'").select("voxel"), zones, "voxel")


@register("qa_pass", f"""with e as (select class, z - 35 as d from {P}), m as (select class, median(d) as m from e group by class),
    s as (select class, count(*) as n, avg(d) as mean, any_value(m) as median, sqrt(avg(d * d)) as rms, quantile_cont(abs(d), 0.95) as p95, 1.4826 * median(abs(d - m)) as nmad from e join m using (class) group by class)
    select class, n, round(mean, 6) as mean, round(median, 6) as median, round(rms, 6) as rms, round(p95, 6) as p95, round(nmad, 6) as nmad, case when rms <= 20 then 'pass' when rms <= 24 then 'warn' else 'fail' end as status,
      case when rms <= 20 then 100 when rms <= 24 then 50 else 0 end as score from s""")
def qa_pass(spark, sf_dir):
    """Error statistics of each class with status and score."""
    return rounded(exports.qa_pass(points(spark, sf_dir).select("class", (F.col("z") - 35).alias("d")), ["class"], "d", 20.0, 24.0))


@register("report_table", f"""select channel, '<tr><th>' || channel || '</th><td>' || format('{{:,}}', count(*)) || '.00</td><td>' || format('{{:,}}', max(event_id)) || '.0 id</td></tr>' as html from {T} group by channel""")
def report_table(spark, sf_dir):
    """Rows of a report's table."""
    rows = telemetry(spark, sf_dir).groupBy("channel").agg(F.count("*").cast("double").alias("n"), F.max("event_id").cast("double").alias("last"))
    return exports.report_rows(rows, "channel", {"n": (2, ""), "last": (1, " id")}).select("channel", "html")


@register("run_report", f"""with s as (select video, priority, count(*) as n, sum(round(overlap * 100, 0)) as secs, max(status) as status from {R} group by video, priority)
    select video, coalesce(array_to_string(list_sort(list(priority || '=' || cast(cast(secs as bigint) as varchar)) filter (status <> 'P')), ','), '') as took, round(coalesce(sum(secs) filter (status <> 'P'), 0), 1) as total_seconds, coalesce(array_to_string(list_sort(list(priority) filter (status = 'P')), ','), '') as open from s group by video""")
def run_report(spark, sf_dir):
    """Stage seconds, their sum and what is open for each run."""
    s = frames(spark, sf_dir).groupBy("video", "priority").agg(F.sum(F.round(F.col("overlap") * 100, 0)).alias("secs"), F.max("status").alias("status"))
    found = exports.run_report(s.withColumn("status", F.when(F.col("status") == "P", "open").otherwise("done")), "video", "priority", "status", "secs")
    took = F.transform(F.map_entries("stage_seconds"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("long").cast("string")))
    return found.select("video", F.array_join(took, ",").alias("took"), "total_seconds", F.array_join("open", ",").alias("open"))


@register("pair_rates", f"""with f as (select video, frame, sharpness, row_number() over (partition by video order by frame) as k, overlap from {R}), q as (select video, k as t0, k + 2 as t1, overlap from f where k % 2 = 1)
    select f.video, frame, round(q.overlap / 2, 9) as shift from f left join q on q.video = f.video and q.t0 = f.k""")
def pair_rates(spark, sf_dir):
    """Frames with the rate of the pair that starts at them."""
    from pyspark.sql.window import Window

    f = frames(spark, sf_dir).withColumn("k", F.row_number().over(Window.partitionBy("video").orderBy("frame")))
    pairs = f.where("k % 2 = 1").select("video", F.col("k").alias("t0"), (F.col("k") + 2).alias("t1"), "overlap")
    return rounded(footage.with_pairs(f, pairs, ["video"], "k", "t0", "t1", {"overlap": "shift"}).select("video", "frame", "shift"), 9)


@register("frame_quality", f"""select video, count(*) as n, round(avg(case when overlap < 0.2 then 1.0e0 else 0 end), 6) as overlap_below, round(avg(case when sharpness < 25000 then 1.0e0 else 0 end), 6) as sharpness_below,
      round(avg(case when overlap > 0.9 then 1.0e0 else 0 end), 6) as overlap_above, round(median(sharpness), 4) as sharpness_median from {R} group by video""")
def frame_quality(spark, sf_dir):
    """Shares of frames beyond limits and medians of each series."""
    made = footage.frame_quality(frames(spark, sf_dir), ["video"], {"overlap": 0.2, "sharpness": 25000.0}, {"overlap": 0.9}, ["sharpness"])
    return rounded(made.withColumn("sharpness_median", F.round("sharpness_median", 4)))


@register("static_overlay", f"""with c as (select class, cast(y as bigint) as row, cast(x as bigint) as col, avg(case when weight > 0.004 then 1.0e0 else 0 end) as stay from {P} group by all),
    s as (select class, count(*) as cells, count(*) filter (stay >= 0.96) > 0.5 * count(*) filter (stay > 0.3) as still from c group by class),
    g as (select distinct c.class, c.row, c.col from c join c h on h.class = c.class and h.stay >= 0.96 and abs(h.row - c.row) <= 1 and abs(h.col - c.col) <= 1),
    f as (select class, count(*) as n, min(col) as x0, min(row) as y0, max(col) as x1, max(row) as y1 from g group by class)
    select class, round(case when still or n is null then 0 else n / cells end, 6) as share, case when not still then x0 end as x0, case when not still then y0 end as y0, case when not still then x1 end as x1, case when not still then y1 end as y1 from s left join f using (class)""")
def static_overlay(spark, sf_dir):
    """Cells whose edges stay while the scene moves."""
    rows = points(spark, sf_dir).select("class", "view", F.col("y").cast("long").alias("row"), F.col("x").cast("long").alias("col"), "weight")
    return rounded(footage.static_overlay(rows, ["class"], "view", F.col("weight") > 0.004, 0.96, 1))


@register("shadow_regions", """with recursive p as (select p_size % 3 as image, p_partkey // 40 as row, p_partkey % 40 as col, 0.2e0 + (p_partkey * 7919 % 100) / 200e0 as r, 0.3e0 as g, 0.25e0 + (p_partkey * 104729 % 100) / 300e0 as b from part),
    v as (select image, row, col, greatest(r, g, b) as v, (greatest(r, g, b) - least(r, g, b)) / greatest(r, g, b) as s, (b * 255 + 1) / (r * 255 + 1) as blue from p),
    m as (select image, median(blue) as bm, median(v) as vm from v group by image),
    c as (select v.*, row * 1000 + col as id from v join m using (image) where blue > bm + 0.12 and v < vm * 1.05 and s <= 0.6),
    l as (select image, id, id as label from c union select c.image, c.id, l.label from l join c k on k.image = l.image and k.id = l.id join c on c.image = l.image and abs(c.row - k.row) <= 1 and abs(c.col - k.col) <= 1 and l.label < c.id),
    g as (select image, id, min(label) as label from l group by image, id),
    i as (select c.image, label, count(*) as cells, avg(v) as inside, min(c.id) as first from c join g on g.image = c.image and g.id = c.id group by c.image, label having count(*) >= 2),
    n as (select distinct g.image, g.label, v.row, v.col, v.v from g join c on c.image = g.image and c.id = g.id join v on v.image = g.image and abs(v.row - c.row) <= 1 and abs(v.col - c.col) <= 1
      where not exists (select 1 from c k where k.image = v.image and k.row = v.row and k.col = v.col)),
    a as (select image, label, avg(v) as around from n group by image, label)
    select i.image, first // 1000 as row, first % 1000 as col, cells, round(inside, 6) as inside, round(around, 6) as around from i left join a using (image, label) where around is null or inside < 0.97 * around""")
def shadow_regions(spark, sf_dir):
    """Cast shadows of small images as dark bluish regions."""
    k = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(
        (F.col("p_size") % 3).alias("image"), F.floor(k / 40).cast("long").alias("row"), (k % 40).alias("col"), (0.2 + (k * 7919 % 100) / 200).alias("r"), F.lit(0.3).alias("g"), (0.25 + (k * 104729 % 100) / 300).alias("b")
    )
    return rounded(footage.shadow_regions(rows, "image", least_cells=2, dark_ratio=0.97))


@register("camera_cover", f"""with n as (select view % 7 as cam, count(distinct voxel) as n from {P} group by 1) select cam, n from n qualify row_number() over (order by n desc, cam) = 1""")
def camera_cover(spark, sf_dir):
    """O3: the first camera of a greedy cover, with what it gains."""
    pairs = points(spark, sf_dir).select((F.col("view") % 7).alias("cam"), "voxel").distinct()
    first = cloud.set_cover(pairs, "cam", "voxel", 1, 1)
    return pairs.where(F.col("cam").isin(first)).groupBy("cam").agg(F.count("*").alias("n"))


@register("numbered_regions", f"""select event_id, row_number() over (order by value desc, event_id) as number from {T}""")
def numbered_regions(spark, sf_dir):
    """O2: all rows numbered by a value, without one task that holds them."""
    rows = telemetry(spark, sf_dir).select("event_id", "value")
    return windows.numbered_by(rows, [F.desc("value"), F.col("event_id")]).select("event_id", "number")


@register("exact_quantiles", f"""select channel, count(*) as n, round(quantile_cont(value, 0.1), 8) as q0, round(median(value), 8) as q1, round(quantile_cont(value, 0.975), 8) as q2 from {T} group by channel""")
def exact_quantiles(spark, sf_dir):
    """A3: quantiles of each channel from merged counts."""
    return rounded(stats.quantiles(telemetry(spark, sf_dir), ["channel"], "value", [0.1, 0.5, 0.975]), 8)
