"""Queries of scalar functions: every row of a table through them, against the same in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.functions import scalar as S
from skyloom.plans.catalog import register
from skyloom.plans.tables import FRAMES_SQL, POINTS_SQL, TELEMETRY_SQL, frames, points, rounded, table, telemetry

T, P, R = TELEMETRY_SQL, POINTS_SQL, FRAMES_SQL


def _listed(values: list[str], k):
    """The k-th of some texts, by a number of the row."""
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(k, F.lit(len(values))) + 1).cast("int"))


def _listed_sql(values: list[str], k: str) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + f"][({k}) % {len(values)} + 1]"


KINDS = ["gpmd", "KLV data", "djmd 1", "camm", "mov_text", "GoPro MET", "hevc"]
TRUE = ["yes", "No", " TRUE ", "0", "on", "Recording", "x"]


@register("text_parsers", f"""select event_id, try_cast(trim(case when event_id % 3 = 0 then channel else ' ' || value end) as double) as number,
      strptime(strftime(timestamp '2024-01-01' + to_seconds(event_id), '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') as wall,
      cast((case when event_id % 2 = 0 then '+' else '-' end) || (event_id % 90) || '.25' as double) as iso_lat, cast('+' || (event_id % 180) || '.5' as double) as iso_lon,
      round((case when event_id % 4 in (0, 1) then 1 else -1 end) * (event_id % 90 + (event_id % 60) / 60e0 + (event_id % 7) / 3600e0), 9) as dms,
      channel as local_name, case event_id % 7 when 0 then 'gpmf' when 1 then 'klv' when 2 then 'dji' when 3 then 'camm' when 4 then 'srt' when 5 then 'gpmf' end as kind,
      channel || case when event_id % 126 + 1 between 33 and 126 then chr(cast(event_id % 126 + 1 as int)) else '' end as tag
    from {T}""")
def text_parsers(spark, sf_dir):
    """Texts made of each row, parsed back."""
    i = F.col("event_id")
    whole = lambda n: F.pmod(i, F.lit(n)).cast("string")
    iso = F.concat(F.when(i % 2 == 0, "+").otherwise("-"), whole(90), F.lit(".25+"), whole(180), F.lit(".5/"))
    ref = _listed(["N", "e ", "s", "W"], i)
    rows = telemetry(spark, sf_dir).withColumn("ts", F.timestamp_seconds(F.lit(1704067200) + i)).withColumn("iso", S.iso6709(iso))
    return rounded(
        rows.select(
            "event_id",
            S.safe_double(F.when(i % 3 == 0, F.col("channel")).otherwise(F.concat(F.lit(" "), F.col("value").cast("string")))).alias("number"),
            S.wall_time(F.concat(F.lit("take "), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" end"))).cast("timestamp_ntz").alias("wall"),
            F.col("iso.lat").alias("iso_lat"),
            F.col("iso.lon").alias("iso_lon"),
            S.dms_degrees((i % 90).cast("double"), (i % 60).cast("double"), (i % 7).cast("double"), ref).alias("dms"),
            S.local_name(F.concat(F.lit("{http://x/1}"), F.col("channel"))).alias("local_name"),
            S.stream_kind(_listed(KINDS, i)).alias("kind"),
            S.clean_tag(F.concat(F.col("channel"), F.char(i % 126 + 1))).alias("tag"),
        ),
        9,
    )


@register("raw_values", f"""select event_id, round(-90 + (event_id * 7919 % 65536) * (180 / 65535e0), 9) as unsigned,
      round(case when (event_id * 7919 % 65536) = 32768 then null else (case when (event_id * 7919 % 65536) >= 32768 then (event_id * 7919 % 65536) - 65536 else event_id * 7919 % 65536 end) * (180 / 32767e0) end, 9) as signed,
      lower(trim({_listed_sql(TRUE, "event_id")})) in ('1', 'true', 'yes', 'on', 'recording', 'start', 'video') as truthy, round(case when value > 80 then value / 10 else value end, 9) as focal,
      event_id % 5 <> 0 and event_id % 7 <> 0 as fix from {T}""")
def raw_values(spark, sf_dir):
    """Ranges, focal lengths, fixes and switches of raw values."""
    i = F.col("event_id")
    raw = i * 7919 % 65536
    lat = F.when(i % 5 == 0, None).when(i % 7 == 0, 0.0).otherwise(F.col("lat"))
    lon = F.when(i % 7 == 0, 0.0).otherwise(F.col("lon"))
    made = telemetry(spark, sf_dir).select("event_id", S.unsigned_range(raw, 16, -90.0, 90.0).alias("unsigned"), S.signed_range(raw, 16, 180.0).alias("signed"), S.truthy(_listed(TRUE, i)).alias("truthy"), S.repaired_focal("value").alias("focal"), S.valid_fix(lat, lon).alias("fix"))
    return rounded(made, 9)


@register("status_rules", f"""select point_id, case when b = 'BLOCK' then 'WARN' else b end as soft, case when z > 80 then 'fail' when z > 50 then 'warn' else 'pass' end as high,
      case when z <= 20 then 'pass' when z <= 60 then 'warn' else 'fail' end as low, case when z > 60 then 'leave' when source <> 'F' then 'leave' when class <> 'N' then 'flag' else 'fill' end as action,
      case when z > 60 then 'too large' when source <> 'F' then 'not ground' when class <> 'N' then 'neighbours unsure' else 'small hole in sure ground' end as reason,
      round(least(greatest(y / 8, 0), 1), 9) as confidence, y > 2 and x * 40 < 1920 and z * 10 < 1080 as inside, least((x * 3) % 16, 16 - (x * 3) % 16) <= 1 or least(floor(z) % 16, 16 - floor(z) % 16) <= 1 as near_grid
    from (select *, case when z >= 60 then 'PASS' when z >= 30 then 'WARN' else 'BLOCK' end as b from {P})""")
def status_rules(spark, sf_dir):
    """Statuses and rules of each point."""
    p = points(spark, sf_dir)
    hole = S.hole_policy("z", F.col("source") == "F", F.col("class") == "N", 60.0)
    made = p.select(
        "point_id", S.soft(S.band("z", 60.0, 30.0)).alias("soft"), S.threshold_status("z", 50.0, 80.0).alias("high"), S.lower_better("z", 20.0, 60.0).alias("low"),
        hole["action"].alias("action"), hole["reason"].alias("reason"), S.view_confidence("y", 8.0).alias("confidence"),
        S.inside_image(F.col("x") * 40, F.col("z") * 10, F.round(F.col("y") - 2, 6), F.lit(1920), F.lit(1080)).alias("inside"), S.keypoint_near_grid(F.col("x") * 3, F.floor("z"), 16, 1).alias("near_grid"),
    )
    return rounded(made, 9)


@register("frame_rules", f"""select video, frame, round(frame / (24.0e0 + video % 7), 6) as at_s, case when video % 7 = 0 then 12 else greatest(1, cast(round_even(overlap * 2 * (video % 7), 0) as int)) end as stride,
      round(sharpness * case when status = 'F' then 1.15 else 1 end, 4) as score, round(case when video % 3 = 0 then (24 + frame % 50) / 36e0 * 1920 else 1920 / (2 * tan(radians(40 + frame % 50) / 2)) end, 6) as focal,
      round(greatest(0, 1 - abs(frame % 97 - video % 89) * 40 / 1920e0), 9) as overlap, cast(floor((sharpness + 7) / 250) as bigint) as cell from {R}""")
def frame_rules(spark, sf_dir):
    """Times, strides, scores, focal lengths, overlaps and cells of frames."""
    f, v = F.col("frame"), F.col("video")
    made = frames(spark, sf_dir).select(
        "video", "frame", S.frame_time("frame", F.lit(24.0) + v % 7).alias("at_s"), S.stride_frames(F.col("overlap") * 2, F.lit(12), (v % 7).cast("double")).alias("stride"),
        F.round(S.candidate_score("sharpness", F.col("status") == "F"), 4).alias("score"), F.round(S.focal_px(F.when(v % 3 != 0, (40 + f % 50).cast("double")), (24 + f % 50).cast("double"), F.lit(1920)), 6).alias("focal"),
        S.true_overlap(f % 97, v % 89, F.lit(40), F.lit(1920)).alias("overlap"), S.cell("sharpness", -7, 250).alias("cell"),
    )
    return made.select("video", "frame", F.round("at_s", 6).alias("at_s"), "stride", "score", "focal", F.round("overlap", 9).alias("overlap"), "cell")


_ORIGIN = (28.0, 77.0, 200.0)


@register("local_frames", f"""select event_id, round(e, 4) as e, round(n, 4) as n, round(28 + degrees(n / (m + 200)), 9) as lat, round(77 + degrees(e / ((v + 200) * cos(radians(28)))), 9) as lon,
      round(radians(lon - 77) * cos(radians(28)) * 6378137, 4) as sphere_e, round(radians(lat - 28) * 6378137, 4) as sphere_n, round((lon - 77) * 111320 * cos(radians(28)), 4) as plot_e, round((lat - 28) * 111320, 4) as plot_n
    from (select *, radians(lon - 77) * (v + 200) * cos(radians(28)) as e, radians(lat - 28) * (m + 200) as n from
      (select *, 6378137 * (1 - e2) / pow(1 - e2 * pow(sin(radians(28)), 2), 1.5) as m, 6378137 / sqrt(1 - e2 * pow(sin(radians(28)), 2)) as v from
        (select *, (1 / 298.257223563e0) * (2 - 1 / 298.257223563e0) as e2 from {T})))""")
def local_frames(spark, sf_dir):
    """M1 to M5: local metres by ellipsoid and sphere, and back to degrees."""
    o = [F.lit(x) for x in _ORIGIN]
    e, n, _ = S.enu_wgs84("lat", "lon", F.lit(200.0), *o)
    rows = telemetry(spark, sf_dir).withColumns({"e": e, "n": n})
    lat, lon = S.geodetic_of_enu("e", "n", *o)
    (se, sn), (pe, pn) = S.enu_sphere("lat", "lon", o[0], o[1]), S.plot_metres("lat", "lon", o[0], o[1])
    four = {"e": F.col("e"), "n": F.col("n"), "sphere_e": se, "sphere_n": sn, "plot_e": pe, "plot_n": pn}
    return rows.select("event_id", F.round(lat, 9).alias("lat"), F.round(lon, 9).alias("lon"), *(F.round(c, 4).alias(k) for k, c in four.items()))


@register("camera_rays", f"""with c as (select *, x - 25 as dx, y - 5 as dy, 200 - z as dz from {P})
    select point_id, round(1500 * dx / dz + 960, 6) as u, round(1500 * dy / dz + 540, 6) as v, round(dz, 6) as depth, round(dx / sqrt(dx * dx + dy * dy + dz * dz), 6) as rx, round(dy / sqrt(dx * dx + dy * dy + dz * dz), 6) as ry,
      round(-dz / sqrt(dx * dx + dy * dy + dz * dz), 6) as rz from c""")
def camera_rays(spark, sf_dir):
    """Points in a camera that looks down, and the rays of their pixels."""
    k, r = F.array(*map(F.lit, (1500.0, 0.0, 960.0, 0.0, 1500.0, 540.0, 0.0, 0.0, 1.0))), F.array(*map(F.lit, (1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, -1.0)))
    u, v, depth = S.project(["x", "y", "z"], k, r, [F.lit(25.0), F.lit(5.0), F.lit(200.0)])
    rows = points(spark, sf_dir).withColumns({"u": u, "v": v, "depth": depth})
    return rounded(rows.select("point_id", "u", "v", "depth", *(c.alias(n) for c, n in zip(S.pixel_ray("u", "v", k, r), ("rx", "ry", "rz"), strict=True))))


@register("utc_times", f"""select event_id, case when event_id % 3 = 0 then timestamp '2024-01-01' + to_seconds(event_id) when event_id % 3 = 1 then timestamp '2024-01-01' + to_seconds(event_id) - interval 5 hour - interval 30 minute end as utc,
      case when event_id % 2 = 0 then timestamp '2024-01-01' + to_seconds(event_id) else timestamp '2023-06-01 12:00:00' end as start, 'clip' || event_id || '.v1_' || strftime(timestamp '2024-01-01' + to_seconds(event_id), '%Y%m%d_%H%M%S') as run from {T}""")
def utc_times(spark, sf_dir):
    """Times with and without a zone, the first believable start, names of runs."""
    i = F.col("event_id")
    rows = telemetry(spark, sf_dir).withColumn("ts", F.timestamp_seconds(F.lit(1704067200) + i))
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    utc = S.utc_time(F.when(i % 3 == 0, text).when(i % 3 == 1, F.concat(text, F.lit("+05:30"))).otherwise(F.lit("n/a")))
    start = S.video_start(F.when(i % 2 == 0, text).otherwise(F.lit("1970-01-01 00:00:00")), F.lit("2023-06-01 12:00:00"))
    return rows.select("event_id", utc.cast("timestamp_ntz").alias("utc"), start.cast("timestamp_ntz").alias("start"), S.run_id(F.concat(F.lit("/data/clip"), i.cast("string"), F.lit(".v1.mp4")), "ts").alias("run"))


@register("report_cells", f"""select event_id, case when event_id % 5 = 0 then '—' else format('{{:,}}', event_id * 1237) || '.00 m' end as shown, '&lt;b&gt;' || channel || '&lt;/b&gt; &amp; &quot;' || event_id || '&quot;' as cell from {T}""")
def report_cells(spark, sf_dir):
    """numbers and texts as cells of a report."""
    i = F.col("event_id")
    return telemetry(spark, sf_dir).select("event_id", S.shown_number(F.when(i % 5 != 0, (i * 1237).cast("double")), 2, " m").alias("shown"), S.html_text(F.concat(F.lit("<b>"), F.col("channel"), F.lit('</b> & "'), i.cast("string"), F.lit('"'))).alias("cell"))


@register("dense_sizes", f"""select video, frame, case when c(1600) <= a then 1600 when 1280 < least(1600, n) and c(1280) <= a then 1280 when 960 < least(1600, n) and c(960) <= a then 960
      when 960 < least(1600, n) then 960 when 1280 < least(1600, n) then 1280 else 1600 end as size, g.chunk from (select *, 800 + frame % 2000 as n, sharpness / 300 as a from {R}) f,
      lateral (select case when b <= 4 then 8 when b < 12 then greatest(8, least(50, cast(floor(1 + (b - 4) * (49 / 8e0) + 1e-9) as int))) when b < 30 then greatest(8, least(200, cast(floor(50 + (b - 12) * (150 / 18e0) + 1e-9) as int)))
        else cast(floor(50 + (b - 12) * (150 / 18e0) + 1e-9) as int) end as chunk from (select greatest(8 + frame % 60 - 4.0e0, 0) as b)) g""".replace("c(1600)", "(100 * 0.5e0 * pow(least(1600, n) / 1280e0, 2))").replace("c(1280)", "(100 * 0.5e0 * pow(least(1280, n) / 1280e0, 2))").replace("c(960)", "(100 * 0.5e0 * pow(least(960, n) / 1280e0, 2))"))
def dense_sizes(spark, sf_dir):
    """The size that a budget allows and the frames that a memory holds."""
    native, budget = 800 + F.col("frame") % 2000, F.col("sharpness") / 300
    size = S.budgeted_size([1600, 1280, 960], native, F.lit(100), F.lit(0.5), budget)
    return frames(spark, sf_dir).select("video", "frame", size.alias("size"), S.chunk_frames((8 + F.col("frame") % 60).cast("double"), [(1, 4.0), (50, 12.0), (200, 30.0)]).alias("chunk"))


@register("stable_order", f"""select track, event_id, row_number() over (partition by track order by cast(floor(t / 86400) as bigint), event_id) as place from {T}""")
def stable_order(spark, sf_dir):
    """O1: rows by time within each track; rows of one time keep the order in which they came."""
    from pyspark.sql.window import Window

    day = F.floor(F.col("t") / 86400)
    return telemetry(spark, sf_dir).select("track", "event_id", F.row_number().over(Window.partitionBy("track").orderBy(day, "event_id")).cast("long").alias("place"))


@register("tiles_of_part", """select p_partkey, cast(floor((77 + p_size / 10e0 + 180) / 360 * 4096) as int) as x, cast(floor((1 - ln(tan(radians(28e0)) + 1 / cos(radians(28e0))) / pi()) / 2 * 4096) as int) as y from part""")
def tiles_of_part(spark, sf_dir):
    """Map tiles of places, by which terrain is looked up."""
    x, y = S.slippy_tile(F.lit(77.0) + F.col("p_size") / 10, F.lit(28.0), 12)
    return table(spark, sf_dir, "part").select("p_partkey", x.alias("x"), y.alias("y"))
