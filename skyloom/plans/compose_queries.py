"""Queries of composed passes."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.functions import scalar as S
from skyloom.operators import compose, recurrences
from skyloom.plans.catalog import register
from skyloom.plans.tables import POINTS_SQL, TELEMETRY_SQL, points, rounded, table, telemetry

P, T = POINTS_SQL, TELEMETRY_SQL


@register("gps_conditioning")
def gps_conditioning(spark, sf_dir):
    """Conditioned fixes of every track."""
    rows = telemetry(spark, sf_dir).groupBy("track", "t").agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"), F.avg("value").alias("alt"))
    return rounded(compose.condition_track(rows, ["track"], "t", max_speed=5.0, max_accel=5.0, tolerance=2000.0))


def _cameras(spark, sf_dir):
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(k.alias("view"), (k % 50).cast("double").alias("cx"), (k % 11).cast("double").alias("cy"), (F.lit(120.0) + k % 3).alias("cz"))


def _zones_sql(size: str) -> str:
    return f"""with c as (select s_suppkey as view, (s_suppkey % 50) * 1.0e0 as cx, (s_suppkey % 11) * 1.0e0 as cy, 120.0e0 + s_suppkey % 3 as cz from supplier),
    h as (select *, cast(floor(x / {size}) as bigint) as c_x, cast(floor(y / {size}) as bigint) as c_y, cast(floor(z / {size}) as bigint) as c_z from {P}),
    v as (select c_x, c_y, c_z, count(*) as n, avg(x) as mx, avg(y) as my, avg(z) as mz from h group by 1, 2, 3),
    r as (select distinct c_x, c_y, c_z, view from h), d as (select r.*, cx - mx as dx, cy - my as dy, cz - mz as dz from r join v using (c_x, c_y, c_z) join c using (view)),
    u as (select c_x, c_y, c_z, view, dx / sqrt(dx * dx + dy * dy + dz * dz) as x, dy / sqrt(dx * dx + dy * dy + dz * dz) as y, dz / sqrt(dx * dx + dy * dy + dz * dz) as z from d),
    m as (select c_x, c_y, c_z, avg(x) as ax, avg(y) as ay, avg(z) as az, count(*) as views from u group by 1, 2, 3),
    f as (select u.*, views, row_number() over (partition by u.c_x, u.c_y, u.c_z order by round(x * ax + y * ay + z * az, 12), view) as k from u join m using (c_x, c_y, c_z)),
    w as (select u.c_x, u.c_y, u.c_z, any_value(f.views) as views, degrees(acos(least(greatest(min(u.x * f.x + u.y * f.y + u.z * f.z), -1), 1))) as angle from u join f on u.c_x = f.c_x and u.c_y = f.c_y and u.c_z = f.c_z and f.k = 1 group by 1, 2, 3)
    select c_x, c_y, c_z, n, coalesce(views, 0) as views, round(angle, 3) as angle, case when coalesce(views, 0) >= 4 and round(coalesce(angle, 0), 6) >= 5 then 1 when coalesce(views, 0) >= 1 then 2 else 3 end as zone from v left join w using (c_x, c_y, c_z)"""


@register("cloud_zones", _zones_sql("4.0e0"))
def cloud_zones(spark, sf_dir):
    """Zones of voxels from views and widest ray angles."""
    return rounded(compose.classify_cloud(points(spark, sf_dir), _cameras(spark, sf_dir), 4.0), 3)


_FUSION_SQL = f"""with recursive z as ({_zones_sql("0.5e0")}), g as (select c_y as row, c_x as col, min(zone) as zone from z group by all), box as (select min(row) as r0, max(row) as r1, min(col) as c0, max(col) as c1 from g),
    e as (select row, col from (select unnest(range(r0, r1 + 1)) as row from box), (select unnest(range(c0, c1 + 1)) as col from box)),
    n as (select row * 4294967296 + col as id, row, col from e where not exists (select 1 from g where g.row = e.row and g.col = e.col and g.zone <= 1)),
    l as (select id, id as label from n union select b.id, l.label from l join n a on a.id = l.id join n b on abs(b.row - a.row) <= 1 and abs(b.col - a.col) <= 1 and l.label < b.id),
    m as (select id, min(label) as label from l group by id), r as (select label, count(*) as cells, avg(row) as row, avg(col) as col from n join m using (id) group by label)
    select row_number() over (order by cells desc, label) as number, cells, round(cells * 0.25e0, 6) as area, round(row, 6) as row, round(col, 6) as col from r"""


@register("fusion_gaps", _FUSION_SQL)
def fusion_gaps(spark, sf_dir):
    """Gaps of the fused ground map as numbered regions."""
    return rounded(compose.fusion_pass(points(spark, sf_dir), _cameras(spark, sf_dir), 0.5, 1, 0.25, sure=1)["gaps"])


@register("strip_input", f"""with p as (select track, t, avg(value) as value from {T} group by 1, 2), a as (select track, max(t) filter (t <= 500000) as t0, min(t) filter (t >= 500000) as t1, count(*) as n, any_value(value) as lone from p group by track),
    c as (select a.track, case when t0 is null or t1 is null then case when n = 1 then lone end when t0 = t1 then x.value else x.value + (y.value - x.value) * (500000 - t0) / (t1 - t0) end as value from a left join p x on x.track = a.track and x.t = t0 left join p y on y.track = a.track and y.t = t1)
    select track, 0.0e0 as t, round(value, 6) as value from c union all select track, round(t - 500000, 6), round(value, 6) from p where t > 500000 and t <= 900000""")
def strip_input(spark, sf_dir):
    """Tracks cut to a strip with an interpolated first row."""
    rows = telemetry(spark, sf_dir).groupBy("track", "t").agg(F.avg("value").alias("value"))
    return rounded(compose.strip_input(rows, ["track"], "t", ["value"], 500000.0, 900000.0))


@register("gap_samples", f"""with recursive p as (select distinct track, t from {T}), k as (select track, min(t) as t from p group by track
      union all select k.track, min(p.t) from k join p on p.track = k.track and p.t >= k.t + 43200 group by k.track) select track, t from k""")
def gap_samples(spark, sf_dir):
    """Samples at least half a day apart on each track."""
    return recurrences.gap_sampled(telemetry(spark, sf_dir).select("track", "t").distinct(), ["track"], "t", 43200.0)


@register("utm_round_trip", f"""select event_id, round(lon, 7) as lon, round(lat, 7) as lat from {T}""")
def utm_round_trip(spark, sf_dir):
    """M8, M9: degrees to UTM and back."""
    e, n = S.utm("lon", "lat")
    rows = telemetry(spark, sf_dir).select("event_id", e.alias("e"), n.alias("n"), (S.utm_epsg("lon", "lat") % 100).alias("zone"), (F.col("lat") < 0).alias("south"))
    lon, lat = compose.geodetic_of_utm(F.col("e"), F.col("n"), F.col("zone"), F.col("south"))
    return rows.select("event_id", F.round(lon, 7).alias("lon"), F.round(lat, 7).alias("lat"))


@register("memory_curve", f"""select event_id, round(case when value <= 50 then 4.0e0 when value <= 200 then 4 + (value - 50) * 8 / 150 when value <= 400 then 12 + (value - 200) * 18 / 200 else 30.0e0 end, 6) as gb from {T}""")
def memory_curve(spark, sf_dir):
    """A piecewise linear curve."""
    return rounded(telemetry(spark, sf_dir).select("event_id", compose.piecewise(F.col("value"), [(50, 4), (200, 12), (400, 30)]).alias("gb")))


@register("first_seen_groups", f"""select channel, min(event_id) as first, count(*) as n from {T} group by channel""")
def first_seen_groups(spark, sf_dir):
    """Groups in first-seen order."""
    return compose.first_seen_groups(telemetry(spark, sf_dir), "channel", "event_id")
