"""Queries of rendering and multi-view operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.operators import render
from skyloom.plans.catalog import register
from skyloom.plans.tables import POINTS_SQL, TELEMETRY_SQL, points, rounded, table, telemetry

P, T = POINTS_SQL, TELEMETRY_SQL


@register("camera_footprints", """with s as (select s_suppkey as cam, (s_acctbal % 40) as x, (s_suppkey * 7 % 40) as y, 1 + s_suppkey % 4 as h from supplier),
    c as (select cam, x, y, h, unnest(range(cast(floor((x - h) / 1.0e0) as bigint), cast(floor((x + h) / 1.0e0) as bigint) + 1)) as col from s),
    d as (select *, unnest(range(cast(floor(y - h) as bigint), cast(floor(y + h) as bigint) + 1)) as row from c)
    select distinct row, col from d where abs(col + 0.5 - x) + abs(row + 0.5 - y) <= h""")
def camera_footprints(spark, sf_dir):
    """Cells within any camera's footprint."""
    s = table(spark, sf_dir, "supplier").select((F.col("s_acctbal") % 40).alias("x"), (F.col("s_suppkey") * 7 % 40).cast("double").alias("y"), (1 + F.col("s_suppkey") % 4).cast("double").alias("h"))
    corner = lambda dx, dy: F.struct((F.col("x") + dx * F.col("h")).alias("x"), (F.col("y") + dy * F.col("h")).alias("y"))
    polygons = s.select(F.array(corner(1, 0), corner(0, 1), corner(-1, 0), corner(0, -1)).alias("corners"))
    return render.footprint_cells(polygons, "corners", 1.0)


@register("dynamic_pixels", f"""with v as (select cast(floor(x) as bigint) as u, cast(floor(y) as bigint) as w, 35.0e0 as d, z as o, weight as t from {P})
    select u, w, count(*) as views, count(*) filter (abs(o - d) > 0.5e0 * d) as against from v group by u, w having count(*) >= 3 and 2 * count(*) filter (abs(o - d) > 0.5e0 * d) > count(*) and max(t) >= 0.05""")
def dynamic_pixels(spark, sf_dir):
    """Pixels on which most views disagree."""
    v = points(spark, sf_dir).select(F.floor("x").cast("long").alias("u"), F.floor("y").cast("long").alias("w"), F.lit(35.0).alias("d"), F.col("z").alias("o"), F.col("weight").alias("t"))
    return render.dynamic_pixels(v, ["u", "w"], "d", "o", "t", tolerance=0.5, least_views=3, least_texture=0.05)


_ORTHO_SQL = """with t as (select point_id, x - 1.2 as x0, x + 1.3 as x1, x + 0.1 as x2, y - 0.9 as y0, y - 0.8 as y1, y + 1.4 as y2, z as z0, z + 1 as z1, z + 2 as z2 from (select point_id, cast(x as double) as x, y, z from {P})),
    b as (select *, cast(floor(least(x0, x1, x2) / 0.5) as bigint) as c0, cast(floor(greatest(x0, x1, x2) / 0.5) as bigint) as c1, cast(floor(least(y0, y1, y2) / 0.5) as bigint) as r0, cast(floor(greatest(y0, y1, y2) / 0.5) as bigint) as r1 from t),
    r as (select *, unnest(range(r0, r1 + 1)) as row from b), c as (select *, unnest(range(c0, c1 + 1)) as col from r),
    p as (select *, (col + 0.5) * 0.5 as px, (row + 0.5) * 0.5 as py, (y1 - y2) * (x0 - x2) + (x2 - x1) * (y0 - y2) as whole from c),
    w as (select *, ((y1 - y2) * (px - x2) + (x2 - x1) * (py - y2)) / whole as a, ((y2 - y0) * (px - x2) + (x0 - x2) * (py - y2)) / whole as bb from p),
    i as (select row, col, a * z0 + bb * z1 + (1 - a - bb) * z2 as z, point_id from w where a >= 0 and bb >= 0 and 1 - a - bb >= 0)
    select row, col, round(z, 5) as z, point_id from i qualify row_number() over (partition by row, col order by z desc, point_id desc) = 1"""


@register("ortho_render", _ORTHO_SQL.replace("{P}", P))
def ortho_render(spark, sf_dir):
    """Highest surface of triangles around every point."""
    p = points(spark, sf_dir).select("point_id", "x", "y", "z")
    corners = {f"{a}{k}": F.col(a) + d for a, ds in (("x", (-1.2, 1.3, 0.1)), ("y", (-0.9, -0.8, 1.4)), ("z", (0.0, 1.0, 2.0))) for k, d in enumerate(ds)}
    return rounded(render.render_ortho(p.withColumns(corners), "point_id", 0.5), 5)


@register("frame_overlaps", f"""select event_id, round(greatest(0, 1 - abs(value) / 500) * greatest(0, 1 - yaw / 400), 6) as overlap from {T}""")
def frame_overlaps(spark, sf_dir):
    """Share of a frame that a shift leaves covered."""
    one, zero = F.lit(1.0), F.lit(0.0)
    m = F.array(one, zero, F.col("value"), zero, one, F.col("yaw"))
    return rounded(telemetry(spark, sf_dir).select("event_id", render.overlap_of_transform(m, F.lit(500.0), F.lit(400.0)).alias("overlap")))


@register("triangulated_points", """select l_partkey as voxel, count(*) as views, 0.0e0 as rms_px, round(l_partkey % 9 + 0.0e0, 5) as x, 3.0e0 as y, round(l_partkey % 5 + 0.0e0, 5) as z from lineitem group by l_partkey having count(distinct l_suppkey % 7) >= 2""")
def triangulated_points(spark, sf_dir):
    """Points from their views by made-up cameras on a line."""
    p = points(spark, sf_dir)
    t = F.col("view").cast("double") % 7
    one, zero = F.lit(1.0), F.lit(0.0)
    camera = F.array(one, zero, zero, -t, zero, one, zero, zero, zero, zero, one, F.lit(10.0))
    rows = p.select("voxel", ((F.col("voxel") % 9 - t) / (F.col("voxel") % 5 + 10)).alias("u"), (F.lit(3.0) / (F.col("voxel") % 5 + 10)).alias("v"), camera.alias("p"), t.alias("t"))
    wide = rows.groupBy("voxel").agg(F.countDistinct("t").alias("k")).where("k >= 2").select("voxel")
    return rounded(render.triangulate(rows.join(wide, "voxel"), "voxel", "u", "v", "p"), 5)
