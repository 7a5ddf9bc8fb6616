"""Queries of lookups, gates and marks: undulation, kept refinements, atlas quality, block boundaries, map coordinates, gap features."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.functions import scalar as S
from skyloom.operators import compose, georef, images
from skyloom.plans.catalog import register
from skyloom.plans.tables import FRAMES_SQL, POINTS_SQL, frames, points, table
from skyloom.sources import sinks

_STEP = 15


@register("undulations", f"""with g as (select r.r as row, c.c as col, ((r.r * 7 + c.c * 3) % 41) * 2.5e0 - 50 as n from range(13) r(r), range(24) c(c) where (r.r * 24 + c.c) % 53 > 0),
  p as (select o_orderkey as i, (o_orderkey * 37 % 36000) / 100.0e0 - 180 as lon, (o_orderkey * 91 % 18001) / 100.0e0 - 90 as lat from orders),
  q as (select *, (lon + 180) / {_STEP} as x, (lat + 90) / {_STEP} as y from p), f as (select *, least(floor(y), 11) as r, floor(x) as c from q),
  four as (select f.i as id, (r + d.i)::bigint as row, ((c + d.j)::bigint % 24) as col, case when d.i = 1 then y - r else 1 - (y - r) end * case when d.j = 1 then x - c else 1 - (x - c) end as w from f, (values (0, 0), (0, 1), (1, 0), (1, 1)) d(i, j))
  select id, case when count(n) = count(*) then round(sum(w * n), 6) end as undulation from four left join g using (row, col) where w > 0 group by id""")
def undulations(spark, sf_dir):
    """Heights of the geoid above the ellipsoid from a grid."""
    k = F.col("o_orderkey")
    p = table(spark, sf_dir, "orders").select(k.alias("id"), ((k * 37 % 36000) / F.lit(100.0) - 180).alias("lon"), ((k * 91 % 18001) / F.lit(100.0) - 90).alias("lat"))
    g = spark.range(13).select(F.col("id").alias("row"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(23).cast("long"))).alias("col"))
    g = g.where((F.col("row") * 24 + F.col("col")) % 53 > 0).withColumn("n", (F.col("row") * 7 + F.col("col") * 3) % 41 * 2.5 - 50)
    return georef.with_undulation(p, g, _STEP).select("id", F.round("undulation", 6).alias("undulation"))


@register("refinement_gates", f"""select frame, coalesce(overlap < 0.6 and sharpness * 0.9 <= 200000 * 1.1 and frame % 7 >= frame % 5, false) as kept from {FRAMES_SQL}""")
def refinement_gates(spark, sf_dir):
    """Which refined models are kept."""
    f = frames(spark, sf_dir)
    return f.select("frame", S.refinement_kept(F.lit(0.6), "overlap", F.lit(200000), F.col("sharpness") * 0.9, F.col("frame") % 5, F.col("frame") % 7).alias("kept"))


@register("atlas_quality", """with v as (select vec_id, list_transform(embedding, lambda x: abs(x::double) * 100) as p from embeddings), u as (select vec_id, p, list_filter(p, lambda x: abs(x - 10) > 2.0) as used from v)
  select vec_id, round(len(used) / len(p), 6) as used, round(100 * len(list_filter(used, lambda x: x <= 4.0)) / nullif(len(used), 0), 6) as black_pct from u""")
def atlas_quality(spark, sf_dir):
    """Used and black shares of texture atlases."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda v: F.abs(v.cast("double")) * 100).alias("p"))
    q = rows.select("vec_id", images.texture_quality(F.col("p"), 10.0, 2.0, 4.0).alias("q"))
    return q.select("vec_id", F.round("q.used", 6).alias("used"), F.round("q.black_pct", 6).alias("black_pct"))


@register("block_boundaries", """select l_orderkey, l_linenumber, least(l_orderkey % 8, 7 - l_orderkey % 8) < 2 or least(l_partkey % 8, 7 - l_partkey % 8) < 2 as near from lineitem""")
def block_boundaries(spark, sf_dir):
    """Cells near the boundaries of blocks."""
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", images.block_boundary(F.col("l_orderkey"), F.col("l_partkey"), 8, 2).alias("near"))


@register("map_coordinates", f"""select point_id, round(x + 700000.5, 6) as x, round(y + 3100000.25, 6) as y, round(z + 210, 6) as z from {POINTS_SQL}""")
def map_coordinates(spark, sf_dir):
    """Local points on the map."""
    made = compose.to_map([F.col(c) for c in "xyz"], [F.lit(700000.5), F.lit(3100000.25), F.lit(210.0)])
    return points(spark, sf_dir).select("point_id", *(F.round(e, 6).alias(c) for e, c in zip(made, "xyz", strict=True)))


@register("gap_features", """with r as (select s_suppkey as number, s_suppkey % 90 + 0.5e0 as area, s_suppkey % 50 + 0.1234567e0 as x, s_suppkey % 40 + 0.7654321e0 as y from supplier)
  select number, area, 4 as corners, round(x, 7) as west, round(y + 1, 7) as north, case when number % 3 = 0 then 'MultiPolygon' else 'Polygon' end as kind from r""")
def gap_features(spark, sf_dir):
    """Gaps as features, read back from their texts."""
    k = F.col("s_suppkey")
    x, y = k % 50 + 0.1234567, k % 40 + 0.7654321
    ring = lambda d: F.array(*(F.struct((x + i + d).alias("x"), (y + j).alias("y")) for i, j in ((0, 0), (1, 0), (1, 1), (0, 1))))
    rings = F.when(k % 3 == 0, F.array(ring(0), ring(5))).otherwise(F.array(ring(0)))
    made = sinks.gap_features(table(spark, sf_dir, "supplier").select(k.alias("number"), (k % 90 + 0.5).alias("area"), rings.alias("rings")))
    get = lambda p: F.get_json_object("feature", p)
    kind = get("$.geometry.type")
    first = F.when(kind == "Polygon", get("$.geometry.coordinates[0]")).otherwise(get("$.geometry.coordinates[0][0]"))
    corners = F.from_json(first, "array<array<double>>")
    made = made.select("number", get("$.properties.area").cast("double").alias("area"), corners.alias("c"), kind.alias("kind"))
    return made.select("number", "area", F.size("c").alias("corners"), F.array_min(F.transform("c", lambda p: p[0])).alias("west"), F.array_max(F.transform("c", lambda p: p[1])).alias("north"), "kind")
