"""Queries of anchored depth: frames of 24 x 24 pixels from the suppliers' line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.operators import anchoring
from skyloom.operators.anchoring import AnchorLimits
from skyloom.operators.distance import nearest_cells
from skyloom.plans.catalog import register
from skyloom.plans.tables import halves_up, table

LIMITS = AnchorLimits(least_region=8, least_band=20, band=2, pairs=60, near=0.3, near_share=0.002, residual=0.25, residual_share=0.001, holdout_share=0.006, blend=4, beyond_share=0.05)


def _pixels(spark, sf_dir):
    """Depths rise over a frame; a disc of it is unmeasured. In some frames depth and measure have nothing in common, some have no disc."""
    cells = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("frame"), (F.col("l_partkey") % 24).alias("row"), (F.col("l_orderkey") % 24).alias("col"))
    cells = cells.agg(F.round(F.avg("l_discount"), 6).alias("a"), F.round(F.avg("l_tax"), 6).alias("b"), F.round(F.avg("l_quantity"), 6).alias("q"))
    grid = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("frame")).withColumn("row", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(23).cast("long"))))
    grid = grid.withColumn("col", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(23).cast("long"))))
    p = grid.join(cells, ["frame", "row", "col"], "left")
    true = 40 + 0.3 * F.col("row") + 0.2 * F.col("col") + 5 * F.coalesce("a", F.lit(0.05))
    own = F.when(F.col("frame") % 7 == 0, 1 + F.coalesce("q", F.lit(25.0)) / 50).otherwise((true + 8 * F.coalesce("b", F.lit(0.04)) - 12) / 25)
    hole = ((F.col("row") - 12) * (F.col("row") - 12) + (F.col("col") - 10) * (F.col("col") - 10) < 20) & (F.col("frame") % 11 != 0)
    return p.select("frame", "row", "col", own.alias("mono"), (F.coalesce("q", F.lit(25.0)) / 50).alias("conf"), F.when(~hole, true).alias("measured"))


_PIXELS_SQL = """cells as (select l_suppkey as frame, l_partkey % 24 as row, l_orderkey % 24 as col, round(avg(l_discount), 6) as a, round(avg(l_tax), 6) as b, round(avg(l_quantity), 6) as q from lineitem group by all),
  grid as (select s_suppkey as frame, r.row, c.col from supplier, range(24) r(row), range(24) c(col)),
  true_ as (select grid.*, 40 + 0.3e0 * row + 0.2e0 * col + 5 * coalesce(a, 0.05e0) as d, coalesce(b, 0.04e0) as b, coalesce(q, 25e0) as q from grid left join cells using (frame, row, col)),
  pixels as materialized (select frame, row, col, case when frame % 7 = 0 then 1 + q / 50 else (d + 8 * b - 12) / 25 end as mono, q / 50 as conf,
    case when (row - 12) * (row - 12) + (col - 10) * (col - 10) < 20 and frame % 11 <> 0 then null else d end as measured from true_)"""

_ANCHOR_SQL = f"""with {_PIXELS_SQL},
  low as (select frame, quantile_cont(conf, 0.3) as low from pixels group by frame),
  v as materialized (select p.*, mono > 0 and conf >= low as valid, mono > 0 and conf >= low and measured is null as region from pixels p join low using (frame)),
  d as (select a.frame, a.row, a.col, min((a.row - s.row) ** 2 + (a.col - s.col) ** 2) as d2 from v a join v s on s.frame = a.frame and s.region group by all),
  z as materialized (select v.*, case when valid and measured is not null and d2 <= 4 then 'band' when valid and measured is not null and d2 <= 16 then 'ring' end as zone,
    greatest(0.3e0, 0.002e0 * measured) as tol from v left join d using (frame, row, col)),
  dealt as (select frame, mono, measured, m, t, md5(frame || ':' || row || ':' || col || ':' || t) as h from (select *, unnest(range(ceil(60 / m)::bigint)) as t
    from z join (select frame, greatest(1, least(60, count(*) // 2)) as m from z where zone = 'band' group by frame) using (frame) where zone = 'band')),
  ends as (select frame, t * m + ('0x' || substr(h, 1, 6))::int % m as k, arg_min(mono, h) as x1, arg_min(measured, h) as y1, arg_max(mono, h) as x2, arg_max(measured, h) as y2 from dealt group by all),
  lines as (select frame, k, (y2 - y1) / (x2 - x1) as s, y1 - (y2 - y1) / (x2 - x1) * x1 as t from ends where x1 <> x2 and (y2 - y1) / (x2 - x1) > 0),
  tried as (select frame, k, s, t, count(*) as n from lines join z using (frame) where zone = 'band' and abs(s * mono + t - measured) < tol group by all),
  best as (select frame, s, t from (select *, row_number() over (partition by frame order by n desc, k) as place from tried) where place = 1),
  fit as (select frame, regr_slope(measured, mono) as scale, regr_intercept(measured, mono) as shift from z join best using (frame) where zone = 'band' and abs(s * mono + t - measured) < tol group by frame having count(*) >= 2 and regr_slope(measured, mono) > 0),
  p as materialized (select *, coalesce(zone = 'band' and abs(off) < tol, false) as inlier from (select z.*, scale, shift, scale * mono + shift - measured as off from z left join fit using (frame))),
  r as (select frame, count(*) filter (region) as region_px, count(measured) as measured_px, count(*) filter (zone = 'band') as band_px, any_value(scale) as scale, any_value(shift) as shift,
    count(*) filter (inlier) as n_in, sqrt(avg(off * off) filter (inlier)) as residual, median(measured) filter (zone = 'band') as band_depth, median(abs(off)) filter (zone = 'ring') as holdout,
    median(100 * abs(off) / measured) filter (zone = 'ring') as holdout_pct, quantile_cont(measured, 0.02) filter (inlier) as lo, quantile_cont(measured, 0.98) filter (inlier) as hi from p group by frame),
  j as materialized (select *, case when region_px < 8 then 'nothing to fill' when band_px < 20 then 'no measured pixels around' when inlier_share < 0.35 then 'too few agree'
    when residual > greatest(0.25e0, 0.001e0 * band_depth) then 'residual above the limit' when holdout_pct > 0.6 then 'held-out ring missed' end as reason
    from (select *, case when band_px = 0 then 0 else n_in / band_px end as inlier_share from r))"""


@register("anchored_frames", _ANCHOR_SQL + """
  select frame, case when reason is null then 'anchored' when region_px < 8 then 'skipped' else 'refused' end as status, reason, region_px, measured_px, band_px, round(scale, 5) as scale, round(shift, 4) as shift,
    round(inlier_share, 6) as inlier_share, round(residual, 5) as residual, round(band_depth, 5) as band_depth, round(holdout, 5) as holdout, round(holdout_pct, 5) as holdout_pct from j""")
def anchored_frames(spark, sf_dir):
    """Fit and gates of each frame."""
    r = anchoring.anchor_frames(_pixels(spark, sf_dir), LIMITS)[0]
    digits = {"scale": 5, "shift": 4, "inlier_share": 6, "residual": 5, "band_depth": 5, "holdout": 5, "holdout_pct": 5}
    return r.withColumns({c: halves_up(F.col(c), n) for c, n in digits.items()})


_FILLED_SQL = _ANCHOR_SQL + """,
  g as (select p.*, inlier_share, lo, hi, band_depth from p join j using (frame) where reason is null),
  near as (select a.frame, a.row, a.col, min({'d2': (a.row - s.row) ** 2 + (a.col - s.col) ** 2, 'c': s.col, 'r': s.row, 'fix': -s.off}) as n from g a join g s on s.frame = a.frame and s.inlier where a.region group by all),
  f as (select g.*, scale * mono + shift + n.fix * greatest(0, 1 - sqrt(n.d2) / 4) as depth from g join near using (frame, row, col)),
  filled as materialized (select frame, row, col, depth, 0.5e0 * (row_number() over (partition by frame order by conf, row, col) / count(*) over (partition by frame)) * inlier_share as weight
    from f where depth between lo - 0.05e0 * band_depth and hi + 0.05e0 * band_depth)"""


@register("anchored_depths", _FILLED_SQL + " select frame, row, col, round(depth, 5) as depth, round(weight, 6) as weight from filled")
def anchored_depths(spark, sf_dir):
    """What anchored frames say of unmeasured pixels, without a step at the seam."""
    return anchoring.anchor_frames(_pixels(spark, sf_dir), LIMITS)[1].withColumns({"depth": F.round("depth", 5), "weight": F.round("weight", 6)})


def _cameras(spark, sf_dir):
    """Cameras 60 above, a few units apart, that look down: their second axis points back."""
    down = F.array(*(F.lit(float(x)) for x in (1, 0, 0, 0, -1, 0, 0, 0, -1)))
    at = F.col("s_suppkey").cast("double")
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("frame"), F.lit(24.0).alias("f"), F.lit(12.0).alias("cu"), F.lit(12.0).alias("cv"), down.alias("rotation"), (at % 10 * 3).alias("cx"), (at % 6 * 4).alias("cy"), F.lit(60.0).alias("cz")
    )


@register("anchored_fill", _FILLED_SQL + """,
  world as (select frame, weight, s_suppkey % 10 * 3 + depth * ((col + 0.5e0 - 12) / 24) as x, s_suppkey % 6 * 4 - depth * ((row + 0.5e0 - 12) / 24) as y, 60 - depth as z
    from (select frame, row, col, round(depth, 5) as depth, round(weight, 6) as weight from filled) join supplier on s_suppkey = frame),
  held as (select *, floor(x / 2)::bigint as i, floor(y / 2)::bigint as j, floor(z / 2)::bigint as k from world where z between 5 and 19
    and (floor(y / 4)::bigint + floor(x / 4)::bigint) % 3 <> 0),
  kept as (select *, weight::decimal(12,6) as w6, x::decimal(12,6) as x6, y::decimal(12,6) as y6, z::decimal(12,6) as z6 from held where (i + j + k) % 5 <> 0 and weight > 0)
  select i, j, k, round(least(sum(w6)::double, 0.5), 6) as w, count(distinct frame) as frames, round(sum(w6 * x6)::double / sum(w6)::double, 4) as x, round(sum(w6 * y6)::double / sum(w6)::double, 4) as y,
    round(sum(w6 * z6)::double / sum(w6)::double, 4) as z from kept group by i, j, k having sum(w6) >= 0.3""")
def anchored_fill(spark, sf_dir):
    """Voxels filled from anchored frames, only over gaps and never where a surface was measured."""
    filled = anchored_depths(spark, sf_dir)
    span = lambda a, b: F.explode(F.sequence(F.lit(a).cast("long"), F.lit(b).cast("long")))
    cells = spark.range(1).select(span(-20, 20).alias("g_row")).select("g_row", span(-20, 20).alias("g_col"))
    voxels = spark.range(1).select(span(-40, 40).alias("i")).select("i", span(-40, 40).alias("j")).select("i", "j", span(0, 12).alias("k"))
    made = anchoring.fill(filled, _cameras(spark, sf_dir), cells.where("(g_row + g_col) % 3 <> 0"), voxels.where("(i + j + k) % 5 = 0"), 2.0, 4.0, (5.0, 19.0))
    return made.withColumns({"w": F.round("w", 6), **{c: F.round(c, 4) for c in "xyz"}})


@register("distance_transform", f"""with {_PIXELS_SQL}, s as (select frame, row, col from pixels where measured is null or conf > 0.95)
  select frame, p.row, p.col, n.r as near_row, n.c as near_col, n.d2 from
    (select p.frame, p.row, p.col, min(case when s.row is not null then {{'d2': ((p.row - s.row) ** 2 + (p.col - s.col) ** 2)::bigint, 'c': s.col, 'r': s.row}} end) as n from pixels p left join s using (frame) group by all) p""")
def distance_transform(spark, sf_dir):
    """Nearest marked pixel of each pixel, exact."""
    return nearest_cells(_pixels(spark, sf_dir), ["frame"], "row", "col", F.col("measured").isNull() | (F.col("conf") > 0.95)).select("frame", "row", "col", "near_row", "near_col", "d2")
