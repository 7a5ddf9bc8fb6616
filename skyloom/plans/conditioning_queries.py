"""Queries of image conditioning: an image of 26 x 26 cells for each supplier, made from its line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.operators import conditioning as C
from skyloom.plans.catalog import register
from skyloom.plans.tables import table
from skyloom.session import materialise

SIZE = 26


def _images(spark, sf_dir):
    """Blocks of 8 cells with steps of a size that differs by supplier, noise from line items, some suppliers dark."""
    q = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("frame"), (F.col("l_partkey") % SIZE).alias("row"), (F.col("l_orderkey") % SIZE).alias("col"))
    q = q.agg(F.round(F.avg("l_quantity"), 3).alias("q"))
    grid = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("long").alias("frame"))
    span = F.sequence(F.lit(0).cast("long"), F.lit(SIZE - 1).cast("long"))
    grid = grid.withColumn("row", F.explode(span)).withColumn("col", F.explode(span)).join(q, ["frame", "row", "col"], "left")
    step = (F.floor(F.col("row") / 8) * 3 + F.floor(F.col("col") / 8) * 5) % 7 * (F.col("frame") % 4) * 8
    v = (20 + step + F.coalesce("q", F.lit(25.0)) / 2) * F.when(F.col("frame") % 3 == 0, 0.4).otherwise(1.0)
    return materialise(grid.select("frame", "row", "col", F.round(v, 3).alias("v")), "images")


_IMAGES_SQL = f"""with q as (select l_suppkey as frame, l_partkey % {SIZE} as row, l_orderkey % {SIZE} as col, round(avg(l_quantity), 3) as q from lineitem group by all),
  p as materialized (select s_suppkey::bigint as frame, r.row, c.col, round((20 + (r.row // 8 * 3 + c.col // 8 * 5) % 7 * (s_suppkey % 4) * 8 + coalesce(q.q, 25e0) / 2) * case when s_suppkey % 3 = 0 then 0.4e0 else 1e0 end, 3) as v
    from supplier join range({SIZE}) r(row) on true join range({SIZE}) c(col) on true left join q on q.frame = s_suppkey and q.row = r.row and q.col = c.col)"""

_SCORE_SQL = _IMAGES_SQL + f""",
  d as (select *, abs(lead(v) over (partition by frame, row order by col) - v) as dx, abs(lead(v) over (partition by frame, col order by row) - v) as dy from p),
  r as (select frame, avg(dx) filter ((col + 1) % 8 = 0 and col >= 8 and col < {SIZE} - 9) / avg(dx) filter ((col + 1) % 8 > 0 and col >= 8 and col < {SIZE} - 9) as rx,
    avg(dy) filter ((row + 1) % 8 = 0 and row >= 8 and row < {SIZE} - 9) / avg(dy) filter ((row + 1) % 8 > 0 and row >= 8 and row < {SIZE} - 9) as ry from d group by frame),
  scores as materialized (select frame, (rx + ry) / 2 as blockiness from r)"""


@register("block_scores", _SCORE_SQL + " select frame, round(blockiness, 6) as blockiness from scores")
def block_scores(spark, sf_dir):
    """Blockiness of each image."""
    return C.block_scores(_images(spark, sf_dir), 8).withColumn("blockiness", F.round("blockiness", 6))


def _pass_sql(name: str, source: str, sigma: float) -> str:
    return f"""{name} as materialized (select g.frame, g.row, g.col, sum(w * n) / sum(w) as f from (
    select g.frame, g.row, g.col, n.v as n, exp(-((n.row - g.row) ** 2 + (n.col - g.col) ** 2) / 50.0e0 - (n.v - o.v) ** 2 / {2 * sigma**2}e0) as w
    from grid g join {source} o using (frame, row, col) join {source} n on n.frame = g.frame and n.row between g.row - 3 and g.row + 3 and n.col between g.col - 3 and g.col + 3) g group by all)"""


@register("suppressed_blocks", _SCORE_SQL + f""",
  s as (select frame, 0.5e0 + 0.5e0 * least(greatest((blockiness - 1.3e0) / 1.3e0, 0), 1) as share from scores where blockiness >= 1.3),
  grid as materialized (select frame, row, col, share from p join s using (frame) where (row >= 6 and (row % 8 <= 2 or row % 8 >= 6)) or (col >= 6 and (col % 8 <= 2 or col % 8 >= 6))),
  {_pass_sql("one", "p", 87.5)}, once as materialized (select frame, row, col, coalesce(f, v) as v from p left join one using (frame, row, col)), {_pass_sql("two", "once", 35.0)}
  select frame, row, col, round(coalesce(share * f + (1 - share) * v, v), 4) as v from p left join two using (frame, row, col) left join grid using (frame, row, col)""")
def suppressed_blocks(spark, sf_dir):
    """Images with steps between blocks smoothed at the block grid."""
    return C.suppress_blocks(_images(spark, sf_dir)).withColumn("v", F.round("v", 4))


@register("local_contrast", f"""{_IMAGES_SQL},
  b as (select *, least(greatest(round(v), 0), 255)::bigint as bin, row // 8 as tr, col // 8 as tc from p),
  c as (select frame, tr, tc, bin, count(*) as n from b group by all), t as (select frame, tr, tc, sum(n) as area, greatest(1, floor(2.0e0 * sum(n) / 256))::bigint as lim from c group by all),
  o as (select frame, tr, tc, area, lim, sum(greatest(n - lim, 0)) as over from c join t using (frame, tr, tc) group by all),
  e as (select o.*, over // 256 as each_, over % 256 as rest, bins.bin from o, range(256) bins(bin)),
  h as (select e.*, least(coalesce(n, 0), lim) + each_ + case when rest > 0 and e.bin % greatest(256 // rest, 1) = 0 and e.bin // greatest(256 // rest, 1) < rest then 1 else 0 end as m from e left join c using (frame, tr, tc, bin)),
  k as materialized (select frame, tr, tc, bin, least(round_even((sum(m) over (partition by frame, tr, tc order by bin)) * 255.0e0 / area, 0), 255) as curve from h),
  four as (select b.frame, row, col, bin, least(greatest(floor(row / 8.0e0 - 0.5)::bigint + i, 0), {(SIZE - 1) // 8}) as tr, least(greatest(floor(col / 8.0e0 - 0.5)::bigint + j, 0), {(SIZE - 1) // 8}) as tc,
    case when i = 1 then row / 8.0e0 - 0.5 - floor(row / 8.0e0 - 0.5) else 1 - (row / 8.0e0 - 0.5 - floor(row / 8.0e0 - 0.5)) end * case when j = 1 then col / 8.0e0 - 0.5 - floor(col / 8.0e0 - 0.5) else 1 - (col / 8.0e0 - 0.5 - floor(col / 8.0e0 - 0.5)) end as w
    from b, (values (0, 0), (0, 1), (1, 0), (1, 1)) x(i, j))
  select frame, row, col, round(sum(w * curve), 6) as v from four join k using (frame, tr, tc, bin) group by all""")
def local_contrast(spark, sf_dir):
    """Images equalised by tiles."""
    return C.local_contrast(_images(spark, sf_dir))


_DARK_SQL = _IMAGES_SQL + """, m as (select frame, avg(v) / 255 as luma from p group by frame)"""


@register("low_light_labels", _DARK_SQL + " select frame, round(luma, 6) as mean_luma, luma < 0.22 as low_light, case when luma < 0.22 then 0.5e0 else 1.0e0 end as weight from m")
def low_light_labels(spark, sf_dir):
    """Which images are dark, and what they count."""
    return C.low_light(_images(spark, sf_dir))[1].withColumn("mean_luma", F.round("mean_luma", 6))


@register("low_light_images", _DARK_SQL + """,
  l as materialized (select frame, row, col, floor(255 * pow(least(greatest(round(v), 0), 255) / 255, 0.6e0)) as v from p join m using (frame) where luma < 0.22 and frame % 2 = 0),
  d as materialized (select a.frame, a.row, a.col, o.i, o.j, b.v, (b.v - a.v) ** 2 as d from l a, (select i.i - 2 as i, j.j - 2 as j from range(5) i(i), range(5) j(j)) o join l b on b.frame = a.frame and b.row = a.row + o.i and b.col = a.col + o.j),
  s as (select x.frame, x.row, x.col, x.v, x.i, x.j, avg(y.d) as d from d x join d y on y.frame = x.frame and y.i = x.i and y.j = x.j and y.row between x.row - 1 and x.row + 1 and y.col between x.col - 1 and x.col + 1 group by all)
  select frame, row, col, round(sum(exp(-d / 36) * v) / sum(exp(-d / 36)), 5) as v from s group by all""")
def low_light_images(spark, sf_dir):
    """Dark images of even suppliers brightened and denoised."""
    images = _images(spark, sf_dir)
    dark = C.low_light(images, search=2)[1].where("low_light and frame % 2 = 0").select("frame")
    return C.low_light(images.join(dark, "frame"), search=2)[0].withColumn("v", F.round("v", 5))
