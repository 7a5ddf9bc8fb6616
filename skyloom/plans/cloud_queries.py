"""Queries over point clouds and rasters."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.functions import scalar as S
from skyloom.operators import checks, cloud, raster, stats, windows
from skyloom.plans.catalog import register
from skyloom.plans.tables import POINTS_SQL, SMALL_CLOUD_SQL, points, rounded, small_cloud, table
from skyloom.session import materialise

P, E = POINTS_SQL, SMALL_CLOUD_SQL
XYZ = ["x", "y", "z"]
#: Cells of the stand-in raster: quantity by discount, z the median price.
GRID_SQL = f"(select cast(floor(y) as bigint) as row, cast(floor(x) as bigint) as col, median(z) as z, count(*) as n from {P} group by 1, 2)"


def grid(spark, sf_dir):
    return raster.rasterise(points(spark, sf_dir), "x", "y", 1.0, [F.median("z").alias("z"), F.count("*").alias("n")])


@register("voxel_aggregate", f"""select cast(floor(x / 0.5) as bigint) as c_x, cast(floor(y / 0.5) as bigint) as c_y, cast(floor(z / 0.5) as bigint) as c_z, count(*) as n,
    round(avg(x), 6) as m_x, round(avg(y), 6) as m_y, round(avg(z), 6) as m_z, round(avg(zone), 6) as confidence from {E} group by 1, 2, 3""")
def voxel_aggregate(spark, sf_dir):
    """Voxel counts, centroids and mean confidence."""
    return rounded(cloud.voxel_aggregate(small_cloud(spark, sf_dir), XYZ, 0.5, [F.avg("zone").alias("confidence")]))


@register("voxel_aggregate_large", f"""select cast(floor(x / 5.0e0) as bigint) as c_x, cast(floor(y / 5.0e0) as bigint) as c_y, cast(floor(z / 5.0e0) as bigint) as c_z, count(*) as n,
    round(avg(x), 6) as m_x, round(avg(y), 6) as m_y, round(avg(z), 6) as m_z from {P} group by 1, 2, 3""")
def voxel_aggregate_large(spark, sf_dir):
    """The same over the large cloud."""
    return rounded(cloud.voxel_aggregate(points(spark, sf_dir), XYZ, 5.0))


@register("multi_size_voxels", f"""select s as size, count(*) as cells from (select distinct s, floor(x / s), floor(y / s), floor(z / s) from {P} cross join (values (1.0e0), (2.0e0), (4.0e0), (8.0e0)) v(s)) group by s""")
def multi_size_voxels(spark, sf_dir):
    """Occupied cells at several sizes in one pass."""
    return cloud.occupied_cells(points(spark, sf_dir), XYZ, [1.0, 2.0, 4.0, 8.0])


@register("voxel_size", f"""with s as (select 0.5e0 * pow(1.5e0, k) as s from range(8) t(k)), c as (select s, count(*) as cells from (select distinct s, floor(x / s), floor(y / s), floor(z / s) from {P} cross join s) group by s)
    select round(coalesce(min(case when cells <= 2000 then s end), max(s)), 6) as size from c""")
def voxel_size(spark, sf_dir):
    """The first size with few enough occupied cells."""
    return rounded(cloud.choose_voxel_size(points(spark, sf_dir), XYZ, 0.5, 2000))


@register("distinct_view_pairs", f"select distinct voxel, view from {P}")
def distinct_view_pairs(spark, sf_dir):
    """Distinct (voxel, view) pairs."""
    return cloud.distinct_views(points(spark, sf_dir), "voxel", "view")


@register("zone_classify", f"""with v as (select voxel, count(distinct view) as views, avg(weight) as c from {P} group by voxel)
    select voxel, views, round(c, 6) as confidence, case when views >= 20 and c >= 0.04 then 1 when views >= 1 then 2 else 3 end as zone from v""")
def zone_classify(spark, sf_dir):
    """Zones of voxels."""
    return rounded(cloud.zones(points(spark, sf_dir), "voxel", "view", "weight", 20, 0.04))


@register("best_zone_per_cell", f"""select cast(floor(x / 5) as bigint) as c_x, cast(floor(y / 5) as bigint) as c_y, min(case class when 'A' then 1 when 'N' then 2 else 3 end) as zone, count(*) as n from {P} group by 1, 2""")
def best_zone_per_cell(spark, sf_dir):
    """Best zone of each ground cell."""
    zone = F.when(F.col("class") == "A", 1).when(F.col("class") == "N", 2).otherwise(3)
    return cloud.best_zone_per_cell(cloud.cells(points(spark, sf_dir).withColumn("zone", zone), ["x", "y"], 5.0), ["c_x", "c_y"], "zone")


@register("widest_ray_angle", f"""with l as (select *, sqrt(x * x + y * y + z * z) as len from {E}), u as (select zone, point_id, x / len as x, y / len as y, z / len as z from l where len > 0),
    m as (select zone, avg(x) as mx, avg(y) as my, avg(z) as mz, count(*) as n from u group by zone),
    d as (select u.*, n, row_number() over (partition by zone order by round(x * mx + y * my + z * mz, 12), point_id) as k from u join m using (zone)),
    f as (select zone, n, x as fx, y as fy, z as fz from d where k = 1)
    select zone, any_value(n) as n, round(degrees(acos(least(greatest(min(x * fx + y * fy + z * fz), -1), 1))), 4) as angle from u join f using (zone) group by zone""")
def widest_ray_angle(spark, sf_dir):
    """Widest ray angle by the two-pass estimate."""
    return rounded(cloud.widest_angle(small_cloud(spark, sf_dir), "zone", "point_id", XYZ), 4)


@register("photometric_consistency", f"""select voxel, count(weight) as n, round(case when count(weight) >= 2 then greatest(0, least(1, 1 - stddev_pop(weight) / 0.05)) end, 6) as consistency from {P} group by voxel""")
def photometric_consistency(spark, sf_dir):
    """Photometric consistency of each voxel."""
    return rounded(cloud.photometric(points(spark, sf_dir), "voxel", "weight", 0.05))


@register("visibility_zbuffer", f"""with p as (select point_id, view, cast(floor(x / 2) as bigint) as u, cast(floor(y / 2) as bigint) as v, z from {P}),
    b as (select view, u, v, min(z) as z from p group by 1, 2, 3), o as (select unnest([-1, 0, 1]) as k),
    m as (select view, b.u + i.k as u, b.v + j.k as v, min(z) as zb from b cross join o i cross join o j group by 1, 2, 3)
    select point_id, view, u, v from p join m using (view, u, v) where z <= zb + 5""")
def visibility_zbuffer(spark, sf_dir):
    """What each camera sees, by a z-buffer with a 3 x 3 minimum."""
    rows = points(spark, sf_dir).select("point_id", "view", F.floor(F.col("x") / 2).cast("long").alias("u"), F.floor(F.col("y") / 2).cast("long").alias("v"), "z")
    return cloud.visible(rows, "view", "u", "v", "z", 5.0).select("point_id", "view", "u", "v")


@register("dsm_median", f"select row, col, round(z, 6) as z, n from {GRID_SQL}")
def dsm_median(spark, sf_dir):
    """Median surface."""
    return rounded(grid(spark, sf_dir))


@register("low_percentile_cell", f"""with r as (select cast(floor(y) as bigint) as row, cast(floor(x) as bigint) as col, z, row_number() over (partition by floor(y), floor(x) order by z) - 1 as k, count(*) over (partition by floor(y), floor(x)) as n from {P})
    select row, col, n, z from r where k = floor(0.1e0 * (n - 1))""")
def low_percentile_cell(spark, sf_dir):
    """Nearest-rank low percentile of each cell."""
    rows = points(spark, sf_dir).select(F.floor("y").cast("long").alias("row"), F.floor("x").cast("long").alias("col"), "z")
    return raster.low_percentile(rows, ["row", "col"], "z", 0.1)


@register("nearest_within_radius", f"""with p as (select a.point_id, b.point_id as other, sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2)) as d from {E} a join {E} b on a.point_id <> b.point_id),
    m as (select point_id, other, d, row_number() over (partition by point_id order by d, other) as k from p where d <= 0.15)
    select e.point_id, other as nearest, round(d, 6) as distance from {E} e left join (select * from m where k = 1) m using (point_id)""")
def nearest_within_radius(spark, sf_dir):
    """Nearest neighbour within a radius."""
    c = small_cloud(spark, sf_dir)
    return rounded(cloud.nearest_within(c, c, "point_id", "point_id", XYZ, 0.15, exclude_self=True))


@register("cloud_to_cloud", f"""with a as (select * from {E} where point_id % 2 = 0), b as (select * from {E} where point_id % 2 = 1),
    m as (select a.point_id, min(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2))) as d from a left join b on pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2) <= 0.04 group by 1)
    select count(*) as n, round(100 * avg(case when d is not null then 1.0e0 else 0 end), 6) as matched_pct, round(median(d), 6) as median, round(sqrt(avg(d * d)), 6) as rms from m""")
def cloud_to_cloud(spark, sf_dir):
    """Matched share and distances of two clouds."""
    c = small_cloud(spark, sf_dir)
    return rounded(cloud.cloud_to_cloud(c.where("point_id % 2 = 0"), c.where("point_id % 2 = 1"), "point_id", "point_id", XYZ, 0.2))


@register("knn_spacing", f"""with p as (select a.point_id, b.point_id as other, sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2) + pow(a.z - b.z, 2)) as d from {E} a join {E} b on a.point_id <> b.point_id),
    m as (select *, row_number() over (partition by point_id order by d, other) as k from p where d <= 0.2) select point_id, round(d, 6) as distance from m where k = 2""")
def knn_spacing(spark, sf_dir):
    """Spacing by the second neighbour."""
    return rounded(cloud.knn_spacing(small_cloud(spark, sf_dir), "point_id", XYZ, 0.2, 2))


@register("near_camera", f"""with c as (select s_suppkey as cam, s_acctbal / 10000 as x, (s_suppkey % 7) / 7.0e0 - 0.5 as y, (s_suppkey % 5) / 5.0e0 - 0.5 as z from supplier)
    select point_id, round(min(sqrt(pow(e.x - c.x, 2) + pow(e.y - c.y, 2) + pow(e.z - c.z, 2))), 6) as distance from {E} e join c on sqrt(pow(e.x - c.x, 2) + pow(e.y - c.y, 2) + pow(e.z - c.z, 2)) <= 0.3 group by point_id""")
def near_camera(spark, sf_dir):
    """Points too near to a camera."""
    k = F.col("s_suppkey")
    cams = table(spark, sf_dir, "supplier").select(k.alias("cam"), (F.col("s_acctbal") / 10000).alias("x"), (k % 7 / 7.0 - 0.5).alias("y"), (k % 5 / 5.0 - 0.5).alias("z"))
    return rounded(cloud.near_camera(small_cloud(spark, sf_dir), cams, "point_id", "cam", XYZ, 0.3))


@register("bilinear_sample", f"""with g as {GRID_SQL}, s as (select point_id, x + 0.25 as x, y * 0.9 as y from {P}),
    k as (select *, floor(x) as c0, floor(y) as r0, x - floor(x) as fx, y - floor(y) as fy from s)
    select k.point_id, round(a.z * (1 - fx) * (1 - fy) + b.z * fx * (1 - fy) + c.z * (1 - fx) * fy + d.z * fx * fy, 10) as z from k
      left join g a on a.row = r0 and a.col = c0 left join g b on b.row = r0 and b.col = c0 + 1 left join g c on c.row = r0 + 1 and c.col = c0 left join g d on d.row = r0 + 1 and d.col = c0 + 1""")
def bilinear_sample(spark, sf_dir):
    """Bilinear surface value at every point."""
    samples = points(spark, sf_dir).select("point_id", (F.col("x") + 0.25).alias("x"), (F.col("y") * 0.9).alias("y"))
    return rounded(raster.bilinear(samples, "point_id", grid(spark, sf_dir), "x", "y"), 10)


@register("tile_offsets", f"""with g as {GRID_SQL}, o as (select unnest(range(-2, 3)) as d),
    m as (select floor(row / 5) as tile_row, floor(col / 10) as tr2, row, col, z from g),
    s as (select cast(floor(g.row / 6) as bigint) as tile_row, cast(floor(g.col / 6) as bigint) as tile_col, i.d as dr, j.d as dc, g.z as a, h.n as b from g cross join o i cross join o j join g h on h.row = g.row + i.d and h.col = g.col + j.d)
    select tile_row, tile_col, dr, dc, count(*) as n, round(corr(a, b), 5) as score from s group by 1, 2, 3, 4 having count(*) >= 12""")
def tile_offsets(spark, sf_dir):
    """Correlation of tiles at each shift."""
    g = grid(spark, sf_dir)
    found = raster.shift_scores(g.select("row", "col", "z"), g.select("row", "col", F.col("n").cast("double").alias("z")), 6, 2, 12)
    return rounded(found.withColumns({c: F.col(c).cast("long") for c in ("dr", "dc")}), 5)


@register("tile_medians", f"""select cast(floor(x / 10) as bigint) as tile_x, cast(floor(y / 5) as bigint) as tile_y, count(*) as n, round(median(z), 6) as median, round(quantile_cont(z, 0.9), 6) as p90 from {P} group by 1, 2""")
def tile_medians(spark, sf_dir):
    """Offsets of each tile."""
    rows = points(spark, sf_dir).withColumns({"tile_x": F.floor(F.col("x") / 10).cast("long"), "tile_y": F.floor(F.col("y") / 5).cast("long")})
    return rounded(rows.groupBy("tile_x", "tile_y").agg(F.count("*").alias("n"), F.median("z").alias("median"), F.percentile("z", 0.9).alias("p90")))


@register("tile_range_join", f"""with t as (select p_partkey as tile, p_size as x0, p_size + 3 as x1, p_retailprice / 100 as shift from part)
    select tile, count(*) as n, round(avg(z - shift), 8) as mean from {P} p join t on p.x >= x0 and p.x < x1 and p.voxel = tile group by tile""")
def tile_range_join(spark, sf_dir):
    """Points within a tile's range, shifted by the tile."""
    tiles = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("tile"), F.col("p_size").alias("x0"), (F.col("p_size") + 3).alias("x1"), (F.col("p_retailprice") / 100).alias("shift"))
    p = points(spark, sf_dir)
    rows = p.join(tiles, (p["voxel"] == tiles["tile"]) & (F.col("x") >= F.col("x0")) & (F.col("x") < F.col("x1")))
    return rounded(rows.groupBy("tile").agg(F.count("*").alias("n"), F.avg(F.col("z") - F.col("shift")).alias("mean")), 8)


@register("weighted_fusion", f"""with o as (select voxel from {P} where class = 'A' and weight > 0.07 group by voxel having count(*) >= 4),
    f as (select voxel, sum(cast(weight as decimal(12, 6))) as w, count(distinct view) as frames, sum(cast(cast(weight as decimal(12, 6)) * cast(x as decimal(12, 6)) as decimal(24, 12))) as x,
      sum(cast(cast(weight as decimal(12, 6)) * cast(z as decimal(12, 6)) as decimal(24, 12))) as z from {P} where voxel not in (select voxel from o) group by voxel)
    select voxel, cast(least(w, 2) as double) as w, frames, cast(x as double) / cast(w as double) as x, cast(z as double) / cast(w as double) as z from f where w >= 0.5""")
def weighted_fusion(spark, sf_dir):
    """Weighted fusion outside zone 1; sums are decimals, so that no order of rows shows."""
    p = points(spark, sf_dir)
    zone1 = p.where("class = 'A' and weight > 0.07").groupBy("voxel").agg(F.count("*").alias("n")).where("n >= 4").select("voxel")
    return cloud.weighted_fusion(p, "voxel", "view", "weight", ["x", "z"], 0.5, 2.0, zone1)


@register("error_stats_by_group", f"""with d as (select unnest([class, source, case when class = 'A' and source = 'F' then 'AF' end, 'all']) as grp, z - 35 as d from {P}), e as (select * from d where grp is not null),
    m as (select grp, median(d) as med from e group by grp)
    select grp, count(*) as n, round(avg(d), 6) as mean, round(any_value(med), 6) as median, round(sqrt(avg(d * d)), 6) as rms, round(quantile_cont(abs(d), 0.95), 6) as p95, round(1.4826 * median(abs(d - med)), 6) as nmad from e join m using (grp) group by grp""")
def error_stats_by_group(spark, sf_dir):
    """Error statistics of overlapping groups."""
    both = F.when((F.col("class") == "A") & (F.col("source") == "F"), "AF")
    return rounded(stats.grouped_error_stats(points(spark, sf_dir).withColumn("d", F.col("z") - 35), [F.col("class"), F.col("source"), both, F.lit("all")], "d"))


def _doming_sql() -> str:
    terms = {"c": "1.0e0", "x": "x", "y": "y", "q": "(x * x + y * y)"}
    names = list(terms)
    sums = [f"sum({terms[a]} * {terms[b]}) as {a}{b}" for i, a in enumerate(names) for b in names[i:]] + [f"sum({terms[a]} * z) as {a}z" for a in names]
    m = [[a + b if names.index(a) <= names.index(b) else b + a for b in names] for a in names]

    def det(rows: list[list[str]]) -> str:
        if len(rows) == 1:
            return rows[0][0]
        return "(" + " ".join(f"{'+' if j % 2 == 0 else '-'} {v} * {det([r[:j] + r[j + 1 :] for r in rows[1:]])}" for j, v in enumerate(rows[0])) + ")"

    out = ", ".join(f"round({det([[names[i] + 'z' if k == j else m[i][k] for k in range(4)] for i in range(4)])} / {det(m)}, 4) as {n}" for j, n in enumerate(("offset", "tilt_x", "tilt_y", "dome")))
    return f"select class, n, {out} from (select class, count(*) as n, {', '.join(sums)} from {P} group by class)"


@register("doming_fit", _doming_sql())
def doming_fit(spark, sf_dir):
    """Plane and dome of each class."""
    return rounded(stats.doming(points(spark, sf_dir), ["class"], "x", "y", "z"), 4)


@register("strip_pairs", """with s as (select s_suppkey as strip, s_acctbal % 180 as heading, s_acctbal as offset_m from supplier)
    select a.strip as i, b.strip as j, round(abs(a.offset_m - b.offset_m), 4) as spacing from s a join s b on a.strip < b.strip
      where least(abs(a.heading - b.heading), 180 - abs(a.heading - b.heading)) <= 10 and abs(a.offset_m - b.offset_m) between 20 and 800""")
def strip_pairs(spark, sf_dir):
    """Near-parallel strips at a lateral spacing; buckets of spacing and of heading make it an equi-join of many keys."""
    b = F.col("s_acctbal")
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("strip"), F.signum(b).alias("sg"), (b % 180).alias("heading"), b.alias("offset_m"), F.floor(b / 800).alias("bucket"), F.floor(b % 180 / 10).alias("slot"))
    # headings lie between -180 and 180; those that differ by 170 or more count as parallel, too
    slots = F.filter(F.sequence(F.lit(-18).cast("long"), F.lit(17).cast("long")), lambda k: (F.abs(k - F.col("slot")) <= 1) | (F.abs(k - F.col("slot")) >= 16))
    near = s.withColumn("bucket", F.explode(F.array(*(F.col("bucket") + k for k in (-1, 0, 1))))).withColumn("slot", F.explode(slots))
    x, y = s.alias("x"), near.alias("y")
    turn = F.abs(F.col("x.heading") - F.col("y.heading"))
    space = F.abs(F.col("x.offset_m") - F.col("y.offset_m"))
    pairs = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.slot") == F.col("y.slot")) & (F.col("x.strip") < F.col("y.strip")) & (F.least(turn, 180 - turn) <= 10) & space.between(20, 800))
    return rounded(pairs.select(F.col("x.strip").alias("i"), F.col("y.strip").alias("j"), space.alias("spacing")), 4)


@register("camera_table_match", """with c as (select n_name, length(n_name) as len, n_nationkey as pos from nation), m as (select c_custkey, n_name, row_number() over (partition by c_custkey order by len desc, pos) as k
      from customer join c on contains(lower(c_mktsegment || ' ' || (select n_name from nation where n_nationkey = c_nationkey)), lower(n_name)))
    select c_custkey, n_name as camera from m where k = 1""")
def camera_table_match(spark, sf_dir):
    """The longest name of a table that a text contains; the first listed wins ties."""
    names = table(spark, sf_dir, "nation").select("n_name", F.col("n_nationkey").alias("pos"))
    text = table(spark, sf_dir, "customer").join(names.select(F.col("pos").alias("c_nationkey"), F.col("n_name").alias("own")), "c_nationkey")
    found = checks.contained_names(text.select("c_custkey", F.concat_ws(" ", "c_mktsegment", "own").alias("blob")), "blob", names, "n_name")
    return windows.last_per_key(found.select("c_custkey", "n_name", "pos"), ["c_custkey"], [-F.length("n_name"), F.col("pos")]).select("c_custkey", F.col("n_name").alias("camera"))


@register("footprint_area", f"""select zone, count(distinct (floor(x / 0.1), floor(y / 0.1))) as cells, round(count(distinct (floor(x / 0.1), floor(y / 0.1))) * 0.01, 6) as area from {E} group by zone""")
def footprint_area(spark, sf_dir):
    """Footprint as distinct cells."""
    made = small_cloud(spark, sf_dir).groupBy("zone").agg(F.countDistinct(F.floor(F.col("x") / 0.1), F.floor(F.col("y") / 0.1)).alias("cells"))
    return rounded(made.withColumn("area", F.col("cells") * 0.01))


@register("coverage_pct", f"""with s as (select distinct cast(floor(y) as bigint) as row, cast(floor(x) as bigint) as col from {P}), c as (select distinct cast(floor(y) as bigint) as row, cast(floor(x) as bigint) as col from {P} where class = 'A' and source = 'F' and weight > 0.07)
    select count(*) as seen, count(c.row) as covered, round(100.0e0 * count(c.row) / count(*), 6) as pct from s left join c on s.row = c.row and s.col = c.col""")
def coverage_pct(spark, sf_dir):
    """Share of seen cells that are covered."""
    cells = lambda df: df.select(F.floor("y").cast("long").alias("row"), F.floor("x").cast("long").alias("col"))
    p = points(spark, sf_dir)
    return rounded(raster.coverage(cells(p.where("class = 'A' and source = 'F' and weight > 0.07")), cells(p)))


_GAPS_SQL = f"(select distinct cast(floor(x / 0.05) as bigint) as col, cast(floor(y / 0.05) as bigint) as row from {E})"


@register("gap_components", f"""with recursive c as {_GAPS_SQL}, n as (select row * 4294967296 + col as id, row, col from c),
    e as (select a.id, b.id as other from n a join n b on abs(a.row - b.row) <= 1 and abs(a.col - b.col) <= 1),
    r(id, reach) as (select id, id from n union select r.id, e.other from r join e on e.id = r.reach)
    select n.row, n.col, min(r.reach) as label from r join n on n.id = r.id group by 1, 2""")
def gap_components(spark, sf_dir):
    """8-connected components of cells."""
    cells = small_cloud(spark, sf_dir).select(F.floor(F.col("y") / 0.05).cast("long").alias("row"), F.floor(F.col("x") / 0.05).cast("long").alias("col"))
    return raster.components(cells)


@register("dilated_mask", f"""with c as {_GAPS_SQL}, o as (select unnest([-1, 0, 1]) as k) select distinct row + i.k as row, col + j.k as col from c cross join o i cross join o j""")
def dilated_mask(spark, sf_dir):
    """Dilation of a mask."""
    cells = small_cloud(spark, sf_dir).select(F.floor(F.col("y") / 0.05).cast("long").alias("row"), F.floor(F.col("x") / 0.05).cast("long").alias("col"))
    return raster.dilate(cells)


@register("eroded_mask", f"""with c as (select distinct cast(floor(y) as bigint) as row, cast(floor(x) as bigint) as col from {P}), o as (select unnest([-1, 0, 1]) as k),
    v as (select row + i.k as row, col + j.k as col from c cross join o i cross join o j) select row, col from v group by 1, 2 having count(*) = 9""")
def eroded_mask(spark, sf_dir):
    """Erosion of a mask."""
    return raster.erode(points(spark, sf_dir).select(F.floor("y").cast("long").alias("row"), F.floor("x").cast("long").alias("col")))


@register("fill_near", f"""with g as (select row, col, z from {GRID_SQL} where (row * 7 + col) % 5 <> 0), w as (select row, col from {GRID_SQL}),
    m as (select w.row, w.col, g.z, row_number() over (partition by w.row, w.col order by pow(w.row - g.row, 2) + pow(w.col - g.col, 2), g.row, g.col) as k from w join g on pow(w.row - g.row, 2) + pow(w.col - g.col, 2) <= 4)
    select row, col, round(z, 6) as z from m where k = 1""")
def fill_near(spark, sf_dir):
    """Nearest valid value within a few cells."""
    g = grid(spark, sf_dir)
    return rounded(raster.fill_near(g.where("(row * 7 + col) % 5 <> 0"), g, 2).select("row", "col", "z"))


@register("ground_filter", f"""with g as (select row, col, z from {GRID_SQL}),
    a1 as (select row, col, z, min(z) over (partition by row order by col range between 1 preceding and 1 following) as o from g), a2 as (select row, col, z, min(o) over (partition by col order by row range between 1 preceding and 1 following) as o from a1),
    a3 as (select row, col, z, max(o) over (partition by row order by col range between 1 preceding and 1 following) as o from a2), a4 as (select row, col, z, max(o) over (partition by col order by row range between 1 preceding and 1 following) as o from a3),
    b0 as (select row, col, o as z, z - o <= 2.0 as ground from a4),
    b1 as (select row, col, z, ground, min(z) over (partition by row order by col range between 3 preceding and 3 following) as o from b0), b2 as (select row, col, z, ground, min(o) over (partition by col order by row range between 3 preceding and 3 following) as o from b1),
    b3 as (select row, col, z, ground, max(o) over (partition by row order by col range between 3 preceding and 3 following) as o from b2), b4 as (select row, col, z, ground, max(o) over (partition by col order by row range between 3 preceding and 3 following) as o from b3)
    select row, col, ground and z - o <= 0.15 * 4 + 2.0 as ground from b4""")
def ground_filter(spark, sf_dir):
    """Progressive morphological ground filter."""
    return raster.ground_cells(grid(spark, sf_dir).select("row", "col", "z"), [1, 3], 0.15, 2.0).select("row", "col", "ground")


@register("vertex_zone", f"""select vertex, max(zone) as zone from (select unnest([voxel, view, voxel + view]) as vertex, case class when 'A' then 1 when 'N' then 2 else 3 end as zone from {P}) group by vertex""")
def vertex_zone(spark, sf_dir):
    """Worst zone of each vertex over its faces."""
    zone = F.when(F.col("class") == "A", 1).when(F.col("class") == "N", 2).otherwise(3)
    rows = points(spark, sf_dir).select(F.explode(F.array("voxel", "view", F.col("voxel") + F.col("view"))).alias("vertex"), zone.alias("zone"))
    return rows.groupBy("vertex").agg(F.max("zone").alias("zone"))


@register("huber_weights", f"""select point_id, round(case when abs(z - 35) <= 10 then 1 else 10 / greatest(abs(z - 35), 1e-9) end, 6) as w from {P}""")
def huber_weights(spark, sf_dir):
    """Huber weights of residuals."""
    return rounded(points(spark, sf_dir).select("point_id", S.huber_weight(F.col("z") - 35, 10.0).alias("w")))


@register("tagged_union", f"""select point_id, 'measured' as source, z from {P} where class <> 'R' union all select point_id, 'fill', z * 0.9 from {P} where class = 'R'""")
def tagged_union(spark, sf_dir):
    """Union of measured and filled points with a source tag."""
    p = points(spark, sf_dir)
    fill = p.where("class = 'R'").select("point_id", F.lit("fill").alias("source"), (F.col("z") * 0.9).alias("z"))
    return p.where("class <> 'R'").select("point_id", F.lit("measured").alias("source"), "z").unionByName(fill)


@register("shared_voxels", f"""select voxel from {P} where class = 'A' intersect select voxel from {P} where class = 'R' and weight > 0.06""")
def shared_voxels(spark, sf_dir):
    """Names that two sets share."""
    p = points(spark, sf_dir)
    return p.where("class = 'A'").select("voxel").intersect(p.where("class = 'R' and weight > 0.06").select("voxel"))


@register("gsd", """select round(median(o_totalprice / nullif(o_custkey, 0)), 6) as gsd from orders""")
def gsd(spark, sf_dir):
    """Ground sample distance as a median of height over focal length."""
    ratio = table(spark, sf_dir, "orders").select((F.col("o_totalprice") / F.nullif(F.col("o_custkey"), F.lit(0))).alias("r"))
    return rounded(stats.quantiles(ratio, [], "r", [0.5]).select(F.col("q0").alias("gsd")))


_TERRAIN_SQL = f"""t as (select view % 9 as part, floor(y * 3)::bigint as row, floor(x * 0.7)::bigint as col, count(*) as n, round(max(z), 6) as top from {P} group by all),
    b as (select part, min(row) as r0, max(row) as r1, min(col) as c0, max(col) as c1 from t group by part),
    g as (select part, r.row, c.col from b, range(0, 64) r(row), range(0, 64) c(col) where r.row between r0 and r1 and c.col between c0 and c1),
    h as (select g.*, 5 + 0.25e0 * row - 0.5e0 * col + 0.125e0 * part as ground_z, coalesce(top, 0) as top, (row in (r0, r1) or col in (c0, c1) or coalesce(n, 0) % 3 > 0) as ground from g join b using (part) left join t using (part, row, col))"""


@register("linear_terrain", f"""with {_TERRAIN_SQL} select part, row, col, round(ground_z, 6) as terrain, true as linear, case when abs(case when ground then 0 else top / 50 - 1 end) <= 0.5 then 2 when case when ground then 0 else top / 50 - 1 end < -2 then 7 else 1 end as class from h""")
def linear_terrain(spark, sf_dir):
    """Terrain under cells that are not ground, on the triangles of those that are, and each cell's class by its height."""
    from skyloom.operators import terrain

    p = points(spark, sf_dir)
    t = p.groupBy((F.col("view") % 9).alias("part"), F.floor(F.col("y") * 3).cast("long").alias("row"), F.floor(F.col("x") * 0.7).cast("long").alias("col")).agg(F.count("*").alias("n"), F.round(F.max("z"), 6).alias("top"))
    t = materialise(t, "terrain-tops")
    b = t.groupBy("part").agg(F.min("row").alias("r0"), F.max("row").alias("r1"), F.min("col").alias("c0"), F.max("col").alias("c1"))
    g = b.withColumn("row", F.explode(F.sequence("r0", "r1"))).withColumn("col", F.explode(F.sequence("c0", "c1"))).join(t, ["part", "row", "col"], "left")
    rim = F.col("row").isin(F.col("r0"), F.col("r1")) | F.col("col").isin(F.col("c0"), F.col("c1"))
    plane = 5 + 0.25 * F.col("row") - 0.5 * F.col("col") + 0.125 * F.col("part")
    over = F.coalesce("top", F.lit(0.0)) / 50 - 1
    g = g.withColumn("on", rim | (F.coalesce("n", F.lit(0)) % 3 > 0)).withColumn("z", plane + F.when(F.col("on"), 0.0).otherwise(over))
    g = materialise(g.select("part", "row", "col", "z", "on"), "terrain-grid")
    found = terrain.linear_terrain(g, ["part"], "z", F.col("on"), tile=16)
    classes = terrain.ground_classes(g, found, ["part"], "z").select("part", "row", "col", "class")
    return found.withColumn("terrain", F.round("terrain", 6)).join(classes, ["part", "row", "col"])
