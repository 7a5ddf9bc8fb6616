"""Queries of recurrences and fits, most of which SQL can't express; tests hold them against plain versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.operators import anchoring, recurrences, stats
from skyloom.plans.catalog import register
from skyloom.plans.tables import FRAMES_SQL, POINTS_SQL, TELEMETRY_SQL, frames, points, rounded, spread, spread_sql, telemetry


def _track(spark, sf_dir):
    rows = telemetry(spark, sf_dir)
    return rows.groupBy("track", "t").agg(F.avg("value").alias("x"), F.avg(F.col("lat") * 1000).alias("y"), F.avg("yaw").alias("z"))


_TRACK_SQL = f"""(select *, row_number() over (partition by track order by t) as i from
    (select track, t, avg(value) as x, avg(lat * 1000) as y, avg(yaw) as z from {TELEMETRY_SQL} group by track, t))"""

_ENVELOPE_SQL = f"""with recursive p as {_TRACK_SQL},
    s as (select track, i, t, false as outlier, t as rt, x as rx, y as ry, z as rz, cast(null as double) as vx, cast(null as double) as vy, cast(null as double) as vz, cast(null as double) as since from p where i = 1
      union all select track, i, t, far or turned, case when moves then t else rt end, case when moves then x else rx end, case when moves then y else ry end, case when moves then z else rz end,
        case when moves then (x - rx) / dt else vx end, case when moves then (y - ry) / dt else vy end, case when moves then (z - rz) / dt else vz end, case when moves then t else since end from
      (select *, not far and not turned and dt >= 0.5 as moves from
       (select *, not far and dt >= 0.5 and since is not null and sqrt(((x - rx) / dt - vx) ** 2 + ((y - ry) / dt - vy) ** 2 + ((z - rz) / dt - vz) ** 2) * dt > 0.001 * greatest(t - since, 0.5) * dt + 0.4 as turned from
        (select *, dt <= 0 or sqrt((x - rx) ** 2 + (y - ry) ** 2 + (z - rz) ** 2) > 0.01 * dt + 0.2 as far from
         (select p.*, p.t - s.rt as dt, s.rt, s.rx, s.ry, s.rz, s.vx, s.vy, s.vz, s.since from s join p on p.track = s.track and p.i = s.i + 1)))))
    select track, t, outlier from s"""


@register("envelope_fold", _ENVELOPE_SQL)
def envelope_fold(spark, sf_dir):
    """Fixes beyond the motion envelope of the last accepted one."""
    return recurrences.envelope_outliers(_track(spark, sf_dir), ["track"], "t", ["x", "y", "z"], 0.01, 0.001)


_KALMAN_SQL = f"""with recursive p as {_TRACK_SQL}, n as (select track, count(*) as n from p group by track),
    a as (select track, i, t, unnest(['x', 'y', 'z']) as axis, unnest([x, y, z]) as m, unnest([50.0e0, 50.0e0, 80.0e0]) as r from p),
    v as (select y.track, y.axis, (y.m - x.m) / (y.t - x.t) as v from a x join a y on x.track = y.track and x.axis = y.axis and x.i = 1 and y.i = 2),
    f as (select a.track, a.axis, 1::bigint as i, a.t, m as px, coalesce(v, 0) as pv, 100.0e0 as pa, 0.0e0 as pb, 25.0e0 as pc,
        m as ux, coalesce(v, 0) as uv, 100 - 1e4 / (100 + r * r) as ua, 0.0e0 as ub, 25.0e0 as uc, 0.0e0 as dt from a left join v using (track, axis) where a.i = 1
      union all select track, axis, i, t, px, pv, pa, pb, pc, px + pa * g * (m - px), pv + pb * g * (m - px), pa - pa * pa * g, pb - pa * pb * g, pc - pb * pb * g, dt from
      (select *, 1 / (pa + r * r) as g from
       (select a.track, a.axis, a.i, a.t, a.m, a.r, a.t - f.t as dt, ux + (a.t - f.t) * uv as px, uv as pv, ua + (a.t - f.t) * (2 * ub + (a.t - f.t) * uc) + 1e-12 * (a.t - f.t) ** 4 / 4 as pa,
          ub + (a.t - f.t) * uc + 1e-12 * (a.t - f.t) ** 3 / 2 as pb, uc + 1e-12 * (a.t - f.t) ** 2 as pc from f join a on a.track = f.track and a.axis = f.axis and a.i = f.i + 1))),
    b as (select f.track, axis, i, t, ux as x, uv as v from f join n on n.track = f.track and n.n = f.i
      union all select track, axis, i, t, ux + (ua + dt * ub) * (pc * dx - pb * dv) / (pa * pc - pb * pb) + ub * (pa * dv - pb * dx) / (pa * pc - pb * pb),
        uv + (ub + dt * uc) * (pc * dx - pb * dv) / (pa * pc - pb * pb) + uc * (pa * dv - pb * dx) / (pa * pc - pb * pb) from
      (select f.track, f.axis, f.i, f.t, f.ux, f.uv, f.ua, f.ub, f.uc, q.dt, q.pa, q.pb, q.pc, b.x - q.px as dx, b.v - q.pv as dv
       from b join f q on q.track = b.track and q.axis = b.axis and q.i = b.i join f on f.track = b.track and f.axis = b.axis and f.i = b.i - 1))
    select track, round(t, 2) as t, round(max(x) filter (axis = 'x'), 2) as s_x, round(max(x) filter (axis = 'y'), 2) as s_y, round(max(x) filter (axis = 'z'), 2) as s_z from b group by track, t"""


@register("kalman_rts", _KALMAN_SQL)
def kalman_rts(spark, sf_dir):
    """Smoothed tracks."""
    return rounded(recurrences.kalman_smooth(_track(spark, sf_dir), ["track"], "t", ["x", "y", "z"], 1e-6, [50.0, 50.0, 80.0]), 2)


@register("complementary_filter", f"""with recursive p as {_TRACK_SQL}, d as (select track, median(x - z) as datum, count(*) as n from p group by track),
    s as (select p.track, i, t, z, z + datum as e from p join d using (track) where i = 1
      union all select p.track, p.i, p.t, p.z, 0.98 * (s.e + p.z - s.z) + (1 - 0.98) * p.x from s join p on p.track = s.track and p.i = s.i + 1)
    select p.track, p.t, round(case when n < 3 then x else e end, 6) as altitude from p join d using (track) join s on s.track = p.track and s.i = p.i""")
def complementary_filter(spark, sf_dir):
    """Fused altitude of each track."""
    return rounded(recurrences.fuse_altitude(_track(spark, sf_dir), ["track"], "t", "x", "z", 0.98))


@register("ransac_scale_shift", f"""with p as materialized (select class, x, z, point_id from {POINTS_SQL}), n as (select class, greatest(1, least(40, count(*) // 2)) as m from p group by class),
    d as (select class, x, z, m, t, md5(class || ':' || point_id || ':' || t) as h from (select p.*, m, unnest(range(ceil(40 / m)::bigint)) as t from p join n using (class))),
    e as (select class, t * m + ('0x' || substr(h, 1, 6))::int % m as k, arg_min(x, h) as x1, arg_min(z, h) as z1, arg_max(x, h) as x2, arg_max(z, h) as z2 from d group by all),
    l as (select class, k, (z2 - z1) / (x2 - x1) as s, z1 - (z2 - z1) / (x2 - x1) * x1 as t from e where x1 <> x2 and (z2 - z1) / (x2 - x1) > 0),
    c as (select class, k, s, t, count(*) as n from l join p using (class) where abs(s * x + t - z) < 8 group by all), b as (select class, s, t from (select *, row_number() over (partition by class order by n desc, k) as place from c) where place = 1)
    select class, round(regr_slope(z, x), 5) as scale, round(regr_intercept(z, x), 5) as shift, count(*) as inliers from p join b using (class) where abs(s * x + t - z) < 8 group by class""")
def ransac_scale_shift(spark, sf_dir):
    """Robust line of each class."""
    found = anchoring.consensus_lines(points(spark, sf_dir), "class", "x", "z", F.lit(8.0), ["point_id"], 40)
    return found.withColumns({c: F.round(c, 5) for c in ("scale", "shift")})


@register("umeyama_fit", f"""select class, count(*) as n, 2.0e0 as scale, {spread_sql("rotation", [0, 1, 0, -1, 0, 0, 0, 0, 1])}, {spread_sql("shift", [1, 5, -3])} from {POINTS_SQL} group by class""")
def umeyama_fit(spark, sf_dir):
    """Similarity from source to moved points."""
    p = points(spark, sf_dir).withColumns({"u": 2 * F.col("y") + 1, "v": -2 * F.col("x") + 5, "w": 2 * F.col("z") - 3})
    found = recurrences.similarity(p, ["class"], ["x", "y", "z"], ["u", "v", "w"])
    return spread(found.withColumn("scale", F.round("scale", 6)), {"rotation": 9, "shift": 3}, 5)


@register("phase_shift")
def phase_shift(spark, sf_dir):
    """Shift between two surfaces of each class."""
    p = points(spark, sf_dir).groupBy("class", F.floor("y").cast("long").alias("row"), F.floor("x").cast("long").alias("col")).agg(F.avg("z").alias("a"), F.avg(F.col("weight")).alias("b"))
    return rounded(recurrences.phase_shift(p, "class", "row", "col", "a", "b"), 5)


@register("frame_selection", f"""with recursive p as (select video, frame, sum(overlap * 0.2) over (partition by video order by frame) as m, sharpness * case when status = 'F' then 1.15 else 1 end as s,
      row_number() over (partition by video order by frame) as i from {FRAMES_SQL}),
    k as (select video, i, m, cast(null as double) as overlap from p where i = 1
      union all select video, i, m, greatest(0, 1 - (m - last)) from
      (select *, row_number() over (partition by video order by s desc, i) as first from
       (select p.video, p.i, p.m, p.s, k.m as last, min(p.i) filter (p.m > k.m + 1 - 0.7) over (partition by p.video) as reach from k join p on p.video = k.video and p.i > k.i) where i between reach - 2 and reach) where first = 1)
    select p.video, p.frame, k.i is not null as selected, round(k.overlap, 6) as overlap from p left join k on k.video = p.video and k.i = p.i""")
def frame_selection(spark, sf_dir):
    """Overlap-targeted frames of each series."""
    from pyspark.sql.window import Window

    travel = F.sum(F.col("overlap") * 0.2).over(Window.partitionBy("video").orderBy("frame"))
    rows = frames(spark, sf_dir).withColumn("travel", travel).withColumn("key", F.col("status") == "F")
    return rounded(recurrences.select_frames(rows, ["video"], "frame", "travel", "sharpness", "key"))


def _probe_sql(probes: int = 4) -> str:
    """Each recursion keeps one frame: ``probes`` joins look ahead, each as far as the one before it says."""
    after = lambda s, o: f"""case when {o} is null then nullif(greatest(1, {s} // 2), {s}) when abs({o} - 0.7e0) <= 0.05e0 then null
        else nullif(floor(least(greatest({s} * (1 - 0.7e0) / greatest(1 - {o}, 1e-3), 1), least(5, greatest(stride * 2, stride + 1))) + 0.5)::bigint, {s}) end"""  # noqa: E731
    seen = lambda n: f"case when p.ok and 1 - (p.m - x.m) >= 0.3 then greatest(0, 1 - (p.m - x.m)) end as o{n}, p.i is not null as t{n}"
    x = "(select k.video, k.i, k.m, k.stride, n, stride as s1, least(least(greatest(stride, 1), 5), n - k.i) as w1 from k join sizes using (video) where k.i + 1 <= n)"
    for k in range(1, probes + 1):
        x = f"(select x.*, {seen(k)} from {x} x left join p on p.video = x.video and p.i = x.i + x.w{k})"
        if k < probes:
            x = f"(select *, case when t{k} then {after(f's{k}', f'o{k}')} end as s{k + 1} from {x})"
            w = f"least(least(greatest(s{k + 1}, 1), 5), n - i)"
            again = " or ".join(f"{w} = w{j}" for j in range(1, k + 1))
            x = f"(select *, case when s{k + 1} is not null and not ({again}) then {w} end as w{k + 1} from {x})"
    # none confirmed: the shortest stride, unless it was tried
    ws, os = [f"w{k}" for k in range(1, probes + 1)], [f"o{k}" for k in range(1, probes + 1)]
    x = f"(select *, case when coalesce({', '.join(os)}) is null and not coalesce({' or '.join(f'coalesce({w} = 1, false)' for w in ws)}, false) then 1 end as w{probes + 1} from {x})"
    x = f"(select x.*, {seen(probes + 1)} from {x} x left join p on p.video = x.video and p.i = x.i + x.w{probes + 1})"
    options = ", ".join(f"{{'d': coalesce(abs(o{k} - 0.7e0), 9), 'k': case when o{k} is null then -{k} else {k} end, 'w': w{k}, 'o': o{k}}}" for k in range(1, probes + 2))
    x = f"(select video, i, list_min(list_filter([{options}], lambda c: c.w is not null)) as c from {x})"
    return f"""with recursive p as materialized (select video, frame, sum(overlap * 0.2) over (partition by video order by frame) as m, status <> 'P' as ok, row_number() over (partition by video order by frame) as i from {FRAMES_SQL}),
    sizes as (select video, count(*) as n from p group by video),
    k as (select video, i, m, 2::bigint as stride, cast(null as double) as overlap, 0::bigint as way from (select *, row_number() over (partition by video order by i) as first from p where ok) where first = 1
      union all select p.video, p.i, p.m, least(greatest(c.w, 1), 5), c.o, c.w from {x} y join p on p.video = y.video and p.i = y.i + y.c.w)
    select k.video, frame, round(k.overlap, 6) as overlap, way as stride from k join p on p.video = k.video and p.i = k.i"""


@register("stride_probe", _probe_sql())
def stride_probe(spark, sf_dir):
    """Frames found by probing ahead at corrected strides."""
    from pyspark.sql.window import Window

    travel = F.sum(F.col("overlap") * 0.2).over(Window.partitionBy("video").orderBy("frame"))
    rows = frames(spark, sf_dir).withColumn("travel", travel).withColumn("clear", F.col("status") != "P")
    search = recurrences.StrideSearch(0.7, 0.05, 1, 5, 2, 2.0, 4)
    return rounded(recurrences.probe_frames(rows, ["video"], "frame", "travel", "clear", search, least=0.3))


@register("exposure_chain", f"""with recursive p as (select video, frame, 0.9 + overlap / 5 as g, overlap - 0.5 as b, status <> 'P' as ok, row_number() over (partition by video order by frame) as i from {FRAMES_SQL}),
    s as (select video, frame, i, 0.0e0 as lg, 0.0e0 as cb, false as clamped, false as bias_clamped, false as rejected from p where i = 1
      union all select video, frame, i, least(greatest(asked, ln(0.5)), ln(2)), least(greatest(want, -40), 40), asked not between ln(0.5) and ln(2), want not between -40 and 40, not good from
      (select *, 0.98 * (lg + case when good then ln(g) else 0 end) as asked, 0.98 * (exp(lg) * case when good then b else 0 end + cb) as want from
       (select p.video, p.frame, p.i, p.g, p.b, p.ok and p.g between 0.5 and 2 as good, s.lg, s.cb from s join p on p.video = s.video and p.i = s.i + 1)))
    select video, frame, round(exp(lg), 6) as chain_gain, round(cb, 6) as chain_bias, clamped, bias_clamped, rejected from s""")
def exposure_chain(spark, sf_dir):
    """Exposure links composed along each series."""
    rows = frames(spark, sf_dir).select("video", "frame", (0.9 + F.col("overlap") / 5).alias("gain"), (F.col("overlap") - 0.5).alias("bias"), (F.col("status") != "P").alias("ok"))
    return rounded(recurrences.exposure_chain(rows, ["video"], "frame", "gain", "bias", "ok"))


@register("depth_anchor", f"""with r as (select class, z / x as r from {POINTS_SQL} where x > 0), s as (select class, median(r) as scale from r group by class)
    select class, round(any_value(scale), 6) as scale, round(100 * median(abs(r / scale - 1)), 6) as spread_pct from r join s using (class) group by class""")
def depth_anchor(spark, sf_dir):
    """Depth scale and spread."""
    return rounded(recurrences.depth_anchor(points(spark, sf_dir), "class", "x", "z"))


@register("stage_runtimes", f"""select priority, status, count(*) as runs, round(sum(sharpness), 2) as seconds, round(avg(case when overlap > 0.2 then overlap end), 6) as score,
    round(sum(sharpness) * 600 / count(*), 2) as projected from {FRAMES_SQL} group by priority, status""")
def stage_runtimes(spark, sf_dir):
    """Seconds, mean of scores that are there and projection for each stage."""
    made = frames(spark, sf_dir).groupBy("priority", "status").agg(
        F.count("*").alias("runs"), F.round(F.sum("sharpness"), 2).alias("seconds"), F.round(F.avg(F.when(F.col("overlap") > 0.2, F.col("overlap"))), 6).alias("score"), F.round(F.sum("sharpness") * 600 / F.count("*"), 2).alias("projected")
    )
    return made


@register("verdicts", f"""select video, case when max(case when overlap < 0.02 then 2 when overlap < 0.2 then 1 else 0 end) = 2 then 'BLOCKED'
    when max(case when overlap < 0.02 then 2 when overlap < 0.2 then 1 else 0 end) = 1 then 'READY_WITH_WARNINGS' else 'READY' end as verdict from {FRAMES_SQL} group by video""")
def verdicts(spark, sf_dir):
    """Verdict of each series from its checks."""
    from skyloom.functions.scalar import band

    return stats.verdict(frames(spark, sf_dir).withColumn("check", band("overlap", 0.2, 0.02)), ["video"], "check")
