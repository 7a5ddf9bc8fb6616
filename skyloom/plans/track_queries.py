"""Queries over tracks and frame series."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.functions import scalar as S
from skyloom.operators import interp, stats, windows
from skyloom.plans.catalog import register
from skyloom.plans.tables import FRAMES_SQL, TELEMETRY_SQL, frames, rounded, telemetry

T = TELEMETRY_SQL


@register(
    "telemetry_input_check",
    f"""with s as (select *, (us - lag(us) over (partition by track order by us, event_id)) / 1e6 as step,
        lag(value) over (partition by track order by us, event_id) as pv from {T}),
    a as (select track, count(*) as n, (max(us) - min(us)) / 1e6 as duration, 1 / nullif(median(case when step > 0 then step end), 0) as rate,
        max(step) as max_gap, sum(case when abs(value - pv) > 400 then 1 else 0 end) as jumps, median(value) as med,
        bit_or(1 | (case when value > 250 then 4 else 0 end)) as flags from s group by track),
    d as (select s.track, median(abs(s.value - a.med)) * 1.4826 as nmad from s join a using (track) group by s.track),
    c as (select track, n, duration, rate, max_gap, jumps, nmad, flags,
        case when n >= 60 then 'PASS' when n >= 30 then 'WARN' else 'BLOCK' end as rows_status,
        case when max_gap is null then 'INFO' when max_gap <= 86400 * 2 then 'PASS' when max_gap <= 86400 * 5 then 'WARN' else 'BLOCK' end as gap_status,
        case when jumps <= 2 then 'PASS' when jumps <= 6 then 'WARN' else 'WARN' end as jump_status from a join d using (track))
    select track, n, round(duration, 6) as duration, round(rate, 6) as rate, round(max_gap, 6) as max_gap, cast(jumps as bigint) as jumps,
      round(nmad, 6) as nmad, cast(flags as bigint) as flags, rows_status, gap_status, jump_status,
      case when 'BLOCK' in (rows_status, gap_status, jump_status) then 'BLOCKED'
           when 'WARN' in (rows_status, gap_status, jump_status) then 'READY_WITH_WARNINGS' else 'READY' end as verdict from c""",
)
def telemetry_input_check(spark, sf_dir):
    """The input check of every track."""
    from pyspark.sql.window import Window

    rows = telemetry(spark, sf_dir)
    w = Window.partitionBy("track").orderBy("us", "event_id")
    rows = rows.withColumn("step", (F.col("us") - F.lag("us").over(w)) / 1000000).withColumn("pv", F.lag("value").over(w))
    rows = rows.withColumn("flags", S.validity_flags({"gps": F.lit(True), "alt_baro": F.col("value") > 250}))
    per = rows.groupBy("track").agg(
        F.count("*").alias("n"),
        ((F.max("us") - F.min("us")) / 1000000).alias("duration"),
        (1 / F.nullif(F.median(F.when(F.col("step") > 0, F.col("step"))), F.lit(0.0))).alias("rate"),
        F.max("step").alias("max_gap"),
        F.count_if(F.abs(F.col("value") - F.col("pv")) > 400).alias("jumps"),
        F.bit_or("flags").alias("flags"),
    )
    per = per.join(stats.nmad(telemetry(spark, sf_dir), ["track"], "value"), "track")
    per = per.withColumn("rows_status", S.band("n", 60, 30)).withColumn("gap_status", S.band("max_gap", 86400 * 2, 86400 * 5, False)).withColumn("jump_status", S.soft(S.band("jumps", 2, 6, False)))
    checks = per.select("track", F.explode(F.array("rows_status", "gap_status", "jump_status")).alias("status"))
    cols = ["track", "n", "duration", "rate", "max_gap", "jumps", "nmad", "flags", "rows_status", "gap_status", "jump_status", "verdict"]
    return rounded(per.join(stats.verdict(checks, ["track"], "status"), "track").select(*cols))


@register("validity_flags", f"""select event_id, cast((case when value > 100 then 1 else 0 end) | (case when value > 200 then 4 else 0 end)
    | (case when channel = 'click' then 8 else 0 end) | (event_id & 352) as bigint) as flags from {T}""")
def validity_flags(spark, sf_dir):
    """Validity bits with sticky bits."""
    v = F.col("value")
    return telemetry(spark, sf_dir).select("event_id", S.validity_flags({"gps": v > 100, "alt_baro": v > 200, "attitude": F.col("channel") == "click"}, F.col("event_id")).alias("flags"))


@register("telemetry_summary", f"""select track, count(*) as n, round(max(t) - min(t), 6) as duration, true as has_value, count(nullif(lat, 28.0)) > 0 as has_lat,
    round(min(value), 6) as min_value, round(min(lat), 6) as min_lat, round(max(value), 6) as max_value, round(max(lat), 6) as max_lat,
    (bit_or(event_id) & 32) <> 0 as rtk from {T} group by track""")
def telemetry_summary(spark, sf_dir):
    """Per-track summary."""
    return rounded(stats.telemetry_summary(telemetry(spark, sf_dir), ["track"], "t", ["value", "lat"], "event_id"))


@register("sample_rate", f"""with s as (select track, us, (us - lag(us) over (partition by track order by us)) / 1e6 as step from {T})
    select track, count(*) as n, round((max(us) - min(us)) / 1e6, 6) as duration, round(1 / nullif(median(case when step > 0 then step end), 0), 6) as rate,
      round(max(step), 6) as max_gap from s group by track""")
def sample_rate(spark, sf_dir):
    """Sample rate and largest gap."""
    return rounded(windows.sample_rate(telemetry(spark, sf_dir), ["track"], "us", 1e6))


@register("error_stats_by_type", f"""with d as (select channel, value - 245 as d from {T}), m as (select channel, median(d) as med from d group by channel)
    select channel, count(*) as n, round(avg(d), 6) as mean, round(any_value(med), 6) as median, round(sqrt(avg(d * d)), 6) as rms,
      round(quantile_cont(abs(d), 0.95), 6) as p95, round(1.4826 * median(abs(d - med)), 6) as nmad from d join m using (channel) group by channel""")
def error_stats_by_type(spark, sf_dir):
    """A1: signed error statistics."""
    return rounded(stats.error_stats(telemetry(spark, sf_dir).select("channel", (F.col("value") - 245).alias("d")), ["channel"], "d"))


@register("overlap_stats", f"""with r as (select *, row_number() over (partition by video order by taken, frame) as k from {FRAMES_SQL})
    select video, count(*) as n, round(avg(overlap), 6) as mean, round(median(overlap), 6) as median, round(quantile_cont(overlap, 0.1), 6) as p10,
      round(quantile_cont(overlap, 0.9), 6) as p90, count(*) filter (overlap < 0.5) as low from r where k > 1 group by video""")
def overlap_stats(spark, sf_dir):
    """A2: overlap statistics of each frame series."""
    return rounded(stats.overlap_stats(frames(spark, sf_dir), ["video"], ["taken", "frame"], "overlap", 0.5))


@register("overlap_series", f"""select video, frame, lag(frame) over w as previous, frame - lag(frame) over w as stride, round(overlap, 6) as overlap
    from {FRAMES_SQL} window w as (partition by video order by frame)""")
def overlap_series(spark, sf_dir):
    """Consecutive frames with their stride."""
    return rounded(windows.overlap_series(frames(spark, sf_dir), ["video"], "frame", "overlap"))


@register("robust_low_threshold", f"""with m as (select priority, median(sharpness) as med from {FRAMES_SQL} group by priority),
    s as (select f.priority, any_value(med) as med, coalesce(median(case when sharpness > med then sharpness - med end), 0) as spread from {FRAMES_SQL} f join m using (priority) group by f.priority)
    select priority, round(med, 6) as median, round(case when spread > 0 then med - 1.5 * 1.4826 * spread else med / 2 end, 6) as threshold from s""")
def robust_low_threshold(spark, sf_dir):
    """A3, A4: one-sided robust threshold."""
    return rounded(stats.robust_low_threshold(frames(spark, sf_dir), ["priority"], "sharpness", 1.5))


@register("rolling_median_outliers", f"""with m as (select track, event_id, value, median(value) over (partition by track order by us, event_id rows between 3 preceding and 3 following) as med from {T})
    select event_id, round(med, 6) as median, round(abs(value - med), 6) as residual, abs(value - med) > 150 as outlier from m""")
def rolling_median_outliers(spark, sf_dir):
    """Centred rolling median and its outliers."""
    return rounded(windows.median_outliers(telemetry(spark, sf_dir), ["track"], ["us", "event_id"], "value", 3, 150.0).select("event_id", "median", "residual", "outlier"))


@register("rolling_baseline_verdict", f"""with b as (select event_id, value, median(value) over w as med, count(value) over w as n from {T}
      window w as (partition by track order by us, event_id rows between 30 preceding and 1 preceding))
    select event_id, round(case when n >= 5 then med end, 6) as baseline,
      case when n < 5 then 'clean' when value < 0.2 * med then 'reject' when value < 0.5 * med then 'correct' else 'clean' end as verdict from b""")
def rolling_baseline_verdict(spark, sf_dir):
    """Verdict against a trailing baseline without the current row."""
    rows = windows.trailing_baseline(telemetry(spark, sf_dir), ["track"], ["us", "event_id"], "value", 30, 5)
    v, b = F.col("value"), F.col("baseline")
    verdict = F.when(b.isNull(), "clean").when(v < 0.2 * b, "reject").when(v < 0.5 * b, "correct").otherwise("clean")
    return rounded(rows.select("event_id", "baseline", verdict.alias("verdict")))


@register("forward_window_speed", f"""with n as (select track, us, value, first_value(us) over w as us2, first_value(value) over w as v2 from {T}
      window w as (partition by track order by us range between 3600000000 following and unbounded following))
    select track, us, round((v2 - value) / ((us2 - us) / 1e6), 9) as speed, coalesce(abs(v2 - value) / ((us2 - us) / 1e6) > 0.05, false) as jump from n""")
def forward_window_speed(spark, sf_dir):
    """Change over a forward time window and impossible jumps."""
    rows = windows.forward_row(telemetry(spark, sf_dir), ["track"], "us", ["value"], 3600000000)
    speed = (F.col("next_value") - F.col("value")) / ((F.col("next_us") - F.col("us")) / 1000000)
    return rounded(rows.select("track", "us", speed.alias("speed"), F.coalesce(F.abs(speed) > 0.05, F.lit(False)).alias("jump")), 9)


@register("recording_islands", f"""with r as (select *, value > 200 as f, row_number() over (partition by track order by us, event_id) as k from {T}),
    g as (select *, k - row_number() over (partition by track, f order by us, event_id) as g from r)
    select track, min(t) as start, max(t) as "end", count(*) as n from g where f group by track, g""")
def recording_islands(spark, sf_dir):
    """Runs of a true recording flag."""
    return windows.islands(telemetry(spark, sf_dir), ["track"], ["us", "event_id"], F.col("value") > 200, "t", "t").drop("island")


@register("recording_window", f"""with r as (select *, value > 200 as f, row_number() over (partition by track order by us, event_id) as k from {T}),
    g as (select *, k - row_number() over (partition by track, f order by us, event_id) as g from r),
    s as (select track, min(t) as a, max(t) as b, count(*) as n from g where f group by track, g),
    o as (select *, row_number() over (partition by track order by case when abs(b - a - 100000) <= 20000 then abs(b - a - 100000) end nulls last, b - a desc, a) as k from s)
    select track, a as start, b as "end", n from o where k = 1""")
def recording_window(spark, sf_dir):
    """The segment nearest the wanted duration, else the longest."""
    segments = windows.islands(telemetry(spark, sf_dir), ["track"], ["us", "event_id"], F.col("value") > 200, "t", "t").drop("island")
    return windows.choose_segment(segments, ["track"], 100000.0, 20000.0)


@register("rejection_runs", """with r as (select *, row_number() over (partition by conv_id order by turn) as k from conversations),
    g as (select *, k - row_number() over (partition by conv_id, role order by turn) as g from r)
    select conv_id, role, min(k) as first, max(k) as last, count(*) as n from g group by conv_id, role, g""")
def rejection_runs(spark, sf_dir):
    """Runs of equal values in order."""
    from skyloom.plans.tables import table

    return windows.value_runs(table(spark, sf_dir, "conversations"), ["conv_id"], ["turn"], "role")


@register("last_verdict_wins", f"""select track, channel, arg_max(value, event_id) as value, max(event_id) as event_id from {T} group by track, channel""")
def last_verdict_wins(spark, sf_dir):
    """The last row of each key."""
    rows = telemetry(spark, sf_dir).select("track", "channel", "value", "event_id")
    return windows.last_per_key(rows, ["track", "channel"], [-F.col("event_id")])


@register("rank_in_region", f"""select event_id, round(row_number() over (partition by channel order by value, event_id) / count(*) over (partition by channel), 6) as rank_share from {T}""")
def rank_in_region(spark, sf_dir):
    """Rank share within a region."""
    return rounded(windows.rank_share(telemetry(spark, sf_dir), ["channel"], "value", "event_id").select("event_id", "rank_share"))


@register("most_central_window", f"""with n as (select max(event_id) + 1 as n from {T}), s as (select distinct least(s, n - 50) as start from (select n, unnest(range(0, n - 50 + 25, 25)) as s from n)),
    r as (select event_id, start, abs(event_id - (start + 24.5e0)) as off from {T} join s on event_id >= start and event_id < start + 50)
    select event_id, arg_min(start, off * 100000000 + start) as start, min(off) as off from r group by event_id""")
def most_central_window(spark, sf_dir):
    """Half-overlapping windows; each frame belongs to the one it is most central to."""
    rows = telemetry(spark, sf_dir).select("event_id")
    rows = rows.crossJoin(F.broadcast(rows.agg((F.max("event_id") + 1).alias("n"))))
    return windows.central_window(rows, "event_id", F.col("n"), 50)


@register("interp_asof", f"""with p as (select track, t, value from {T} where event_id % 3 = 0 qualify row_number() over (partition by track, t order by event_id) = 1),
    q as (select distinct track, t from {T} where event_id % 7 = 0),
    a as (select q.track, q.t, p.t as t0, p.value as v0 from q asof left join p on q.track = p.track and q.t >= p.t),
    b as (select q.track, q.t, p.t as t1, p.value as v1 from q asof left join p on q.track = p.track and q.t <= p.t)
    select a.track, a.t, round(case when t0 is null or t1 is null then null when t0 = t1 then v0 else v0 + (v1 - v0) * (a.t - t0) / (t1 - t0) end, 6) as value,
      coalesce(t0 <> a.t, true) as interpolated from a join b on a.track = b.track and a.t = b.t""")
def interp_asof(spark, sf_dir):
    """Linear interpolation at target times, null outside the measured range."""
    rows = telemetry(spark, sf_dir)
    source = windows.last_per_key(rows.where("event_id % 3 = 0").select("track", "t", "value", "event_id"), ["track", "t"], [F.col("event_id")])
    return rounded(interp.at_times(source, rows.where("event_id % 7 = 0"), ["track"], "t", ["value"], lone_fills=False))


@register("interp_angle", f"""with p as (select track, t, yaw from {T} where event_id % 3 = 0 qualify row_number() over (partition by track, t order by event_id) = 1),
    q as (select distinct track, t from {T} where event_id % 7 = 0),
    a as (select q.track, q.t, p.t as t0, p.yaw as v0 from q asof left join p on q.track = p.track and q.t >= p.t),
    b as (select q.track, q.t, p.t as t1, p.yaw as v1 from q asof left join p on q.track = p.track and q.t <= p.t),
    c as (select a.track, a.t, t0, t1, case when t0 = t1 then 0 else (a.t - t0) / (t1 - t0) end as u, radians(v0) as r0, radians(v1) as r1 from a join b on a.track = b.track and a.t = b.t)
    select track, t, round(case when t0 is null or t1 is null then null else (degrees(atan2(sin(r0) + (sin(r1) - sin(r0)) * u, cos(r0) + (cos(r1) - cos(r0)) * u)) + 360) % 360 end, 4) as yaw,
      coalesce(t0 <> t, true) as interpolated from c""")
def interp_angle(spark, sf_dir):
    """Interpolation of angles on the unit circle."""
    rows = telemetry(spark, sf_dir)
    source = windows.last_per_key(rows.where("event_id % 3 = 0").select("track", "t", "yaw", "event_id"), ["track", "t"], [F.col("event_id")])
    found = interp.at_times(source, rows.where("event_id % 7 = 0"), ["track"], "t", [], ["yaw"], lone_fills=False)
    return found.withColumn("yaw", F.round("yaw", 4))


@register("gapfill_merge", f"""with f as (select track, t, event_id, case when value > 150 then value end as value from {T}),
    p as (select track, t, value from {T} where channel = 'click' qualify row_number() over (partition by track, t order by event_id) = 1),
    a as (select f.*, p.t as t0, p.value as v0 from f asof left join p on f.track = p.track and f.t >= p.t),
    b as (select f.event_id, p.t as t1, p.value as v1 from f asof left join p on f.track = p.track and f.t <= p.t)
    select event_id, round(coalesce(value, case when t0 is null or t1 is null then null when t0 = t1 then v0 else v0 + (v1 - v0) * (t - t0) / (t1 - t0) end,
      (select any_value(value) from p where p.track = a.track having count(*) = 1)), 6) as value from a join b using (event_id)""")
def gapfill_merge(spark, sf_dir):
    """The primary source wins, its gaps are filled from the interpolated other."""
    rows = telemetry(spark, sf_dir)
    first = rows.select("track", "t", "event_id", F.when(F.col("value") > 150, F.col("value")).alias("value"))
    second = windows.last_per_key(rows.where("channel = 'click'").select("track", "t", "value", "event_id"), ["track", "t"], [F.col("event_id")])
    return rounded(interp.fill_gaps(first, second, ["track"], "t", ["value"]).select("event_id", "value"))


@register("central_diff_speed", f"""with p as (select track, t, value from {T} qualify row_number() over (partition by track, t order by event_id) = 1),
    q as (select distinct track, t from {T} where event_id % 5 = 0), h as (select track, t, t - 1800 as u, 1 as s from q union all select track, t, t + 1800, 2 from q),
    a as (select h.*, p.t as t0, p.value as v0 from h asof left join p on h.track = p.track and h.u >= p.t),
    b as (select h.track, h.t, h.s, p.t as t1, p.value as v1 from h asof left join p on h.track = p.track and h.u <= p.t),
    v as (select a.track, a.t, a.s, case when t0 is null or t1 is null then null when t0 = t1 then v0 else v0 + (v1 - v0) * (u - t0) / (t1 - t0) end as v
      from a join b on a.track = b.track and a.t = b.t and a.s = b.s)
    select track, round(t, 3) as t, round((max(case when s = 2 then v end) - max(case when s = 1 then v end)) / 3600, 6) as speed from v group by track, t""")
def central_diff_speed(spark, sf_dir):
    """Central differences at arbitrary times."""
    rows = telemetry(spark, sf_dir)
    source = windows.last_per_key(rows.select("track", "t", "value", "event_id"), ["track", "t"], [F.col("event_id")])
    targets = rows.where("event_id % 5 = 0").select("track", "t").distinct()
    found = interp.central_speed(source, targets, ["track"], "t", "value", 1800.0)
    return found.select("track", F.round("t", 3).alias("t"), F.round("speed", 6).alias("speed"))


@register("clipped_corr", f"""with p as (select channel, value as x, lat * 1000 + lon as y from {T}),
    b as (select channel, quantile_cont(x, 0.05) as x0, quantile_cont(x, 0.95) as x1, quantile_cont(y, 0.05) as y0, quantile_cont(y, 0.95) as y1 from p group by channel),
    c as (select channel, least(greatest(x, x0), x1) as x, least(greatest(y, y0), y1) as y from p join b using (channel))
    select channel, count(*) as n, round(corr(x, y), 6) as r from c group by channel""")
def clipped_corr(spark, sf_dir):
    """Correlation of percentile-clipped pairs."""
    rows = telemetry(spark, sf_dir).select("channel", F.col("value").alias("x"), (F.col("lat") * 1000 + F.col("lon")).alias("y"))
    return rounded(stats.clipped_corr(rows, ["channel"], "x", "y"))


@register("lag_search", f"""with h as (select us // 3600000000 as hour, avg(value) as x, count(*) * 1.0e0 as y from {T} group by 1), l as (select unnest(range(-12, 13)) as lag),
    j as (select lag, h.x, g.y from h cross join l join h g on g.hour = h.hour + lag)
    select lag, count(*) as n, round(corr(x, y), 6) as r from j group by lag""")
def lag_search(spark, sf_dir):
    """Correlation of two series at each lag."""
    hours = telemetry(spark, sf_dir).groupBy(F.expr("us div 3600000000").alias("hour")).agg(F.avg("value").alias("x"), F.count("*").cast("double").alias("y"))
    return rounded(stats.lag_search(hours, hours, "hour", "x", "y", list(range(-12, 13))).withColumn("lag", F.col("lag").cast("long")))


@register("best_lag", f"""with h as (select us // 3600000000 as hour, avg(value) as x, count(*) * 1.0e0 as y from {T} group by 1), l as (select unnest(range(-12, 13)) as lag),
    j as (select lag, h.x, g.y from h cross join l join h g on g.hour = h.hour + lag), r as (select lag, corr(x, y) as r from j group by lag),
    b as (select lag, r from r order by r desc, lag limit 1)
    select b.lag, round(b.r, 6) as r, round(b.r - quantile_cont(r.r, 0.9), 6) as margin from r, b where abs(r.lag - b.lag) > 3 group by b.lag, b.r""")
def best_lag(spark, sf_dir):
    """The best lag and its margin over the far ones."""
    hours = telemetry(spark, sf_dir).groupBy(F.expr("us div 3600000000").alias("hour")).agg(F.avg("value").alias("x"), F.count("*").cast("double").alias("y"))
    found = stats.lag_search(hours, hours, "hour", "x", "y", list(range(-12, 13))).withColumn("lag", F.col("lag").cast("long"))
    return rounded(stats.best_lag(found, 3))


@register("track_length", f"""with s as (select track, sqrt(pow(lat * 1000 - lag(lat * 1000) over w, 2) + pow(lon * 1000 - lag(lon * 1000) over w, 2)) as s from {T} window w as (partition by track order by us, event_id))
    select track, round(coalesce(sum(s), 0), 6) as length from s group by track""")
def track_length(spark, sf_dir):
    """A10: length of each track."""
    rows = telemetry(spark, sf_dir).select("track", (F.col("us") * 100000 + F.col("event_id") % 100000).alias("k"), (F.col("lat") * 1000).alias("x"), (F.col("lon") * 1000).alias("y"))
    return rounded(stats.track_length(rows, ["track"], "k", ["x", "y"]))


@register("enu_track", f"""with o as (select track, arg_min(lat, event_id) as lat0, arg_min(lon, event_id) as lon0 from {T} group by track),
    c as (select event_id, lat, lon, lat0, lon0, value, 6378137.0e0 as a, (1 / 298.257223563e0) * (2 - 1 / 298.257223563e0) as e2 from {T} t join o using (track)),
    w as (select *, 1 - e2 * pow(sin(radians(lat0)), 2) as w from c)
    select event_id, round(radians(lon - lon0) * (a / sqrt(w) + 0) * cos(radians(lat0)), 4) as east, round(radians(lat - lat0) * (a * (1 - e2) / pow(w, 1.5)), 4) as north, round(value, 4) as up from w""")
def enu_track(spark, sf_dir):
    """M1: local metres about each track's first fix."""
    rows = telemetry(spark, sf_dir)
    first = rows.groupBy("track").agg(F.min_by("lat", "event_id").alias("lat0"), F.min_by("lon", "event_id").alias("lon0"))
    e, n, u = S.enu_wgs84("lat", "lon", "value", "lat0", "lon0", F.lit(0.0))
    return rounded(rows.join(first, "track").select("event_id", e.alias("east"), n.alias("north"), u.alias("up")), 4)


@register("haversine_steps", f"""with s as (select event_id, lat, lon, lag(lat) over w as lat0, lag(lon) over w as lon0 from {T} window w as (partition by track order by us, event_id))
    select event_id, round(2 * 6371000 * asin(sqrt(least(1, pow(sin(radians(lat - lat0) / 2), 2) + cos(radians(lat0)) * cos(radians(lat)) * pow(sin(radians(lon - lon0) / 2), 2)))), 4) as metres from s""")
def haversine_steps(spark, sf_dir):
    """M6: great-circle steps between consecutive fixes."""
    from pyspark.sql.window import Window

    w = Window.partitionBy("track").orderBy("us", "event_id")
    rows = telemetry(spark, sf_dir).withColumn("lat0", F.lag("lat").over(w)).withColumn("lon0", F.lag("lon").over(w))
    return rounded(rows.select("event_id", S.haversine("lat0", "lon0", "lat", "lon").alias("metres")), 4)


@register("geo_cells", f"""select event_id, cast(32600 + floor((lon + 180) / 6) % 60 + 1 as int) as epsg, cast(floor((lon + 180) / 360 * 4096) as int) as tile_x,
    cast(floor((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2 * 4096) as int) as tile_y from {T}""")
def geo_cells(spark, sf_dir):
    """UTM zone and web-map tile."""
    x, y = S.slippy_tile("lon", "lat", 12)
    return telemetry(spark, sf_dir).select("event_id", S.utm_epsg("lon", "lat").alias("epsg"), x.alias("tile_x"), y.alias("tile_y"))


def _utm_sql(lon: str, lat: str) -> str:
    """The table with easting ``e`` and northing ``n``, by the same series."""
    f, a = S.WGS84_F, S.WGS84_A
    n = f / (2 - f)
    radius, e = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64) * 0.9996, (f * (2 - f)) ** 0.5
    alpha = [n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240]
    east = " + ".join(["eta", *(f"{x!r} * cos({2 * k + 2} * xi) * sinh({2 * k + 2} * eta)" for k, x in enumerate(alpha))])
    north = " + ".join(["xi", *(f"{x!r} * sin({2 * k + 2} * xi) * cosh({2 * k + 2} * eta)" for k, x in enumerate(alpha))])
    return f"""(select *, 500000 + {radius!r} * ({east}) as e, {radius!r} * ({north}) + case when {lat} < 0 then 10000000 else 0 end as n from
      (select *, atan2(tt, cos(lam)) as xi, atanh(sin(lam) / sqrt(1 + tt * tt)) as eta from
       (select *, sinh(atanh(sin(radians({lat}))) - {e!r} * atanh({e!r} * sin(radians({lat})))) as tt, radians({lon} - ((floor(({lon} + 180) / 6) % 60 + 1) * 6 - 183)) as lam from {T})))"""


UTM_SQL = _utm_sql("lon", "lat")


@register("utm_coordinates", f"select event_id, round(e, 3) as east, round(n, 3) as north from {UTM_SQL}")
def utm_coordinates(spark, sf_dir):
    """M8: UTM easting and northing of every fix."""
    e, n = S.utm("lon", "lat")
    return telemetry(spark, sf_dir).select("event_id", F.round(e, 3).alias("east"), F.round(n, 3).alias("north"))


@register("regression_fit", f"""select channel, count(*) as n, round(regr_slope(lat, value) * 1e6, 4) as slope, round(regr_intercept(lat, value), 6) as intercept from {T} group by channel""")
def regression_fit(spark, sf_dir):
    """Least-squares line of each channel."""
    found = stats.line_fit(telemetry(spark, sf_dir), ["channel"], "value", "lat")
    return found.select("channel", "n", F.round(F.col("slope") * 1000000, 4).alias("slope"), F.round("intercept", 6).alias("intercept"))


@register("symmetric_line_fit", f"""with f as (select channel, count(*) as n, stddev_pop(lon) / stddev_pop(value) * sign(corr(value, lon)) as s, avg(value) as x, avg(lon) as y from {T} group by channel)
    select channel, n, round(s * 1e6, 4) as slope, round(y - s * x, 6) as intercept from f""")
def symmetric_line_fit(spark, sf_dir):
    """The symmetric line of each channel."""
    found = stats.line_fit(telemetry(spark, sf_dir), ["channel"], "value", "lon", True)
    return found.select("channel", "n", F.round(F.col("slope") * 1000000, 4).alias("slope"), F.round("intercept", 6).alias("intercept"))


@register("collinearity", f"""with c as (select track, var_samp(lon) as a, var_samp(lat) as b, covar_samp(lon, lat) as c from {T} group by track),
    e as (select track, (a + b) / 2 as h, sqrt(pow((a - b) / 2, 2) + pow(c, 2)) as r from c) select track, round(sqrt(greatest(h - r, 0) / (h + r)), 6) as collinearity from e""")
def collinearity(spark, sf_dir):
    """Collinearity of a path in plan."""
    return rounded(stats.collinearity(telemetry(spark, sf_dir), ["track"], "lon", "lat"))


@register("band_medians", f"""with n as (select channel, value, ntile(10) over (partition by channel order by event_id) as band from {T})
    select channel, cast(band as int) as band, count(*) as n, round(median(value), 6) as median from n group by channel, band""")
def band_medians(spark, sf_dir):
    """Medians over ten equal-count bands."""
    return rounded(windows.band_medians(telemetry(spark, sf_dir), ["channel"], "event_id", "value"))


@register("json_flatten", f"""select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from {T}""")
def json_flatten(spark, sf_dir):
    """A nested JSON value as a column."""
    return telemetry(spark, sf_dir).select("event_id", F.get_json_object("props", "$.k").try_cast("long").alias("k"))


@register("header_normalise", """select doc_id, regexp_replace(lower(text), '[^a-z0-9]', '', 'g') as header from documents""")
def header_normalise(spark, sf_dir):
    """Header texts as letters and digits."""
    from skyloom.plans.tables import table

    return table(spark, sf_dir, "documents").select("doc_id", S.normalise_header("text").alias("header"))


@register("stage_score", f"""select priority, count(case when status in ('F', 'O', 'P') then 1 end) as scored,
      round(least(avg(case status when 'F' then 1.0e0 when 'P' then 0.5e0 when 'O' then 0.0e0 end) * 100, coalesce(min(case when status = 'O' then overlap * 100 + 60 end), 100)), 6) as score from {FRAMES_SQL} group by priority""")
def stage_score(spark, sf_dir):
    """Score of status rows, capped by failed gates."""
    names = F.when(F.col("status") == "F", "pass").when(F.col("status") == "P", "warn").when(F.col("status") == "O", "fail")
    rows = frames(spark, sf_dir).select("priority", names.alias("status"), (F.col("overlap") * 100 + 60).alias("cap"))
    return rounded(stats.stage_score(rows, ["priority"], "status", "cap"))


@register("status_counts", f"""select priority, count(*) filter (status = 'F') as n_f, count(*) filter (status = 'O') as n_o, count(*) filter (status = 'P') as n_p, count(*) filter (status = 'X') as n_x from {FRAMES_SQL} group by priority""")
def status_counts(spark, sf_dir):
    """Status counts, zeros included."""
    return stats.status_counts(frames(spark, sf_dir), ["priority"], "status", ["F", "O", "P", "X"])


@register("truth_kpis", """select d.lang, count(*) as n, round(count(*) filter (n_chars < 500 and quality = 0) / nullif(count(*) filter (quality = 0), 0), 6) as recall,
      round(count(*) filter (n_chars < 500 and quality = 1) / nullif(count(*) filter (quality = 1), 0), 6) as false_reject, count(*) filter (n_chars >= 500 and quality = 0) as leaks
    from documents d join labels l using (doc_id) group by d.lang""")
def truth_kpis(spark, sf_dir):
    """Recall, false rejects and leaks against ground truth."""
    from skyloom.plans.tables import table

    rows = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id")
    return rounded(stats.truth_kpis(rows, ["lang"], F.col("n_chars") < 500, F.col("quality") == 0))


@register("case_pivot", f"""select priority, round(sum(case when status = 'F' then sharpness end), 2) as "F", round(sum(case when status = 'O' then sharpness end), 2) as "O" from {FRAMES_SQL} group by priority""")
def case_pivot(spark, sf_dir):
    """Cases as rows, conditioning as columns."""
    made = frames(spark, sf_dir).groupBy("priority").pivot("status", ["F", "O"]).agg(F.sum("sharpness"))
    return rounded(made, 2)


@register("unpivot_bands", f"""select frame, 'overlap' as metric, round(overlap, 6) as value from {FRAMES_SQL} union all select frame, 'sharpness', round(sharpness, 6) from {FRAMES_SQL}""")
def unpivot_bands(spark, sf_dir):
    """A series unpivoted to metric and value."""
    return rounded(frames(spark, sf_dir).unpivot("frame", ["overlap", "sharpness"], "metric", "value"))


@register("prefix_budget", """with r as (select p_partkey, p_brand, p_size, coalesce(sum(p_size) over (partition by p_brand order by p_retailprice desc, p_partkey rows between unbounded preceding and 1 preceding), 0) as spent from part)
    select p_partkey, p_brand, cast(spent as bigint) as spent from r where spent < 500""")
def prefix_budget(spark, sf_dir):
    """Rows in order until a budget is passed."""
    from skyloom.plans.tables import table

    rows = windows.prefix_budget(table(spark, sf_dir, "part"), ["p_brand"], [F.desc("p_retailprice"), F.asc("p_partkey")], "p_size", 500)
    return rows.select("p_partkey", "p_brand", "spent")


@register("bench_cases", """select a.p_brand as kind, s.s as severity, c.c as conditioning from (select distinct p_brand from part) a cross join (values (1), (2), (3)) s(s) cross join (values (true), (false)) c(c)""")
def bench_cases(spark, sf_dir):
    """Every case of kind, severity and conditioning."""
    from skyloom.plans.tables import table

    kinds = table(spark, sf_dir, "part").select(F.col("p_brand").alias("kind")).distinct()
    return kinds.withColumn("severity", F.explode(F.array(*map(F.lit, (1, 2, 3))))).withColumn("conditioning", F.explode(F.array(F.lit(True), F.lit(False))))
