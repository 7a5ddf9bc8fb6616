"""Queries of scorecards, text scans and reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.functions import scalar as S
from skyloom.operators import scorecards, stats
from skyloom.plans.catalog import register
from skyloom.plans.tables import FRAMES_SQL, frames, rounded, table, telemetry
from skyloom.sources import telemetry as logs


def _measured(spark, sf_dir):
    f = F.col
    return frames(spark, sf_dir).groupBy("video").agg(
        F.median("overlap").alias("overlap_median"), F.avg((f("sharpness") < 50000).cast("double")).alias("blur_rejected"), F.count("*").cast("double").alias("frames_kept"), F.sum("overlap").alias("duration")
    )


_CARD = f"""with m as (select video, median(overlap) as a, avg(case when sharpness < 50000 then 1.0e0 else 0 end) as b, cast(count(*) as double) as c, sum(overlap) as d from {FRAMES_SQL} group by video),
    k as (select video, 'overlap_median' as key, 'overlap' as grp, a as value, case when a >= 0.65 then 'pass' when a >= 0.5 then 'warn' else 'fail' end as status, '>= 0.65' as target, '' as unit from m
      union all select video, 'blur_rejected', 'blur', b, case when b <= 0.1 then 'pass' when b <= 0.25 then 'warn' else 'fail' end, '<= 0.1', '' from m
      union all select video, 'frames_kept', 'selection', c, case when c between 5 and 40 then 'pass' when c between -5 and 50 then 'warn' else 'fail' end, '5 to 40', '' from m
      union all select video, 'duration', 'run', d, 'info', '', 's' from m)"""


@register("ingest_scorecard", f"{_CARD} select video, key, grp, round(value, 6) as value, status, target, unit, cast(null as double) as cap from k")
def ingest_scorecard(spark, sf_dir):
    """KPI rows of each series by declared rules."""
    return rounded(scorecards.scorecard(_measured(spark, sf_dir), ["video"], scorecards.CARDS["ingest"]()))


@register("scorecard_scores", f"""{_CARD} select video, count(*) filter (status <> 'info') as scored, round(avg(case status when 'pass' then 1.0e0 when 'warn' then 0.5e0 when 'fail' then 0.0e0 end) * 100, 6) as score from k group by video""")
def scorecard_scores(spark, sf_dir):
    """Score of each card."""
    rows = scorecards.scorecard(_measured(spark, sf_dir), ["video"], scorecards.CARDS["ingest"]())
    return rounded(stats.stage_score(rows, ["video"], "status"))


@register("srt_fields", """select doc_id, len(regexp_extract_all(text, '([A-Za-z_]+)\\s*:\\s*([+-]?[0-9]+(?:\\.[0-9]+)?)')) as fields,
    try_cast(nullif(regexp_extract(text, '([A-Za-z_]+)\\s*:\\s*([+-]?[0-9]+(?:\\.[0-9]+)?)', 2), '') as double) as first_value from documents""")
def srt_fields(spark, sf_dir):
    """``key : value`` fields of texts."""
    p = r"([A-Za-z_]+)\s*:\s*([+-]?[0-9]+(?:\.[0-9]+)?)"
    return table(spark, sf_dir, "documents").select("doc_id", F.size(F.regexp_extract_all("text", F.lit(p), 0)).cast("long").alias("fields"), F.regexp_extract("text", p, 2).try_cast("double").alias("first_value"))


@register("sniffed_kinds", """select page_id, case when contains(html, '<gpx') then 'gpx' when contains(html, '<kml') then 'kml' when regexp_matches(html, '[0-9]+:[0-9]+:[0-9]+[,.][0-9]+\\s*-->') then 'srt'
    when regexp_matches(html, '^[ \\t\\r\\n]*[\\[{]') then 'json' when regexp_matches(html, '^[^\\n]*[,;\\t|][^\\n]*\\n') then 'csv' end as kind from pages""")
def sniffed_kinds(spark, sf_dir):
    """Kind of a file by its first bytes."""
    return table(spark, sf_dir, "pages").select("page_id", logs.sniff(F.col("html").cast("binary")).alias("kind"))


@register("page_fingerprints", "select page_id, substr(sha256(html), 1, 16) as fingerprint from pages")
def page_fingerprints(spark, sf_dir):
    """fingerprints of canonical texts."""
    return table(spark, sf_dir, "pages").select("page_id", S.fingerprint("html").alias("fingerprint"))


@register("cue_stamps", """with s as (select event_id, cast(round(value * 1000) as bigint) as ms from events) select event_id, printf('%02d:%02d:%02d,%03d', ms // 3600000, (ms // 60000) % 60, (ms // 1000) % 60, ms % 1000) as stamp from s""")
def cue_stamps(spark, sf_dir):
    """seconds as subtitle stamps."""
    return telemetry(spark, sf_dir).select("event_id", S.format_cue("value").alias("stamp"))


@register("datum_decisions", """with g as (select event_id, value as g, value - (event_id % 90) as t, 45.0e0 - (event_id % 60) as n from events),
    d as (select *, abs(g - t) as a, abs(g - t - n) as b from g)
    select event_id, case when abs(n) < 20 then null when a <= 10 and a < b then 'orthometric' when b <= 10 and b < a then 'ellipsoidal' end as datum from d""")
def datum_decisions(spark, sf_dir):
    """Height datum by three numbers."""
    k = F.col("event_id")
    return telemetry(spark, sf_dir).select("event_id", S.decide_datum("value", F.col("value") - k % 90, F.lit(45.0) - k % 60, 10.0).alias("datum"))


@register("gps_times", """select event_id, epoch_us(timestamp '1980-01-06') + (2200 * 604800 + event_id % 604800 - 18) * 1000000 as us from events""")
def gps_times(spark, sf_dir):
    """GPS week and milliseconds as UTC."""
    k = F.col("event_id") % 604800
    return telemetry(spark, sf_dir).select("event_id", F.unix_micros(S.gps_time(F.lit(2200), k * 1000)).alias("us"))


@register("zone_residuals", """with d as (select event_id, value * 50 as d from events) select event_id, round(d - round_even(d / 900, 0) * 900, 6) as residual from d""")
def zone_residuals(spark, sf_dir):
    """Clock differences without whole zone steps."""
    return rounded(telemetry(spark, sf_dir).select("event_id", S.zone_residual(F.col("value") * 50).alias("residual")))


@register("optional_inputs", """select p_brand as name, case when f.name is null then 'unknown' when f.present then 'present' else 'absent' end as status
    from (select distinct p_brand from part) r left join (select p_brand as name, max(p_size) > 48 as present from part where p_size > 30 and p_brand <> 'Brand#11' group by 1) f on f.name = r.p_brand""")
def optional_inputs(spark, sf_dir):
    """Ledger of optional inputs."""
    part = table(spark, sf_dir, "part")
    found = part.where("p_size > 30 and p_brand <> 'Brand#11'").groupBy(F.col("p_brand").alias("name")).agg((F.max("p_size") > 48).alias("present"))
    return scorecards.missing_inputs(part.select(F.col("p_brand").alias("name")).distinct(), found)
