"""Queries of the stage cards: a JSON report for each order, with parts that are missing in some, and its KPI rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyloom.operators import stage_cards as cards
from skyloom.plans.catalog import register
from skyloom.plans.tables import table


def u(k: int) -> Column:
    """A share that follows from the order's key."""
    return (F.col("i") * k % 97) / F.lit(97.0)


def _u(k: int) -> str:
    return f"((i * {k} % 97) / 97.0e0)"


def part(**fields: Column) -> Column:
    return F.struct(*(c.alias(n) for n, c in fields.items()))


def some(condition: Column, value: Column) -> Column:
    """A field that is left out where the condition fails."""
    return F.when(condition, value)


def _reports(spark, sf_dir, **fields: Column):
    """(i, report): without a report in one order of 31. A report names its order, so it is never empty; keys are dealt
    to all cores first, as making and reading reports is the work and a file of keys alone is few splits."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("long").alias("i")).repartition(2 * spark.sparkContext.defaultParallelism)
    return rows.select("i", F.when(F.col("i") % 31 > 0, F.to_json(part(order=F.col("i"), **fields))).alias("report"))


def _rows(spark, sf_dir, rules, **fields: Column):
    found = cards.stage_card(_reports(spark, sf_dir, **fields), ["i"], rules(cards.LIMITS) if callable(rules) else rules)
    return found.select("i", "key", F.round("value", 5).alias("value"), "status", "cap")


def _low(v: str, good: float, ok: float) -> str:
    return f"case when ({v}) is null then 'info' when ({v}) <= {good} then 'pass' when ({v}) <= {ok} then 'warn' else 'fail' end"


def _high(v: str, good: float, ok: float) -> str:
    return f"case when ({v}) is null then 'info' when ({v}) >= {good} then 'pass' when ({v}) >= {ok} then 'warn' else 'fail' end"


def _under(v: str, good: float, ok: float) -> str:
    return f"case when ({v}) < {good} then 'pass' when ({v}) < {ok} then 'warn' else 'fail' end"


def _over(v: str, good: float, ok: float) -> str:
    return f"case when ({v}) > {good} then 'pass' when ({v}) > {ok} then 'warn' else 'fail' end"


def _yes(key: str, condition: str, bad: str = "warn", when: str = "true") -> tuple:
    return key, f"case when {condition} then 1 else 0 end", f"case when {condition} then 'pass' else '{bad}' end", when


def _sql(rows: list[tuple]) -> str:
    """The rows (key, value, status, when, cap) of each order that has a report, and one for each that has none."""
    structs = ", ".join(f"case when {r[3]} then {{'key': '{r[0]}', 'value': ({r[1]})::double, 'status': {r[2]}, 'cap': {r[4] if len(r) > 4 else 'null'}::double}} end" for r in rows)
    return f"""with o as (select o_orderkey::bigint as i from orders), k as (select i, unnest([{structs}]) as k from o where i % 31 > 0)
      select i, k.key as key, round(k.value, 5) as value, k.status as status, k.cap as cap from k where k is not null union all select i, 'report', 0, 'fail', null from o where i % 31 = 0"""


_CONDITION = [
    ("artifacts_report", "0", "'fail'", "i % 11 = 0"),
    ("correct_fraction", "i % 8 / 20.0e0", _under("i % 8 / 20.0e0", 0.15, 0.3), "i % 11 > 0"),
    ("keypoints_vetoed", "i % 100", "'info'", "i % 11 > 0"),
    ("blockiness_reduction", f"({_u(3)} - {_u(7)}) / (1 + {_u(3)})", _over(f"({_u(3)} - {_u(7)}) / (1 + {_u(3)})", 0.1, 0), "i % 11 > 0 and i % 5 > 0"),
    ("illumination_report", "0", "'fail'", "i % 13 = 0"),
    ("low_light_fraction", "i % 7 / 10.0e0", _low("i % 7 / 10.0e0", 0.2, 0.5), "i % 13 > 0 and i % 17 > 0"),
    ("shadow_fraction_mean", f"{_u(5)} * 0.7e0", _low(f"{_u(5)} * 0.7e0", 0.3, 0.5), "i % 13 > 0"),
    ("saturated_fraction", f"{_u(11)} * 0.15e0", _low(f"{_u(11)} * 0.15e0", 0.02, 0.1), "i % 13 > 0 and i % 3 > 0"),
    ("exposure_clamped_fraction", "i % 9 / 20.0e0", _low("i % 9 / 20.0e0", 0.1, 0.3), "i % 13 > 0 and i % 4 > 0"),
    ("exposure_rejected_links", "i % 7", _under("i % 7 / 20.0e0", 0.1, 0.25), "i % 13 > 0 and i % 4 > 0"),
    ("exposure_gain_span", _u(13), "'info'", "i % 13 > 0 and i % 4 > 0"),
    ("shadow_recall", _u(17), _over(_u(17), 0.5, 0.3), "i % 13 > 0 and i % 6 = 0"),
    ("shadow_false_positive", _u(19), _under(_u(19), 0.25, 0.5), "i % 13 > 0 and i % 6 = 0"),
    ("dynamic_report", "0", "'info'", "i % 7 = 0"),
    ("frames_with_movers", "i % 5 / 10.0e0", "'info'", "i % 7 > 0"),
    ("masked_fraction_max", "(i % 4) * 0.15e0", _under("(i % 4) * 0.15e0", 0.2, 0.4), "i % 7 > 0 and i % 4 > 0"),
    ("gps_report", "0", "'info'", "i % 19 = 0"),
    ("gps_available", "0", "'warn'", "i % 19 > 0 and i % 29 = 0"),
    ("outlier_fraction", "(i % 20 + i % 15) / 100.0e0", _low("(i % 20 + i % 15) / 100.0e0", 0.1, 0.3), "i % 19 > 0 and i % 29 > 0 and i % 23 > 0"),
    ("smoothed_fixes", "60 + i % 40", "case when 60 + i % 40 >= 70 then 'pass' else 'warn' end", "i % 19 > 0 and i % 29 > 0 and i % 23 > 0"),
    ("altitude_source", "null", "case i % 3 when 0 then 'pass' when 1 then 'warn' else 'fail' end", "i % 19 > 0 and i % 29 > 0"),
    ("rtk_detected", "case when i % 2 = 0 then 1 else 0 end", "'info'", "i % 19 > 0 and i % 29 > 0"),
    ("max_speed", "i % 40", "case when i % 40 < 25 then 'pass' else 'warn' end", "i % 19 > 0 and i % 29 > 0 and i % 5 > 0"),
]


@register("condition_card", _sql(_CONDITION))
def condition_card(spark, sf_dir):
    """The card of conditioning."""
    I = F.col("i")  # noqa: E741
    chain = part(frames=F.lit(20), clamped_frames=I % 9, rejected_links=I % 7, gain_span=u(13))
    return _rows(
        spark, sf_dir, cards.condition_rules,
        artifacts=some(I % 11 > 0, part(frames_evaluated=F.lit(20), frames_corrected=I % 8, keypoints_vetoed=I % 100, blockiness_before=1 + u(3), blockiness_after=some(I % 5 > 0, 1 + u(7)))),
        illumination=some(I % 13 > 0, part(
            frames=F.when(I % 17 == 0, 0).otherwise(10), low_light_frames=I % 7, shadow_fraction_mean=u(5) * 0.7, saturated_fraction_mean=some(I % 3 > 0, u(11) * 0.15),
            exposure_chain=some(I % 4 > 0, chain), shadow_recall=some(I % 6 == 0, u(17)), shadow_false_positive=some(I % 6 == 0, u(19)))),
        dynamic=some(I % 7 > 0, part(frames=F.lit(10), frames_with_movers=I % 5, masked_fraction_max=(I % 4) * 0.15)),
        gps=some(I % 19 > 0, part(
            input_fixes=F.when(I % 23 == 0, 0).otherwise(100), envelope_outliers=I % 20, median_outliers=I % 15, smoothed_fixes=60 + I % 40, rtk_detected=I % 2 == 0,
            altitude_source=F.when(I % 3 == 0, "baro+gps_complementary").when(I % 3 == 1, "gps").otherwise("baro_relative_only"),
            max_speed_observed_mps=some(I % 5 > 0, I % 40), notes=some(I % 29 == 0, F.array(F.lit("Scale-free path"))))),
    )


_FUSION = [
    _yes("zone_map", "i % 9 > 0", "fail"),
    ("zone1_pct", f"{_u(3)} * 100", _high(f"{_u(3)} * 100", 50, 25), "true"),
    ("views_median", "i % 12", "'info'", "true"),
    ("rejected_pct", f"{_u(5)} * 15", _low(f"{_u(5)} * 15", 2, 10), "true"),
    ("coverage_pct", f"{_u(7)} * 100", _high(f"{_u(7)} * 100", 90, 70), "true"),
    _yes("gaps_geojson", "i % 4 > 0", "fail"),
    ("inferred_mesh_pct", f"case when i % 5 > 0 then {_u(11)} * 60 end", f"case when i % 5 = 0 then 'info' when {_u(11)} * 60 <= 30 then 'pass' else 'warn' end", "true"),
    ("frames_anchored", "case when i % 3 > 0 and i % 8 > 0 then (i % 8) / 8.0e0 else 0 end", f"case when i % 3 > 0 and i % 8 > 0 then {_high('(i % 8) / 8.0e0', 0.7, 0.4)} else 'warn' end", "true"),
    ("zone1_untouched", "case when i % 6 = 0 then i % 7 else 0 end", "case when i % 6 > 0 or i % 7 = 0 then 'pass' else 'fail' end", "true"),
    ("fill_weight", f"case when i % 3 > 0 then {_u(13)} * 1.2e0 end", f"case when i % 3 > 0 and {_u(13)} * 1.2e0 >= 1 then 'fail' else 'pass' end", "true"),
    ("holdout_error_pct", f"case when i % 3 = 1 then {_u(17)} * 8 end", _low(f"case when i % 3 = 1 then {_u(17)} * 8 end", 2, 5), "true"),
    ("seconds", "i % 400", _low("i % 400", 120, 240), "true"),
]


@register("fusion_card", _sql(_FUSION))
def fusion_card(spark, sf_dir):
    """The card of fusion."""
    I = F.col("i")  # noqa: E741
    filled = part(
        source=F.when(I % 3 > 0, "cache").otherwise("none"), frames_tried=F.when(I % 8 == 0, 0).otherwise(8), frames_anchored=I % 8, weight_max=some(I % 3 > 0, u(13) * 1.2),
        holdout_error_median_pct=some(I % 3 == 1, u(17) * 8),
    )
    return _rows(
        spark, sf_dir, cards.fusion_rules, voxel=part(voxels=I % 9), ground=part(zone1_pct=u(3) * 100), views_median=I % 12, rejected_near_camera_pct=u(5) * 15, coverage_pct=u(7) * 100,
        checked=part(gaps_ok=I % 4 > 0, fill_in_zone1=some(I % 6 == 0, I % 7)), mesh=some(I % 5 > 0, part(zone3_area_pct=u(11) * 60)), fill=filled, timings_s=part(total=I % 400),
    )


_HYBRID, _GPS = "i % 3 > 0 and i % 4 > 0", "i % 5 > 0"
_RECONSTRUCTION = [
    ("registered_fraction", _u(3), _high(_u(3), 0.9, 0.7), "true"),
    ("models", "1 + i % 6 - i % 3", _low("1 + i % 6 - i % 3", 1, 2), "true"),
    ("reproj_px", f"case when i % 7 > 0 then {_u(5)} * 4 end", _low(f"case when i % 7 > 0 then {_u(5)} * 4 end", 1.5, 2.5), "true"),
    ("track_length", f"{_u(7)} * 5", _high(f"{_u(7)} * 5", 3, 2), "true"),
    _yes("focal_source", "i % 2 = 0"),
    ("cam_vs_gps_rms_m", f"case when {_GPS} then {_u(11)} * 40 end", _low(f"case when {_GPS} then {_u(11)} * 40 end", 1, 5), "true"),
    ("geometry_gate", f"{_u(11)} * 40", _low(f"{_u(11)} * 40", 25, 25), _GPS, "40"),
    ("gps_refinement", "case when i % 4 = 0 then null when i % 3 = 0 then 1 else 0 end", "case when i % 4 = 0 then 'info' when i % 3 = 0 then 'pass' else 'warn' end", "true"),
    ("height_error_pct", f"case when i % 5 = 1 then {_u(13)} * 40 - 20 end", f"case when i % 5 <> 1 then 'info' when abs({_u(13)} * 40 - 20) <= 5 then 'pass' when abs({_u(13)} * 40 - 20) <= 15 then 'warn' else 'fail' end", "true"),
    ("depth_used", f"case when i % 3 > 0 and {_HYBRID} then 1 else 0 end", f"case when i % 3 = 0 then 'info' when {_HYBRID} then 'pass' else 'warn' end", "true"),
    ("frames_anchored", "(i % 11) / 10.0e0", _high("(i % 11) / 10.0e0", 0.9, 0.7), _HYBRID),
    ("views_per_point", "i % 6", "'info'", _HYBRID),
    ("anchor_spread_pct", f"{_u(17)} * 8", _low(f"{_u(17)} * 8", 2, 5), f"{_HYBRID} and i % 2 = 0"),
    _yes("dense_engine", f"({_HYBRID} or i % 8 > 0)", "fail"),
    ("dense_points", "i % 1000", "'info'", f"({_HYBRID} or i % 8 > 0)"),
    ("footprint_m2", "case when i % 5 > 0 then i % 500 end", "'info'", f"({_HYBRID} or i % 8 > 0)"),
    ("mesher", "null", "case i % 3 when 0 then 'pass' when 1 then 'warn' else 'fail' end", "true"),
    ("faces_per_vertex", f"{_u(19)} + 1", _high(f"{_u(19)} + 1", 1.8, 1.4), "i % 3 < 2"),
    _yes("textured", "i % 2 = 1"),
    ("texture_black_pct", f"{_u(23)} * 15", _low(f"{_u(23)} * 15", 2, 10), "i % 2 = 1"),
    _yes("using_cuda", "i % 4 = 1"),
    ("downgrades", "i % 3", "'info'", "true"),
    ("track_a_seconds", "i % 60 + i % 70 + 0.5e0", "'info'", "true"),
    ("budget_degradations", "1", "'info'", "i % 9 = 0"),
]


@register("reconstruction_card", _sql(_RECONSTRUCTION))
def reconstruction_card(spark, sf_dir):
    """The card of reconstruction."""
    I = F.col("i")  # noqa: E741
    hybrid = (I % 3 > 0) & (I % 4 > 0)
    refinement = F.when(I % 4 == 0, part(enabled=F.lit(False), kept=F.lit(None).cast("string"), skipped=F.lit("no fixes"))).otherwise(
        part(enabled=F.lit(True), kept=F.when(I % 3 == 0, "GPS-prior refinement").otherwise("unrefined"), skipped=F.lit(None).cast("string"))
    )
    dense = part(
        mode=F.when(I % 3 == 0, "A").otherwise("auto"), engine=F.when(hybrid, "vggt_hybrid").when(I % 8 > 0, "patches"), frames=F.lit(10), frames_anchored=I % 11,
        views_per_point_median=I % 6, anchor_spread_median_pct=some(I % 2 == 0, u(17) * 8), points=I % 1000, footprint_m2=some(I % 5 > 0, I % 500),
    )
    words = F.when(I % 3 == 0, F.array().cast("array<string>")).when(I % 3 == 1, F.array(F.lit("a"))).otherwise(F.array(F.lit("a"), F.lit("b")))
    return _rows(
        spark, sf_dir, cards.reconstruction_rules, registered_fraction=u(3), models=1 + I % 6, models_merged=I % 3, reproj_px=some(I % 7 > 0, u(5) * 4), track_length=u(7) * 5,
        focal_source=F.when(I % 2 == 0, "telemetry_hfov").otherwise("self_calibrated"), cam_vs_gps_rms_m=some(I % 5 > 0, u(11) * 40), gps_refinement=refinement,
        height_error_pct=some(I % 5 == 1, u(13) * 40 - 20), dense=dense, mesh=part(mesher=F.when(I % 3 == 0, "openmvs_delaunay").when(I % 3 == 1, "poisson"), faces_per_vertex=some(I % 3 < 2, u(19) + 1)),
        textured=I % 2 == 1, texture=some(I % 2 == 1, part(black_pct=u(23) * 15)), using_cuda=I % 4 == 1, downgrades=words, timings_s=part(sparse=I % 60, dense=I % 70, mesh=F.lit(0.5)),
        degradations=some(I % 9 == 0, F.array(F.lit("size"))),
    )


_FRAME = "i % 8 > 0"
_FORMATS = {x: 5 + k for k, x in enumerate(cards.FORMATS)}
_EXPORT = [
    _yes("referenced", _FRAME, "fail"),
    _yes("vertical_datum", "(i % 3 = 0 or i % 5 = 0)", when=_FRAME),
    ("cam_vs_gps_rms_m", f"{_u(3)} * 8", _low(f"{_u(3)} * 8", 1, 5), _FRAME),
    ("inlier_fraction", "(i % 21) / 20.0e0", _high("(i % 21) / 20.0e0", 0.9, 0.7), _FRAME),
    ("ground_constraint", "case when i % 2 = 0 then 1 else 0 end", "'info'", _FRAME),
    ("gcp_check_rms_m", f"{_u(5)} * 5", _low(f"{_u(5)} * 5", 1, 3), f"{_FRAME} and i % 4 = 1"),
    ("gcp_control", "i % 3", "case when i % 3 > 0 then 'info' else 'warn' end", f"{_FRAME} and i % 4 < 2"),
    *(_yes(f"format_{x}", f"i % {k} > 1", "fail") for x, k in _FORMATS.items()),
    _yes("confidence_layer", "i % 2 = 0", when="i % 3 > 0"),
    _yes("zones_layer", "(i % 2 = 0 and i % 7 > 0 and i % 3 > 0)", when="i % 5 > 0"),
    _yes("las_classified", "i % 4 > 0", when="i % 7 > 0"),
    ("coverage_pct", f"case when i % 6 > 0 then {_u(7)} * 100 end", _high(f"case when i % 6 > 0 then {_u(7)} * 100 end", 90, 70), "true"),
    ("dsm", _u(11), "'info'", "i % 8 > 0"),
]


@register("export_card", _sql(_EXPORT))
def export_card(spark, sf_dir):
    """The card of the export."""
    I = F.col("i")  # noqa: E741
    gcp = some(I % 4 < 2, part(control=I % 3, check_rms_m=some(I % 4 == 1, u(5) * 5)))
    frame = part(vertical_epsg=some(I % 3 == 0, F.lit(5773)), gps_altitude_datum=F.when(I % 5 == 0, "orthometric").otherwise("ellipsoidal"))
    more = {"las": {"layers": F.when(I % 3 > 0, F.array(F.lit("rgb"), F.lit("zone"))).otherwise(F.array(F.lit("rgb"))), "ground_share": (I % 4) / 4.0}, "geotiff_dsm": {"valid_fraction": u(11)}}
    files = {x: some(I % k > 0, part(readable=I % k > 1, **more.get(x, {}))) for x, k in _FORMATS.items()}
    files |= {"glb_confidence": some(I % 3 > 0, part(readable=I % 2 == 0)), "glb_zones": part(readable=I % 2 == 0), "geojson_gaps": F.lit("gaps.geojson")}
    return _rows(
        spark, sf_dir, cards.export_rules,
        georef=part(frame=some(I % 8 > 0, frame), rms_all_m=u(3) * 8, inliers=I % 21, cameras=F.lit(20), ground_constraint=I % 2 == 0, gcp=gcp),
        files=part(**files), zones=some(I % 5 > 0, F.lit("yes")), coverage=part(coverage_pct=some(I % 6 > 0, u(7) * 100)),
    )


_STAGES = ["ingest", "condition", "recon", "fusion", "export"]
_OPEN = "(case when i % 3 = 0 then 1 else 0 end + case when i % 5 = 0 then 1 else 0 end)"
_SPENT = "(i % 100 + 50 + case when i % 3 > 0 then i % 300 else 0 end)"
_DONE = [
    _yes("viewer_built", "i % 2 = 0", "fail"), _yes("layer_zones", "i % 3 > 0"), _yes("layer_texture", "i % 4 > 0"),
    ("scene_mb", "i % 300", "case when i % 300 <= 150 then 'pass' else 'warn' end", "true"),
    ("reference", "null", "'info'", "i % 5 = 0"),
    ("zone1_rms_m", f"{_u(3)} * 5", _low(f"{_u(3)} * 5", 1, 3), "i % 5 > 0 and i % 7 > 0"),
    _yes("zones_rank_accuracy", f"{_u(5)} <= {_u(7)}", when="i % 5 > 0 and i % 7 > 0 and i % 2 = 0"),
    ("zone2_reported", "case when i % 2 = 0 then 1 else 0 end", "case when i % 2 = 0 then 'pass' else 'info' end", "i % 5 > 0"),
    ("horizontal_shift_m", f"{_u(11)} * 5", _low(f"{_u(11)} * 5", 1, 3), "i % 5 > 0"),
    ("end_to_end", _OPEN, f"case when {_OPEN} = 0 then 'pass' else 'fail' end", "true"),
    ("projected_10min_s", f"{_SPENT} * 600 / 120.0e0", _low(f"{_SPENT} * 600 / 120.0e0", 900, 1800), "i % 6 > 0"),
    ("six_formats", "5 + i % 2", "case when i % 2 = 1 then 'pass' else 'warn' end", "true"),
    _yes("rms_reported", "i % 9 > 0", "fail"), _yes("coverage_and_gaps", "(i % 4 > 0 and i % 3 > 0)"), _yes("zone_accuracy", "(i % 5 > 0 and i % 7 > 0 and i % 2 = 0)"),
]


@register("done_card", _sql(_DONE))
def done_card(spark, sf_dir):
    """The card of the report and of a complete run."""
    I = F.col("i")  # noqa: E741
    stage = lambda status, s: part(status=status, duration_s=s.cast("double"))
    stages = part(
        ingest=stage(F.lit("done"), I % 100), condition=stage(F.lit("done"), F.lit(50)), recon=stage(F.when(I % 3 == 0, "failed").otherwise("done"), I % 300),
        fusion=stage(F.lit("skipped"), F.lit(7)), export=some(I % 5 > 0, stage(F.lit("skipped"), F.lit(9))), qa=stage(F.lit("done"), F.lit(1000)),
    )
    accuracy = part(zone1=some(I % 7 > 0, part(rms_m=u(3) * 5, nmad_m=u(5))), zone2=some(I % 2 == 0, part(rms_m=u(5), nmad_m=u(7))), shift_m=u(11) * 5)
    names = [F.lit(x) for x in ("obj", "ply", "las", "glb", "fbx", "tif")]
    return _rows(
        spark, sf_dir, cards.report_rules(cards.LIMITS, _STAGES), viewer=part(built=I % 2 == 0, zones=I % 3 > 0, texture=I % 4 > 0, scene_mb=I % 300), accuracy=some(I % 5 > 0, accuracy),
        stages=stages, video_s=some(I % 6 > 0, F.lit(120.0)), produced=F.when(I % 2 == 1, F.array(*names)).otherwise(F.array(*names[:5])), georef_rms_m=some(I % 9 > 0, u(3)),
        coverage_pct=some(I % 4 > 0, u(7)), gaps_file=I % 3 > 0,
    )
