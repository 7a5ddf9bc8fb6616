"""Scorecards of the stages of a run, from the reports that the stages write as JSON (inventory A57 to A60, A64 to A73).

A card is a list of rules over the paths of a report; what a report does not hold makes no row, or an informative one
where a reader would look for it. A report that is missing is itself a row. Limits are parameters: ``limits`` replaces
those of ``LIMITS`` by name.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.operators.scorecards import Rule, at_least, at_most, info, scorecard

#: Where a KPI passes and where it still warns.
LIMITS = {
    "correct_fraction": (0.15, 0.30), "blockiness_reduction": (0.10, 0.0), "low_light": (0.20, 0.50), "shadow": (0.30, 0.50), "saturated": (0.02, 0.10), "clamped": (0.10, 0.30),
    "rejected_links": (0.10, 0.25), "shadow_recall": (0.50, 0.30), "shadow_false": (0.25, 0.50), "masked": (0.20, 0.40), "gps_outliers": (0.10, 0.30), "max_speed": 25.0,
    "zone1_pct": (50.0, 25.0), "coverage_pct": (90.0, 70.0), "rejected_pct": (2.0, 10.0), "fill_anchored": (0.7, 0.4), "holdout_pct": (2.0, 5.0), "inferred_pct": 30.0, "fusion_s": 120.0,
    "registered": (0.90, 0.70), "models": (1, 2), "reproj_px": (1.5, 2.5), "track_length": (3.0, 2.0), "gps_rms_m": (1.0, 5.0), "gate_m": 25.0, "gate_cap": 40.0, "height_pct": (5.0, 15.0),
    "anchored": (0.90, 0.70), "anchor_spread_pct": (2.0, 5.0), "faces_per_vertex": (1.8, 1.4), "texture_black_pct": (2.0, 10.0), "inliers": (0.9, 0.7), "check_rms_m": (1.0, 3.0),
    "scene_mb": 150.0, "zone1_rms_m": (1.0, 3.0), "shift_m": (1.0, 3.0), "projected_s": 900.0,
}
FORMATS = ["obj", "ply", "las", "geotiff_dsm", "geotiff_ortho", "glb", "fbx"]


#: The parts of reports that rules read fields of, outer ones first. ``stage_card`` parses each once, as a map of texts.
PARTS = [
    "", "artifacts", "illumination", "illumination.exposure_chain", "dynamic", "gps", "fill", "checked", "timings_s", "voxel", "ground", "mesh", "gps_refinement", "dense", "texture",
    "georef", "georef.frame", "georef.gcp", "coverage", "files", *(f"files.{x}" for x in (*FORMATS, "glb_zones", "glb_confidence", "geojson_gaps")), "viewer", "accuracy", "accuracy.zone1", "accuracy.zone2",
]


def text(path: str) -> Column:
    """The text of a field: of a part's map, or of the report itself where the part is not among ``PARTS``."""
    part, _, field = path.rpartition(".")
    return F.col(f"`report:{part}`")[field] if part in PARTS else F.get_json_object("report", f"$.{path}")


def num(path: str) -> Column:
    return text(path).try_cast("double")


def share(a: Column, b: Column) -> Column:
    return F.coalesce(a, F.lit(0.0)) / F.greatest(F.coalesce(b, F.lit(0.0)), F.lit(1.0))


def holds(key: str, grp: str, condition: Column, otherwise: str = "warn", target: str = "yes") -> Rule:
    """A rule that a condition holds; its value is 1 or 0."""
    yes = F.coalesce(condition, F.lit(False))
    return Rule(key, grp, yes.cast("double"), F.when(yes, "pass").otherwise(otherwise), target)


def below(key: str, grp: str, value: Column, good: float, ok: float, unit: str = "") -> Rule:
    """A rule whose limits are themselves beyond what passes and warns."""
    status = F.when(value.isNull(), "info").when(value < good, "pass").when(value < ok, "warn").otherwise("fail")
    return Rule(key, grp, value, status, f"< {good:g}", unit)


def above(key: str, grp: str, value: Column, good: float, ok: float) -> Rule:
    status = F.when(value.isNull(), "info").when(value > good, "pass").when(value > ok, "warn").otherwise("fail")
    return Rule(key, grp, value, status, f"> {good:g}")


def where(condition: Column, *rules: Rule) -> list[Rule]:
    """The rules, made only where the condition holds as well."""
    sure = F.coalesce(condition, F.lit(False))
    return [replace(r, when=sure if r.when is None else sure & r.when) for r in rules]


def has(path: str, *rules: Rule) -> list[Rule]:
    return where(text(path).isNotNull(), *rules)


def artifact_rules(lim: dict) -> list[Rule]:
    """How many frames needed correction, and whether it worked."""
    a, g = "artifacts.", "artifacts"
    before, after = num(a + "blockiness_before"), num(a + "blockiness_after")
    return [
        *where(text("artifacts").isNull(), holds("artifacts_report", g, F.lit(False), "fail", "required")),
        *where(num(a + "frames_evaluated") > 0, below("correct_fraction", g, num(a + "frames_corrected") / num(a + "frames_evaluated"), *lim["correct_fraction"])),
        *has("artifacts", info("keypoints_vetoed", g, F.coalesce(num(a + "keypoints_vetoed"), F.lit(0.0)))),
        *where(before.isNotNull() & after.isNotNull(), above("blockiness_reduction", g, (before - after) / F.greatest(before, F.lit(1e-6)), *lim["blockiness_reduction"])),
    ]


def illumination_rules(lim: dict) -> list[Rule]:
    """Light, shadow, saturation, and what the exposure chain could not correct."""
    p, c, g = "illumination.", "illumination.exposure_chain.", "illumination"
    frames, links = num(c + "frames"), F.coalesce(num(c + "rejected_links"), F.lit(0.0))
    clamped = F.coalesce(num(c + "clamped_fraction"), F.coalesce(num(c + "clamped_frames"), F.lit(0.0)) / frames)
    rejected = F.when(links / frames < lim["rejected_links"][0], "pass").when(links / frames < lim["rejected_links"][1], "warn").otherwise("fail")
    return [
        *where(text("illumination").isNull(), holds("illumination_report", g, F.lit(False), "fail", "required")),
        *where(num(p + "frames") > 0, at_most("low_light_fraction", g, F.coalesce(num(p + "low_light_frames"), F.lit(0.0)) / num(p + "frames"), *lim["low_light"])),
        *has("illumination", at_most("shadow_fraction_mean", g, F.coalesce(num(p + "shadow_fraction_mean"), F.lit(0.0)), *lim["shadow"])),
        *has(p + "saturated_fraction_mean", at_most("saturated_fraction", g, num(p + "saturated_fraction_mean"), *lim["saturated"])),
        *where(frames > 0, at_most("exposure_clamped_fraction", g, clamped, *lim["clamped"]), Rule("exposure_rejected_links", g, links, rejected, f"< {lim['rejected_links'][0]:g} of the frames")),
        *has("illumination.exposure_chain", info("exposure_gain_span", g, F.coalesce(num(c + "gain_span"), F.lit(0.0)))),
        *has(p + "shadow_recall", above("shadow_recall", g, num(p + "shadow_recall"), *lim["shadow_recall"])),
        *has(p + "shadow_false_positive", below("shadow_false_positive", g, num(p + "shadow_false_positive"), *lim["shadow_false"])),
    ]


def dynamic_rules(lim: dict) -> list[Rule]:
    """How much of the frames is masked."""
    p, g = "dynamic.", "dynamic"
    return [
        *where(text("dynamic").isNull(), info("dynamic_report", g, F.lit(0.0))),
        *where(num(p + "frames") > 0, info("frames_with_movers", g, F.coalesce(num(p + "frames_with_movers"), F.lit(0.0)) / num(p + "frames"))),
        *where(num(p + "masked_fraction_max") > 0, below("masked_fraction_max", g, num(p + "masked_fraction_max"), *lim["masked"])),
    ]


def gps_rules(lim: dict, best: tuple[str, ...] = ("baro+gps_complementary",), usable: tuple[str, ...] = ("gps",)) -> list[Rule]:
    """Outliers, survivors, the altitude's source, speed; a path without scale has one row."""
    p, g = "gps.", "gps"
    none, free = text("gps").isNull(), F.lower(F.coalesce(text(p + "notes"), F.lit(""))).contains("scale-free")
    fixes, source = num(p + "input_fixes"), F.coalesce(text(p + "altitude_source"), F.lit("unknown"))
    wild = F.coalesce(num(p + "envelope_outliers"), F.lit(0.0)) + F.coalesce(num(p + "median_outliers"), F.lit(0.0))
    smoothed = F.coalesce(num(p + "smoothed_fixes"), F.lit(0.0))
    speed = num(p + "max_speed_observed_mps")
    scored = [
        *where(fixes > 0, at_most("outlier_fraction", g, wild / fixes, *lim["gps_outliers"]), Rule("smoothed_fixes", g, smoothed, F.when(smoothed >= F.floor(fixes * 0.7), "pass").otherwise("warn"), ">= 70 % of the fixes")),
        Rule("altitude_source", g, F.lit(None), F.when(source.isin(*best), "pass").when(source.isin(*usable), "warn").otherwise("fail"), " or ".join(best)),
        info("rtk_detected", g, F.coalesce(text(p + "rtk_detected") == "true", F.lit(False)).cast("double")),
        *where(speed.isNotNull(), Rule("max_speed", g, speed, F.when(speed < lim["max_speed"], "pass").otherwise("warn"), f"< {lim['max_speed']:g}", "m/s")),
    ]
    return [*where(none, info("gps_report", g, F.lit(0.0))), *where(~none & free, holds("gps_available", g, F.lit(False))), *where(~none & ~free, *scored)]


def fusion_rules(lim: dict) -> list[Rule]:
    """Zones, coverage, gaps checked again, anchoring, and that no inferred point lies in measured voxels."""
    z, c, f, t = "zones", "coverage", "anchoring", "time"
    tried, held = F.coalesce(num("fill.frames_tried"), F.lit(0.0)), num("fill.holdout_error_median_pct")
    from_source = (tried > 0) & F.coalesce(text("fill.source"), F.lit("none")).isin("none").__invert__()
    weight, inside, seconds = num("fill.weight_max"), F.coalesce(num("checked.fill_in_zone1"), F.lit(0.0)), F.coalesce(num("timings_s.total"), F.lit(0.0))
    return [
        holds("zone_map", z, num("voxel.voxels") > 0, "fail", "> 0 voxels"),
        at_least("zone1_pct", z, F.coalesce(num("ground.zone1_pct"), F.lit(0.0)), *lim["zone1_pct"], "%"),
        info("views_median", z, num("views_median")),
        at_most("rejected_pct", z, F.coalesce(num("rejected_near_camera_pct"), F.lit(0.0)), *lim["rejected_pct"], "%"),
        at_least("coverage_pct", c, F.coalesce(num("coverage_pct"), F.lit(0.0)), *lim["coverage_pct"], "%"),
        holds("gaps_geojson", c, text("checked.gaps_ok") == "true", "fail", "as reported"),
        *where(text("mesh").isNotNull(), at_most("inferred_mesh_pct", c, F.coalesce(num("mesh.zone3_area_pct"), F.lit(0.0)), lim["inferred_pct"], float("inf"), "%")),
        *where(text("mesh").isNull(), info("inferred_mesh_pct", c, F.lit(None))),
        *where(from_source, at_least("frames_anchored", f, F.coalesce(num("fill.frames_anchored"), F.lit(0.0)) / tried, *lim["fill_anchored"])),
        *where(~from_source, Rule("frames_anchored", f, F.lit(0.0), F.lit("warn"), "a source of depth")),
        Rule("zone1_untouched", f, inside, F.when(inside == 0, "pass").otherwise("fail"), "0"),
        Rule("fill_weight", f, weight, F.when(weight.isNull() | (weight < 1.0), "pass").otherwise("fail"), "< 1"),
        at_most("holdout_error_pct", f, held, *lim["holdout_pct"], "%"),
        at_most("seconds", t, seconds, lim["fusion_s"], 2 * lim["fusion_s"], "s"),
    ]


def reconstruction_rules(lim: dict, mesher: str = "openmvs_delaunay") -> list[Rule]:
    """Registration, metric checks with a gate that caps the score, depth, mesh, run time."""
    s, m, b, d, r = "sparse", "metric", "depth", "dense", "runtime"
    rms, height, kept = num("cam_vs_gps_rms_m"), num("height_error_pct"), text("gps_refinement.kept")
    refined = F.coalesce(text("gps_refinement.enabled") == "true", F.lit(False)) & kept.isNotNull()
    accurate, used = F.coalesce(text("dense.mode"), F.lit("auto")) == "A", F.coalesce(text("dense.engine") == "vggt_hybrid", F.lit(False))
    engine, meshed = text("dense.engine"), text("mesh.mesher")
    timings = F.from_json(text("timings_s"), "map<string, double>")
    downgrades = F.from_json(text("downgrades"), "array<string>")
    count = lambda x: F.coalesce(F.size(F.from_json(text(x), "array<string>")), F.lit(0))
    return [
        at_least("registered_fraction", s, F.coalesce(num("registered_fraction"), F.lit(0.0)), *lim["registered"]),
        at_most("models", s, F.coalesce(num("models"), F.lit(1.0)) - F.coalesce(num("models_merged"), F.lit(0.0)), *lim["models"]),
        at_most("reproj_px", s, num("reproj_px"), *lim["reproj_px"], "px"),
        at_least("track_length", s, F.coalesce(num("track_length"), F.lit(0.0)), *lim["track_length"]),
        holds("focal_source", m, F.startswith(text("focal_source"), F.lit("telemetry")), target="telemetry"),
        at_most("cam_vs_gps_rms_m", m, rms, *lim["gps_rms_m"], "m"),
        *where(rms.isNotNull(), at_most("geometry_gate", m, rms, lim["gate_m"], lim["gate_m"], "m", lim["gate_cap"])),
        *where(refined, holds("gps_refinement", m, kept == "GPS-prior refinement", target="GPS-prior refinement")),
        *where(~refined & text("gps_refinement.skipped").isNotNull(), info("gps_refinement", m, F.lit(None))),
        Rule("height_error_pct", m, height, F.when(height.isNull(), "info").when(F.abs(height) <= lim["height_pct"][0], "pass").when(F.abs(height) <= lim["height_pct"][1], "warn").otherwise("fail"), f"within {lim['height_pct'][0]:g}", "%"),
        *where(accurate, info("depth_used", b, F.lit(0.0))),
        *where(~accurate, holds("depth_used", b, used)),
        *where(~accurate & used, at_least("frames_anchored", b, share(num("dense.frames_anchored"), num("dense.frames")), *lim["anchored"]), info("views_per_point", b, num("dense.views_per_point_median"))),
        *where(~accurate & used & num("dense.anchor_spread_median_pct").isNotNull(), at_most("anchor_spread_pct", b, num("dense.anchor_spread_median_pct"), *lim["anchor_spread_pct"], "%")),
        holds("dense_engine", d, engine.isNotNull(), "fail", "any"),
        *where(engine.isNotNull(), info("dense_points", d, num("dense.points")), info("footprint_m2", d, num("dense.footprint_m2"), "m2")),
        Rule("mesher", d, F.lit(None), F.when(meshed == mesher, "pass").when(meshed.isNotNull(), "warn").otherwise("fail"), mesher),
        *where(num("mesh.faces_per_vertex").isNotNull(), at_least("faces_per_vertex", d, num("mesh.faces_per_vertex"), *lim["faces_per_vertex"])),
        holds("textured", d, text("textured") == "true"),
        *where(num("texture.black_pct").isNotNull(), at_most("texture_black_pct", d, num("texture.black_pct"), *lim["texture_black_pct"], "%")),
        holds("using_cuda", r, text("using_cuda") == "true"),
        info("downgrades", r, F.coalesce(F.size(downgrades), F.lit(0))),
        info("track_a_seconds", r, F.aggregate(F.coalesce(F.map_values(timings), F.array().cast("array<double>")), F.lit(0.0), lambda a, x: a + x), "s"),
        *where(count("degradations") > 0, info("budget_degradations", r, count("degradations"))),
    ]


def export_rules(lim: dict) -> list[Rule]:
    """Placement, heights, control points, files that were opened again, classes, coverage."""
    p, f, c = "georeferencing", "formats", "coverage"
    frame = text("georef.frame").isNotNull()
    heights = text("georef.frame.vertical_epsg").isNotNull() | (text("georef.frame.gps_altitude_datum") == "orthometric")
    check, coverage = num("georef.gcp.check_rms_m"), num("coverage.coverage_pct")
    layers = F.coalesce(F.from_json(text("files.las.layers"), "array<string>"), F.array().cast("array<string>"))
    zones = (text("files.glb_zones.readable") == "true") & F.array_contains(layers, "zone") & text("files.geojson_gaps").isNotNull()
    return [
        holds("referenced", p, frame, "fail"),
        *where(
            frame, holds("vertical_datum", p, heights, target="orthometric"), at_most("cam_vs_gps_rms_m", p, num("georef.rms_all_m"), *lim["gps_rms_m"], "m"),
            at_least("inlier_fraction", p, share(num("georef.inliers"), num("georef.cameras")), *lim["inliers"]), info("ground_constraint", p, (F.coalesce(text("georef.ground_constraint"), F.lit("false")) == "true").cast("double")),
        ),
        *where(frame & check.isNotNull(), at_most("gcp_check_rms_m", p, check, *lim["check_rms_m"], "m")),
        *where(frame & text("georef.gcp").isNotNull(), Rule("gcp_control", p, F.coalesce(num("georef.gcp.control"), F.lit(0.0)), F.when(num("georef.gcp.control") > 0, "info").otherwise("warn"))),
        *(holds(f"format_{x}", f, text(f"files.{x}.readable") == "true", "fail", "written and readable") for x in FORMATS),
        *has("files.glb_confidence", holds("confidence_layer", f, text("files.glb_confidence.readable") == "true", target="written")),
        *has("zones", holds("zones_layer", f, zones, target="written")),
        *has("files.las", holds("las_classified", f, num("files.las.ground_share") > 0, target="ground class present")),
        at_least("coverage_pct", c, coverage, *lim["coverage_pct"], "%"),
        *has("files.geotiff_dsm", info("dsm", c, num("files.geotiff_dsm.valid_fraction"))),
    ]


def report_rules(lim: dict, stages: list[str]) -> list[Rule]:
    """The viewer, accuracy against a reference, and what makes a run complete, with its time for ten minutes of video."""
    v, q, d = "viewer", "report", "done"
    z1, z2 = num("accuracy.zone1.rms_m"), num("accuracy.zone2.rms_m")
    n1, n2 = num("accuracy.zone1.nmad_m"), num("accuracy.zone2.nmad_m")
    state = F.from_json(text("stages"), "map<string, struct<status: string, duration_s: double>>")
    open_ = F.filter(F.array(*map(F.lit, stages)), lambda s: ~F.coalesce(F.element_at(state, s)["status"].isin("done", "skipped"), F.lit(False)))
    spent = F.aggregate(F.map_values(F.map_filter(state, lambda k, s: (s["status"] == "done") & (k != "qa"))), F.lit(0.0), lambda a, s: a + F.coalesce(s["duration_s"], F.lit(0.0)))
    projected = spent * 600 / num("video_s")
    produced = F.coalesce(F.size(F.from_json(text("produced"), "array<string>")), F.lit(0))
    size = F.coalesce(num("viewer.scene_mb"), F.lit(0.0))
    rms = num("georef_rms_m")
    return [
        holds("viewer_built", v, text("viewer.built") == "true", "fail", "all files"),
        holds("layer_zones", v, text("viewer.zones") == "true", target="available"),
        holds("layer_texture", v, text("viewer.texture") == "true", target="available"),
        at_most("scene_mb", v, size, lim["scene_mb"], float("inf"), "MB"),
        *where(text("accuracy").isNull(), info("reference", q, F.lit(None))),
        *where(z1.isNotNull(), at_most("zone1_rms_m", q, z1, *lim["zone1_rms_m"], "m")),
        *where(n1.isNotNull() & n2.isNotNull(), holds("zones_rank_accuracy", q, n1 <= n2)),
        *where(text("accuracy").isNotNull(), Rule("zone2_reported", q, z2.isNotNull().cast("double"), F.when(z2.isNotNull(), "pass").otherwise("info"), "yes")),
        *where(num("accuracy.shift_m").isNotNull(), at_most("horizontal_shift_m", q, num("accuracy.shift_m"), *lim["shift_m"], "m")),
        Rule("end_to_end", d, F.size(open_), F.when(F.size(open_) == 0, "pass").otherwise("fail"), "0 open stages"),
        *where(num("video_s") > 0, at_most("projected_10min_s", d, projected, lim["projected_s"], 2 * lim["projected_s"], "s")),
        Rule("six_formats", d, produced, F.when(produced >= 6, "pass").otherwise("warn"), ">= 6"),
        holds("rms_reported", d, rms.isNotNull(), "fail", "reported"),
        holds("coverage_and_gaps", d, num("coverage_pct").isNotNull() & (text("gaps_file") == "true"), target="both"),
        holds("zone_accuracy", d, z1.isNotNull() & z2.isNotNull(), target="both"),
    ]


def condition_rules(lim: dict) -> list[Rule]:
    """The four parts of conditioning."""
    return [*artifact_rules(lim), *illumination_rules(lim), *dynamic_rules(lim), *gps_rules(lim)]


STAGE_CARDS = {"condition": condition_rules, "fusion": fusion_rules, "reconstruction": reconstruction_rules, "export": export_rules}


def stage_card(reports: DataFrame, keys: list[str], rules: list[Rule]) -> DataFrame:
    """KPI rows of ``reports(keys, report)``; a missing or empty report is one failed row."""
    there = F.col("`report:there`")
    reports = reports.withColumn("report:there", F.coalesce(F.size(F.json_object_keys("report")) > 0, F.lit(False)))
    for part in PARTS:
        reports = reports.withColumn(f"report:{part}", F.from_json(text(part) if part else F.col("report"), "map<string, string>"))
    return scorecard(reports, keys, [*where(~there, holds("report", "report", F.lit(False), "fail", "present")), *where(there, *rules)])
