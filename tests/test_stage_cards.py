"""Cards of the stages from JSON reports."""

from skyloom.operators import stage_cards as cards


def test_each_part_of_a_report_is_parsed_once(spark):
    whole = '{"artifacts": {"frames_evaluated": 20, "frames_corrected": 2, "keypoints_vetoed": null}, "gps": "text", "illumination": {"exposure_chain": {"frames": 4, "rejected_links": 1}}}'
    reports = spark.createDataFrame([(1, whole), (2, "{}"), (3, None), (4, "{broken")], "i int, report string")
    made = cards.stage_card(reports, ["i"], cards.condition_rules(cards.LIMITS))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("get_json_object") == 0 and plan.count("jsonObjectKeys") == 1 and plan.count("from_json") <= len(cards.PARTS)
    rows = {(r.i, r.key): (r.value, r.status) for r in made.collect()}
    assert rows[1, "correct_fraction"] == (0.1, "pass") and rows[1, "keypoints_vetoed"] == (0.0, "info") and rows[1, "exposure_rejected_links"] == (1.0, "fail")
    assert (1, "gps_report") not in rows and rows[1, "dynamic_report"] == (0.0, "info")
    assert [k for k in rows if k[0] > 1] == [(i, "report") for i in (2, 3, 4)]
