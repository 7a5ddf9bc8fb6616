"""Nearest rows of dense clouds against brute force."""

import numpy as np

from skyloom.operators import cloud


def test_k_nearest_of_dense_places_and_copies(spark):
    rng = np.random.default_rng(4)
    xyz = np.concatenate([rng.normal(0, 0.02, (150, 3)), rng.uniform(-1, 1, (60, 3)), np.repeat([[0.5, 0.5, 0.5]], 12, 0)]).round(4)
    df = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(xyz)], "id long, x double, y double, z double")
    got = cloud.k_nearest(df, df, "id", "id", ["x", "y", "z"], 0.5, 2, exclude_self=True, crowd=2, pairs=10).collect()
    want = set()
    for i, p in enumerate(xyz):
        near = sorted((float(np.sqrt(((p - q) ** 2).sum())), j) for j, q in enumerate(xyz) if j != i)
        want |= {(i, j, k + 1) for k, (d, j) in enumerate(near[:2]) if d <= 0.5}
    assert {(r.id, r.other, r["__k"]) for r in got} == want and len(got) == len(want)


def test_near_copies_in_one_place_make_few_pairs(spark):
    df = spark.range(4000).selectExpr("id", "0.1 as x", "0.2 as y", "0.3 as z").selectExpr("id", *(f"cast({c} as double) as {c}" for c in "xyz"))
    rows = cloud.nearest_within(df, df, "id", "id", ["x", "y", "z"], 0.5, exclude_self=True)
    assert rows.where("id > 0 and nearest = 0 and distance = 0").count() == 3999 and rows.where("id = 0").first().nearest == 1


def test_strip_pairs_join_on_heading_too(spark, tmp_path):
    from skyloom.plans.cloud_queries import strip_pairs

    spark.range(9).selectExpr("id as s_suppkey", "id * 7D as s_acctbal").write.parquet(f"{tmp_path}/supplier.parquet")
    plan = strip_pairs(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert any("Join Inner" in line and "slot" in line for line in plan.splitlines())


def test_cells_are_dealt_to_tasks_by_their_pairs(spark, monkeypatch):
    near, write = [], cloud.materialise
    monkeypatch.setattr(cloud, "materialise", lambda df, label: (near.append(df) if label == "near" else None) or write(df, label))
    df = spark.range(300).selectExpr("id", "double(id % 17) as x").coalesce(1)
    got = cloud.k_nearest(df, df, "id", "id", ["x"], 0.5, 1, task=500).collect()
    assert {(r.id, r.other) for r in got} == {(k, k % 17) for k in range(300)}
    assert near and all("RepartitionByExpression" in d._jdf.queryExecution().optimizedPlan().toString() for d in near)


def test_zone_of_a_mean_that_equals_the_limit(spark):
    rng = np.random.default_rng(7)
    rows = []
    for voxel in range(200):
        values = rng.permutation(np.repeat([0.0, 0.01, 0.03, 0.05, 0.07, 0.08], 4))  # 24 values whose mean is 0.04
        rows += [(voxel, k, float(v)) for k, v in enumerate(values)]
    points = spark.createDataFrame(rows, "voxel long, view long, weight double")
    got = cloud.zones(points, "voxel", "view", "weight", 20, 0.04).collect()
    assert len(got) == 200 and {(r.views, r.confidence, r.zone) for r in got} == {(24, 0.04, 1)}
