"""Groups that hold most rows are not gathered for their quantiles."""

import hashlib

import numpy as np
from pyspark.sql import functions as F

from skyloom.operators import checks, cloud, georef, recurrences, stats
from skyloom.plans import survey_queries
from skyloom.session import parts


def test_trimmed_fit_and_depth_anchor_gather_no_group(spark):
    df = spark.range(999).selectExpr("'a' as g", "double(id % 100 + 1) as x", "2D * (id % 100 + 1) + id % 7 + if(id % 50 = 0, 500, 0) + 0D as y")
    fit, anchor = checks.trimmed_fit(df, ["g"], "x", "y"), recurrences.depth_anchor(df, "g", "x", "y")
    assert not any(f"{f}(" in made._jdf.queryExecution().optimizedPlan().toString() for made in (fit, anchor) for f in ("percentile", "median"))
    x, y = (np.array(v) for v in zip(*((r.x, r.y) for r in df.collect()), strict=True))
    scale = np.median(y / x)
    assert np.allclose(anchor.first()[1:], (scale, 100 * np.median(abs(y / x / scale - 1))))
    a, b = np.polyfit(x, y, 1)
    for _ in range(3):
        r = abs(y - a * x - b)
        near = r <= np.quantile(r, 0.9)
        a, b = np.polyfit(x[near], y[near], 1)
    assert np.allclose(fit.select("gain", "bias").first(), (a, b))


def test_lite_mesh_weights_by_halves_whatever_the_order(spark, tmp_path):
    weights = [1, 3, 3, 2, 5, 2, 2, 6, 2, 4, 0, 4, 4, 5, 6, 2, 6, 8, 6, 8, 6, 6, 1, 0, 1, 0, 6, 1, 0, 1, 5, 1]  # 1.07 of 32: 0.0334375
    rows = [(k, 1, 1, 3, "A", "F", 1.0, 0.05, 1500.0, w / 100) for k, w in enumerate(weights)]
    columns = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_returnflag string, l_linestatus string, l_quantity double, l_discount double, l_extendedprice double, l_tax double"
    spark.createDataFrame(rows, columns).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert [tuple(r) for r in survey_queries.lite_mesh(spark, str(tmp_path)).collect()] == [("A", 1.0, 5.0, 2.0, 32, 0.033438, -1.0, 2)]


def _written(monkeypatch, module):
    """Rows of what ``module`` writes, by label."""
    rows, write = {}, module.materialise

    def counted(df, label):
        made = write(df, label)
        rows[label] = made.count()
        return made

    monkeypatch.setattr(module, "materialise", counted)
    return rows


def test_hash_pairs_compare_whole_hashes_of_few_rows(spark, monkeypatch):
    rows = _written(monkeypatch, stats)
    df = spark.range(3000).selectExpr("id % 2 as k", "id as x")
    got = {(r.k, r["__k"]): (r.p.x, r.q.x) for r in stats.hash_pairs(df, "k", F.col("x").cast("string"), ["x"], 10).collect()}
    held = {}
    for x in range(3000):
        h = hashlib.md5(f"{x}:0".encode()).hexdigest()
        held.setdefault((x % 2, int(h[:6], 16) % 10), []).append((h, x))
    assert got == {k: (min(v)[1], max(v)[1]) for k, v in held.items()}
    assert rows == {"hash-sizes": 2, "hash-bounds": 20}


def test_robust_similarity_picks_by_a_number(spark, monkeypatch):
    rows = _written(monkeypatch, georef)
    df = spark.range(2000).selectExpr("'a' as k", "id", "double(id % 50) as x", "double(id % 11) as y", "double(id % 7) as z")
    df = df.selectExpr("*", "2 * y + 1 as u", "5 - 2 * x as v", "2 * z - 3 + if(id % 10 = 3, 300, 0) as w")
    found = georef.robust_similarity(df, ["k"], "id", ["x", "y", "z"], ["u", "v", "w"], threshold=1.0).first()
    assert np.allclose([found.scale, *found["shift"]], [2, 1, 5, -3]) and (found.cameras, found.inliers) == (2000, 1800)
    assert rows["similarity-least"] == 4 * 48


def test_weighted_fusion_deals_rows_by_their_number(spark, monkeypatch):
    assert (parts(spark.range(20_000), 1000), parts(spark.range(20), 1000)) == (20, int(spark.conf.get("spark.sql.shuffle.partitions")))
    monkeypatch.setattr(cloud, "parts", lambda df: 13)
    df = spark.range(600).selectExpr("id % 60 as v", "id as frame", "0.25D as w", "double(id % 60) as x")
    made = cloud.weighted_fusion(df, "v", "frame", "w", ["x"], 0.5, 2.0, spark.range(50).withColumnRenamed("id", "v"))
    assert made.rdd.getNumPartitions() == 13
    assert sorted(map(tuple, made.collect())) == [(v, 2.0, 10, float(v)) for v in range(50, 60)]
