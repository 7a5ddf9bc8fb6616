import random
import zlib

import numpy as np

from skyloom.llm.toxicity import fit, labelled, ngram_buckets, score_documents, stage_toxicity


def corpus(spark, n=600):
    rng = random.Random(5)
    plain = ["river", "stone", "garden", "window", "morning", "letter", "music", "paper", "winter", "bridge"]
    bad = ["vileword", "foulterm"]
    docs, labels = [], []
    for k in range(n):
        toxic = k % 5 == 0
        words = [rng.choice(plain) for _ in range(60)]
        if toxic:
            words[rng.randrange(60)] = rng.choice(bad)
            words[rng.randrange(60)] = rng.choice(bad)
        docs.append((k, " ".join(words), "en", "s", 1))
        labels.append((k, 1, int(toxic)))
    return (
        spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, score long"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_held_out_accuracy(spark):
    docs, labels = corpus(spark)
    rows = score_documents(docs, labels).collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 600 and len(held) > 60
    assert sum(r.predicted == (r.doc_id % 5 == 0) for r in held) >= 0.97 * len(held)


def test_stage_keeps_columns_and_clean_rows(spark, tmp_path):
    docs, labels = corpus(spark)
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    kept = stage_toxicity(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert len({k for k in range(600) if k % 5} - ids) <= 5 and len({k for k in range(600) if k % 5 == 0} & ids) <= 5


def test_odd_rows(spark, odd, none):
    _, labels = corpus(spark, 10)
    rows = score_documents(odd, labels).collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    assert score_documents(none, labels).count() == 0
    no_labels = labels.selectExpr("doc_id", "quality", "cast(null as int) as toxic")
    assert all(r.predicted == 0 for r in score_documents(odd, no_labels).collect())
    docs = spark.range(10).selectExpr("id as doc_id", "'t' as text")
    assert fit(docs, labels.where("toxic = 1")).intercept > 0 > fit(docs, labels.where("toxic = 0")).intercept


def test_more_than_ten_thousand_rows_are_learned_from(spark):
    ids = spark.range(15_000).selectExpr("id as doc_id")
    docs, labels = ids.selectExpr("doc_id", "'t' as text"), ids.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic")
    assert labelled(docs, labels).count() == ids.where("crc32(cast(doc_id as string)) % 5 <> 0").count() > 10_000


def test_rows_are_bounded_where_ids_repeat(spark):
    docs = spark.range(5_000).selectExpr("1L as doc_id", "concat('text ', cast(id % 500 as string)) as text").unionByName(spark.range(30).selectExpr("id as doc_id", "'t' as text"))
    labels = spark.range(30).selectExpr("id as doc_id", "1 as toxic")
    assert labelled(docs, labels, 100).count() == 100
    ids = {r.doc_id for r in labelled(docs, labels, 10_000).collect()}
    assert labelled(docs, labels, 10_000).count() == len(ids) + 500 and 1 in ids


def test_weights_equal_a_plain_fit(spark):
    """The summed gradients lead where a dense fit in NumPy over the same features leads."""
    docs, labels = corpus(spark, 200)
    y, texts = {r.doc_id: r.toxic for r in labels.collect()}, {r.doc_id: r.text for r in docs.collect()}
    train = [k for k in texts if zlib.crc32(str(k).encode()) % 5]
    held = [np.unique(ngram_buckets(texts[k])) for k in train]
    buckets = np.unique(np.concatenate(held))
    x = np.array([np.isin(buckets, h) for h in held], float)
    t = np.array([y[k] for k in train])
    ratio = np.log((x[t == 1].sum(0) + 0.5) / ((t == 1).sum() + 1)) - np.log((x[t == 0].sum(0) + 0.5) / ((t == 0).sum() + 1))
    z4 = (ratio**2 / (1 / (x[t == 1].sum(0) + 0.5) + 1 / (x[t == 0].sum(0) + 0.5))) ** 2
    ratio *= z4 / (z4 + 81)
    cost = np.where(t == 1, 0.25 / (t == 1).sum(), 0.25 / (t == 0).sum()) + 0.5 / len(t)
    w, b = np.zeros(len(buckets)), 0.0
    z = x * ratio
    step = 4 / (np.linalg.norm(np.c_[z, np.ones(len(t))] * np.sqrt(cost)[:, None], 2) ** 2 + 4e-3)
    for _ in range(5_000):
        slope = cost * (1 / (1 + np.exp(-(z @ w + b))) - t)
        w, b = w - step * (z.T @ slope + 1e-3 * w), b - step * slope.sum()
    model = fit(docs, labels)
    at = dict(zip(model.buckets.tolist(), model.weights.tolist(), strict=True))
    found = np.array([sum(at.get(i, 0.0) for i in h.tolist()) + model.intercept for h in held])
    assert np.abs(1 / (1 + np.exp(-found)) - 1 / (1 + np.exp(-(z @ w + b)))).max() < 0.02
