import corpus_pipeline
from skyloom.llm import registry


def test_stages_run_over_files(spark, tmp_path):
    from tests.llm.test_toxicity import corpus

    docs, labels = corpus(spark, 300)
    docs = docs.selectExpr("doc_id", "concat(text, ' number', cast(doc_id * 7919 as string), ' more', cast(doc_id * 31 as string)) as text", "lang", "source", "cast(1 as long) as n_chars")
    docs.unionByName(docs.where("doc_id = 1").selectExpr("9000L as doc_id", "text", "lang", "source", "n_chars")).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    kept = set(rows.doc_id)
    assert 9000 not in kept and 1 in kept and len(kept & {k for k in range(300) if k % 5}) > 225
    assert rows.groupby("sequence_id").length.sum().max() <= 1024


def test_each_stage_equals_its_operator_and_a_plain_pass(spark, tmp_path):
    """What the stages leave out is what fails their rules, checked row by row."""
    from skyloom.llm.quality import judge
    from skyloom.llm.similar import jaccard
    from skyloom.llm.toxicity import score_documents
    from tests.llm.test_quality import brute
    from tests.llm.test_toxicity import corpus

    docs, labels = corpus(spark, 120)
    docs = docs.selectExpr("doc_id", "concat(text, ' n', cast(doc_id * 7919 as string)) as text", "lang", "source", "cast(1 as long) as n_chars")
    more = spark.createDataFrame([(900, "word " * 40, "en", "s", 1), (901, "too short", "en", "s", 1), (902, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    near = docs.where("doc_id in (1, 2, 3)").selectExpr("doc_id + 500 as doc_id", "concat(text, ' end') as text", "lang", "source", "n_chars")
    docs = docs.unionByName(more).unionByName(near)
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    texts = {r.doc_id: r.text for r in docs.collect()}
    scores = {r.doc_id: r.score for r in score_documents(docs, labels).collect()}
    clean = stages["toxicity"](spark, docs, str(tmp_path))
    assert {r.doc_id for r in clean.collect()} == {k for k, x in scores.items() if x < 0.5}
    good = stages["quality"](spark, clean, str(tmp_path))
    kept = {r.doc_id for r in good.collect()}
    assert kept == {r.doc_id for r in judge(clean).where("kept").collect()}
    for k in {r.doc_id for r in clean.collect()} - kept:
        n, _, _, _, repeated = brute(texts[k])
        assert n < 10 or 100 * repeated > 20 * n
    one = {r.doc_id for r in stages["near_duplicates"](spark, good, str(tmp_path)).collect()}
    group = {k: min([j for j in kept if jaccard(texts[j], texts[k]) >= 0.8]) for k in kept}
    assert one == {k for k, least in group.items() if least == k}
    packed = stages["packing"](spark, good, str(tmp_path)).toPandas()
    assert (packed.groupby("doc_id").length.sum() == packed.groupby("doc_id").doc_tokens.first()).all() and set(packed.doc_id) == kept


def test_odd_tables(spark, odd, none, tmp_path):
    """Nulls, empty and very long texts, repeated rows, clashing columns; a table without rows."""
    from tests.llm.test_toxicity import corpus

    clash = odd.selectExpr("*", "7 as __toxicity", "'x' as __q_words", "1 as node", "2 as bands", "3 as fp")
    for name, docs in (("odd", clash), ("none", none)):
        folder = f"{tmp_path}/{name}"
        docs.write.parquet(f"{folder}/documents.parquet")
        corpus(spark, 10)[1].where("doc_id <> 5").write.parquet(f"{folder}/labels.parquet")  # no toxic one among them
        stages = dict(corpus_pipeline.STAGES)
        for stage in ("toxicity", "quality", "near_duplicates"):
            assert stages[stage](spark, docs, folder).columns == docs.columns
        rows = corpus_pipeline.run(spark, folder).collect()
        kept = {r.doc_id for r in rows}
        assert kept <= {1, 4, 5} and (5 in kept or name == "none")
        assert sum(r.length for r in rows) == sum({r.doc_id: r.doc_tokens for r in rows}.values())


def test_registry_names():
    assert sorted(k for k in registry.queries() if k.startswith("op")) == sorted(
        ["op1_packing", "op2_license_scan", "op3_quality_rules", "op4_sharding", "op5_toxicity", "op6_media_columns", "op7_simhash", "op8_bpe", "op9_warc_derivatives", "op10_language_id"]
    )
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_duplicates", "packing"]
