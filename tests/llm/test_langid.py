import random
from collections import Counter
from math import exp, log

import pytest

from skyloom.llm.langid import evidence_of_documents, evidence_of_pages, fit, fuse, identify, text_likelihoods, trigrams

WORDS = {"en": "the and with from this that have".split(), "de": "der und mit von dieser dass haben".split()}


def labelled(spark, n=200):
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choice(WORDS[lang]) for _ in range(30)), lang, f"s{k % 3}") for k in range(n) for lang in (("en", "de")[k % 2],)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_texts(spark):
    docs = labelled(spark)
    rows = identify(evidence_of_documents(docs), docs.where("doc_id % 5 <> 0")).collect()
    assert len(rows) == 200 and all(r.lang == ("en", "de")[r.doc_id % 2] and r.sure for r in rows)


def test_other_evidence_decides_without_text(spark):
    page = lambda k, lang, host, text: (k, f"http://{host}/{k}", f'<html lang="{lang}"><body>{text}</body></html>')
    rng = random.Random(4)
    rows = [page(k, lang, f"h.{lang}.example.{lang}", " ".join(rng.choice(WORDS[lang]) for _ in range(30))) for k in range(100) for lang in (("en", "de")[k % 2],)]
    rows += [page(1000, "de", "new.example.de", ""), page(1001, "en", "h.en.example.en", ""), (1002, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r for r in identify(evidence_of_pages(pages), labelled(spark)).collect()}
    assert len(found) == 103 and found[1000].lang == "de" and found[1001].lang == "en" and found[1002].text_lang is None
    assert found[1002].probability < found[1001].probability


def test_odd_rows(spark, odd, none):
    rows = identify(evidence_of_documents(odd), labelled(spark)).collect()
    assert len(rows) == 10 and all(0 <= r.probability <= 1 for r in rows)
    assert identify(evidence_of_documents(none), labelled(spark)).count() == 0
    assert all(r.lang is None for r in identify(evidence_of_documents(odd), none).collect())


def test_a_row_is_judged_without_its_own_half(spark):
    """A text whose words stand in no other row is not told by its own label."""
    docs = labelled(spark).unionByName(spark.createDataFrame([(900, "qqq www xxx zzz kkk", "xx", "s9")], "doc_id long, text string, lang string, source string"))
    languages, model = fit(docs)
    assert languages == ["de", "en", "xx"]
    found = next(r for r in text_likelihoods(evidence_of_documents(docs), model).collect() if r.doc_id == 900).ll
    assert found[2] <= min(found[:2]) + 1e-3


def test_too_many_languages_fail(spark):
    docs = spark.createDataFrame([(k, "some text", f"l{k}") for k in range(5)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError):
        fit(docs, most=4)
    assert len(fit(docs, most=5)[0]) == 5


def test_likelihoods_and_fusion_equal_brute_force(spark):
    rng = random.Random(8)
    docs = [(k, " ".join(rng.choice(WORDS[lang]) for _ in range(rng.choice([1, 2, 30]))), lang, None) for k in range(60) for lang in (("en", "de")[k % 2],)]
    labels = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    languages, model = fit(labels)
    total = Counter()
    for _, text, lang, _ in docs:
        total.update((lang, b) for b in trigrams(text).tolist())
    for k, lang in enumerate(languages):
        of = sum(n for (x, _), n in total.items() if x == lang)
        for b in rng.sample(range(1 << 15), 50) + [b for x, b in total if x == lang][:50]:
            assert model[2, b, k] == pytest.approx(log((total[lang, b] + 0.1) / (of + 0.1 * (1 << 15))), abs=1e-4)
    rows = [(None, k, None, rng.choice([None, "en", "de"]), rng.choice([None, "com", "de"]), h and f"{h}.{d}", d, [rng.uniform(-9, 0), rng.uniform(-9, 0)]) for k in range(200) for h in (rng.choice("abc"),) for d in (rng.choice(["x.com", "y.de"]),)]
    frame = spark.createDataFrame(rows, "doc_id long, page_id long, text string, declared string, suffix string, host string, domain string, ll array<double>").drop("text")
    best = {r[1]: r[7].index(max(r[7])) for r in rows}
    every = [1 + sum(b == k for b in best.values()) - 1 for k in (0, 1)]
    prior = [(every[k] + 0.5) / (200 + 1) for k in (0, 1)]

    def shares(at, of, above, weight):
        c = [sum(best[r[1]] == k for r in rows if r[at] == of) for k in (0, 1)]
        return [(c[k] + weight * above[k]) / (sum(c) + weight) for k in (0, 1)]

    def evidence(at, value, k):
        if value is None:
            return 0.0
        seen = [r for r in rows if r[at] is not None]
        return log((sum(r[at] == value and best[r[1]] == k for r in seen) + 1) / (sum(best[r[1]] == k for r in seen) + len({r[at] for r in seen}) + 1))

    for r in fuse(frame, ["de", "en"]).collect():
        _, _, _, declared, suffix, host, domain, ll = rows[r.page_id]
        p = shares(5, host, shares(6, domain, prior, 20), 20)
        score = [ll[k] + log(p[k]) + evidence(3, declared, k) + evidence(4, suffix, k) for k in (0, 1)]
        assert r.lang == ["de", "en"][score.index(max(score))]
        assert r.probability == pytest.approx(1 / sum(exp(s - max(score)) for s in score), rel=1e-6)
