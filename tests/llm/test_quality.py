import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.llm.quality import _distance, judge, keep_good, robust_estimates

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORDS.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    covered = {j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_statistics_equal_brute_force(odd):
    texts = {r.doc_id: r.text for r in odd.collect()}
    rows = judge(odd).collect()
    assert len(rows) == 10
    for r in rows:
        n = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 10 or 100 * n[4] > 20 * n[0])
        assert not (r.base_failed and r.kept)


def test_outliers_go_and_clean_rows_stay(spark):
    rows = [(k, " ".join(f"word{(k * 7 + j * j) % 5000}" for j in range(20 + k % 60)), "en", "a") for k in range(400)]
    rows += [(1000 + k, " ".join(f"#|$%{j}&&&" for j in range(30)), "en", "a") for k in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in keep_good(docs).select("doc_id").collect()}
    assert kept == {k for k in range(400)}
    assert kept == {r.doc_id for r in judge(docs).where("kept").collect()}


def plain_mcd(x, floors, bins=64, keep=0.75, consistency=1.33, trials=2, steps=15):
    """The estimate in NumPy: the same starts, the share of rows by the same bins."""
    n, p = x.shape
    place = lambda q: (np.sort(np.floor(x * 512), axis=0)[int(np.ceil(q * n)) - 1] + 0.5) / 512
    med, scale = place(0.5), np.sqrt(((place(0.75) - place(0.25)) / 1.349) ** 2 + np.square(floors) + 1e-12)
    z = (x - med) / scale
    t, u = np.tanh(z), z / np.sqrt((z**2).sum(1) + 1e-12)[:, None]
    tried = []
    for v in (None, t.T @ t / n, u.T @ u / n):
        r = np.eye(p) if v is None else v / np.outer(np.sqrt(np.diag(v) + 1e-9), np.sqrt(np.diag(v) + 1e-9))
        np.fill_diagonal(r, 1)
        tried.append((0.0, med, r * np.outer(scale, scale)))

    def step(m, c):
        d = np.einsum("ni,ij,nj->n", x - m, np.linalg.inv(c), x - m)
        b = np.floor(np.log2(d + 1e-6) * bins)
        limit = np.sort(b)[int(np.ceil(keep * n)) - 1]
        w = np.where(b < limit, 1.0, np.where(b == limit, (keep * n - (b < limit).sum()) / (b == limit).sum(), 0.0))
        m = w @ x / w.sum()
        c = consistency * ((x * w[:, None]).T @ x / w.sum() - np.outer(m, m)) + np.diag(np.square(floors))
        return np.linalg.slogdet(c)[1], m, c

    for _ in range(trials):
        tried = [step(m, c) for _, m, c in tried]
    best = min(tried, key=lambda e: e[0])
    for _ in range(steps):
        before, best = best[0], step(*best[1:])
        if abs(best[0] - before) < 1e-4:
            break
    return best


@pytest.mark.parametrize("seed", [3, 4])
def test_estimate_equals_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    groups = {"a": rng.multivariate_normal([1, -2, 0], [[1, 0.6, 0], [0.6, 2, 0.3], [0, 0.3, 0.5]], 900), "b": rng.normal(size=(150, 3)) * [1, 5, 0.1], "c": rng.normal(size=(4, 3))}
    groups["a"][:180] += [9, -9, 0]  # a fifth of outliers on one side
    floors = (0.01, 0.02, 0.0)
    rows = spark.createDataFrame([(g, *map(float, r)) for g, x in groups.items() for r in x], "g string, x_0 double, x_1 double, x_2 double")
    found = {r.g: r for r in robust_estimates(rows, 3, floors, keys=["g"]).collect()}
    for g, x in groups.items():
        logdet, m, c = plain_mcd(x, floors)
        r = found[g]
        assert r.n == len(x) and r.logdet == pytest.approx(logdet, abs=1e-5)
        assert np.allclose([r.m_0, r.m_1, r.m_2], m, atol=1e-6)
        assert np.allclose([r[f"c_{i}_{j}"] for i in range(3) for j in range(i + 1)], [c[i, j] for i in range(3) for j in range(i + 1)], atol=1e-6)
    r = found["a"]
    k = np.array([[r[f"k_{i}_{j}"] if j <= i else 0.0 for j in range(3)] for i in range(3)])
    d = (((groups["a"] - [r.m_0, r.m_1, r.m_2]) @ k.T) ** 2).sum(1)
    assert (d[:180] > 30).all() and np.median(d[180:]) < 5
    one = spark.createDataFrame([(float(v[0]), float(v[1]), float(v[2])) for v in groups["a"]], "x_0 double, x_1 double, x_2 double")
    named = one.crossJoin(spark.createDataFrame([r]))
    assert np.allclose(np.sort(d), [v.d for v in named.select(_distance(3).alias("d")).orderBy("d").collect()])


def test_clashing_columns_and_empty(odd, none):
    assert keep_good(odd).columns == odd.columns
    assert judge(none).count() == 0 and keep_good(none).count() == 0
    assert keep_good(odd.withColumn("lang", F.lit(None).cast("string"))).count() > 0
    clash = odd.withColumn("__q_words", F.lit("x")).withColumn("m_0", F.lit(1)).withColumn("kept", F.lit(0))
    assert keep_good(clash).columns == clash.columns and keep_good(clash).count() == keep_good(odd).count()


def _plain(rng, n):
    return " ".join(rng.choice("the river runs under old stone bridges while people walk home at night".split()) for _ in range(n))


def test_small_languages_and_junk_sources_are_judged_by_larger_pools(spark):
    rng = random.Random(6)
    rows = [(k, _plain(rng, 60 + k % 40), "en", "a") for k in range(300)]
    rows += [(1000 + k, _plain(rng, 70), "xx", "b") for k in range(4)]  # a language of a few rows: the pool of all
    rows += [(2000 + k, "#" if k >= 10 else _plain(rng, 70), "en", "junk") for k in range(260)]  # ten pass the base rules: its language
    long = " ".join(f"#|$%{j}&&&" for j in range(30))
    rows += [(9000, long, "xx", "b"), (9001, long, "en", "junk"), (9002, long, "en", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = {r.doc_id: r for r in judge(docs).collect()}
    assert sum(found[k].base_failed for k in range(2000, 2260)) == 250
    for k in (9000, 9001, 9002):
        assert not found[k].base_failed and found[k].distance2 is not None and not found[k].kept
    assert found[1000].kept and found[2000].kept and found[1].kept
