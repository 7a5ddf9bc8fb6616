"""Operator 13 against a plain version."""

import hashlib
import re
from collections import Counter
from math import floor, log
from zlib import crc32

import pyarrow as pa
import pytest

from skyloom.llm import importance
from skyloom.llm.importance import resample

UPPER = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, n):
    words = WORD.findall((text or "").translate(UPPER))
    return words, [" ".join(words[i : i + w]) for w in range(1, n + 1) for i in range(len(words) - w + 1)]


def plain(docs, target, n, buckets, percent, least, seed):
    count = lambda texts: Counter(crc32(f.encode()) % buckets for t in texts for f in features(t, n)[1])
    own, wanted = count(t for _, t in docs), count(target)
    s, t = own.total(), wanted.total()
    gain = lambda b: floor(1000 * log((wanted[b] + 1) * (s + buckets) / ((own[b] + 1) * (t + buckets))))
    out = []
    for i, text in docs:
        words, found = features(text, n)
        weight = sum(gain(crc32(f.encode()) % buckets) for f in found)
        h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
        score = None if i is None else weight + floor(-1000 * log(-log((h + 0.5) / 4294967296)))
        out.append([i, len(found), weight, score, None, i is not None and len(words) >= least])
    may = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0]))
    for place, r in enumerate(may[: len(may) * percent // 100], 1):
        r[4] = place
    return sorted((tuple(r[:5]) for r in out), key=str)


@pytest.mark.parametrize("n, slice_bytes", [(1, 4_000_000), (2, 100), (3, 4_000_000)])
def test_against_plain(spark, odd, monkeypatch, n, slice_bytes):
    monkeypatch.setattr(importance, "SLICE", slice_bytes)  # tasks of this process's forks see it
    more = spark.createDataFrame([(100 + i, f"Word{i % 7} ÄB{i % 3} the End " * (i % 40), "en", "a") for i in range(80)], "doc_id long, text string, lang string, source string")
    docs = odd.select("doc_id", "text", "lang", "source").union(more)
    target = spark.createDataFrame([("the end of word1",), (None,), ("",), ("äb1 ÄB1 the",)], "text string")
    found = resample(docs, target, n=n, buckets=50, percent=30, least_words=8)
    want = plain([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()], n, 50, 30, 8, 2024)
    assert sorted((tuple(r) for r in found.collect()), key=str) == want


def test_empty_tables(spark, odd, none):
    assert resample(none, odd.select("text")).count() == 0
    assert resample(odd, none.select("text")).count() == odd.count()


def test_words_of_slices_of_long_arrays():
    texts = [f"Ünïcode “{i}” Straße ÀB{i % 7}日本 " * (i % 50) if i % 11 else None for i in range(3000)]
    for part in importance._slices(pa.array(texts).slice(17)):
        index, words, sizes = importance._words(part)
        want = [features(t, 1)[0] for t in part.to_pylist()]
        assert [words[i].as_py() for i in index.tolist()] == [w for t in want for w in t]
        assert sizes.tolist() == [len(t) for t in want]
