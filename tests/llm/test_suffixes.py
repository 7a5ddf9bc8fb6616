"""Operator 11 against a plain version, its merge and its anchors on their own."""

import random

import numpy as np
import pyarrow as pa
import pytest

from skyloom.llm import suffixes
from skyloom.llm.suffixes import _Block, anchors, merge, read_run, sorted_run, without_repeats
from skyloom.session import scratch


def plain(docs, length):
    least = {}
    for i, text in docs:
        b = (text or "").encode()
        if i is not None:
            for p in range(len(b) - length + 1):
                s = b[p : p + length]
                least[s] = min(i, least.get(s, i))
    out = []
    for i, text in docs:
        b = (text or "").encode()
        gone = [False] * len(b)
        for p in range(len(b) - length + 1):
            if i is not None and least[b[p : p + length]] < i:
                gone[p : p + length] = [True] * length
        edges = [p for p in range(len(b) + 1) if (p < len(b) and gone[p]) != (p > 0 and gone[p - 1])]
        out.append((i, len(b), edges[::2], edges[1::2], bytes(x for x, g in zip(b, gone) if not g)))
    return sorted(out, key=str)


def found(docs, length):
    with scratch(docs.sparkSession):
        return sorted(((r.doc_id, r.n_bytes, r.starts, r.stops, bytes(r.kept)) for r in without_repeats(docs, length).collect()), key=str)


def both(docs, length):
    assert found(docs, length) == plain([(r.doc_id, r.text) for r in docs.collect()], length)


@pytest.mark.parametrize("length", [2, 9, 50])
def test_random_texts(spark, length):
    rng = random.Random(length)
    shared = ["".join(rng.choice("ab ") for _ in range(rng.randrange(1, 4 * length))) for _ in range(12)]
    docs = []
    for i in range(150):
        text = "".join(rng.choice([rng.choice(shared), rng.choice("cdé\x00") * rng.randrange(2 * length)]) for _ in range(rng.randrange(6)))
        docs.append((rng.randrange(100), text))
    both(spark.createDataFrame(docs, "doc_id long, text string"), length)


def test_a_text_that_holds_a_string_twice(spark):
    part, late = "it is repeated here again and once more, ", "but the end of it is also found in the first of texts"
    docs = [(1, "0" * 30 + part[20:] + late), (5, ("x" * 30 + part + late + "y" * 30) * 2), (7, part + late)]
    both(spark.createDataFrame(docs, "doc_id long, text string").repartition(3, "doc_id"), 50)


def test_many_blocks(spark, monkeypatch):
    rng = random.Random(5)
    base = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    docs = []
    for i in range(120):
        text = list(base[rng.randrange(500) : 2000 + rng.randrange(1000)])
        for _ in range(rng.randrange(15)):
            text[rng.randrange(len(text))] = "#"
        docs.append((i, "".join(text)))
    docs += [(500 + i, base) for i in range(60)]
    both(spark.createDataFrame(docs, "doc_id long, text string").repartition(12), 50)


def test_odd(spark, odd, none):
    small = odd.where("doc_id is null or doc_id <> 4").union(odd.where("doc_id is null").selectExpr("9L", "text", "lang", "source", "n_chars", "start", "score", "sequence_id"))
    both(small, 20)
    assert found(none, 50) == []
    assert len(found(odd, 50)) == odd.count()


@pytest.mark.parametrize("text", ["a" * 300, "ab" * 150, "abc" * 20 + "x" + "abc" * 20])
def test_periods(spark, text):
    both(spark.createDataFrame([(2, text), (1, text[1:-1]), (3, text[7:] + "q" + text[:61])], "doc_id long, text string"), 50)


def test_merge_never_reads_a_known_prefix():
    class Seen(bytes):
        """Bytes that note how far from the start they are read."""

        starts: list[int] = []

        def __getitem__(self, key):
            Seen.starts.append(key.start)
            return bytes.__getitem__(self, key)

    rng = random.Random(2)
    runs = [sorted({bytes(rng.choices(b"ab", k=12)) for _ in range(rng.randrange(60))}) for _ in range(7)] + [[]]
    shared = lambda x, y: next((k for k, (a, b) in enumerate(zip(x, y)) if a != b), 12)
    coded = [[(Seen(x), shared(x, run[k - 1]) if k else 0) for k, x in enumerate(run)] for run in runs]
    out = list(merge([iter(c) for c in coded], 12))
    assert [bytes(x) for _, x, _ in out] == sorted(x for run in runs for x in run)
    assert [n for _, _, n in out] == [0] + [shared(a[1], b[1]) for a, b in zip(out, out[1:])]
    # strings that go on from one game to the next are read on from where the last game ended
    assert np.mean(Seen.starts) > 3


def test_runs_round_trip():
    rng = np.random.default_rng(3)
    rows = rng.integers(0, 3, (500, 7), np.uint8)
    owners, texts, places = rng.integers(0, 50, (3, 500))
    splits = np.unique(np.array([bytes(r) for r in rows[:5]], "S7"))
    run = sorted_run(4, rows, owners, texts, places, splits).to_pydict()
    got = [s for a, b in zip(run["shared"], run["tails"]) for s, _ in read_run(a, b, 7)]
    assert got == sorted({bytes(r) for r in rows})
    assert run["part"] == sorted(set(run["part"])) and len(run["part"]) == 6
    counts = np.concatenate([suffixes._numbers(b, np.uint32) for b in run["counts"]])
    assert counts.sum() == 500 and len(counts) == len(got)


@pytest.mark.parametrize("stretch", [64, 1 << 21])
def test_every_window_has_one_anchor_that_its_bytes_decide(monkeypatch, stretch):
    monkeypatch.setattr(suffixes, "STRETCH", stretch)
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(400))).encode() for _ in range(20)]
    block = _Block(pa.table({"row": range(20), "doc_id": range(20), "text": texts}))
    a, lo, hi, h = anchors(block, 50, 26)
    at = {}
    for place, first, last in zip(a, lo, hi):
        for p in range(first, last + 1):
            assert p not in at and p <= place <= p + 24
            at[p] = place
    assert sorted(at) == [p for s, e in zip(block.starts, block.ends) for p in range(s, e - 49)]
    offset = {}
    for p, place in at.items():
        assert offset.setdefault(block.data[p : p + 50].tobytes(), place - p) == place - p
    assert (np.diff(a) > 0).all()
