import numpy as np
import pytest
import xxhash

from skyloom.llm.simhash import components, fingerprint, keep_one, links, near_duplicates, partition_bits, plan_search, thresholds


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", words)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(values, distance=4):
    left, root = set(values), {}
    while left:
        todo = [left.pop()]
        group = list(todo)
        while todo:
            x = todo.pop()
            near = {y for y in left if bin(x ^ y).count("1") <= distance}
            left -= near
            todo += near
            group += near
        for x in group:
            root[x] = min(group)
    return root


@pytest.mark.parametrize("text", [None, "", "one", "a b c", "A b C d", "é É ß d e f g", "to be or not to be or not to be " * 9])
def test_fingerprint(text):
    assert fingerprint(text) % 2**64 == brute_fingerprint(text)


def cluster(seed, n, spread):
    rng = np.random.default_rng(seed)
    centre = int(rng.integers(0, 2**63))
    out = set()
    while len(out) < n:
        x = centre
        for b in rng.choice(64, int(rng.integers(0, spread + 1)), replace=False):
            x ^= 1 << int(b)
        out.add(x)
    return out


@pytest.mark.parametrize("settings", [{}, {"joined": 4, "block": 16}])
def test_links_lose_no_component(spark, settings):
    values = {x for s in range(6) for x in cluster(s, 60, 5)} | {int(x) for x in np.random.default_rng(9).integers(0, 2**63, 300)}
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    edges = links(spark.createDataFrame([(v,) for v in signed], "fp long"), 4, **settings)
    found = {r.node: r.root for r in components(edges).collect()}
    want = roots([v % 2**64 for v in signed])
    groups = {}
    for v in signed:
        groups.setdefault(found.get(v, v), set()).add(v % 2**64)
    truth = {}
    for v, r in want.items():
        truth.setdefault(r, set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, truth.values()))


def test_thresholds_cover_the_distance():
    rng = np.random.default_rng(0)
    bits = (rng.random((500, 64)) < rng.random(64)).astype(float)
    for n in (100, 10**6, 10**10):
        search = plan_search(n, bits.T @ bits * (n / 500), 4)
        assert sum(e + 1 for _, e in search) == 5 and all(e >= 0 for _, e in search)
    groups = partition_bits(500, bits.T @ bits, 5)
    assert sorted(b for g in groups for b in g) == list(range(64))
    assert sum(e + 1 for e in thresholds(500, np.diag(bits.T @ bits) / 500, groups, 4)[1]) == 5


def test_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(900, 900)], "a long, b long")
    assert {r.root for r in components(edges).collect()} == {0}


def test_odd_rows(spark, odd, none):
    rows = near_duplicates(odd).collect()
    assert len(rows) == 10
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].fingerprint == "0" * 16 and by_id[2].component_id == by_id[3].component_id == by_id[8].component_id == 2
    assert by_id[5].component_id == by_id[6].component_id == 5
    kept = keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 4, 5, 7]
    assert near_duplicates(none).count() == 0 and keep_one(none).count() == 0
