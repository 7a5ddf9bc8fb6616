"""SimHash near-duplicates by the generalised pigeonhole principle (operator 7).

Fingerprints of equal texts are equal, so the search runs on distinct fingerprints. Their bits are grouped
into partitions of correlated bits; a dynamic program gives each partition its own threshold ``e`` (-1 leaves
it out) such that the sum of ``e + 1`` is one more than the distance sought: any two fingerprints within that
distance then agree within ``e`` bits on some partition. The program minimises estimated probes and candidate
pairs, from bit counts over all fingerprints. Each fingerprint is filed under its value on every partition and,
where ``e > 0``, probes the values within ``e`` flips; rows that meet under one value are verified.

Values with few rows are verified in a join that returns links only. A value with more is dealt in blocks;
each pair of blocks is verified in a task of bounded size that returns a spanning forest, which keeps
every component. Components come from alternating large-star and small-star rounds on written tables.

Edge cases: null and empty texts have fingerprint zero and link like any other; a null id takes part in links
but is never a component's id unless all its ids are null; repeated rows stay one row each; an empty table
gives no rows; other columns are ignored by ``near_duplicates`` and kept by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.session import materialise, unused

BITS = 64
SEED = 42
#: Rows under one value up to which pairs are verified in a join.
JOINED = 128
#: Rows of a block; a task verifies two blocks at most.
BLOCK = 4096
#: Cost of a probe row in candidate pairs.
PROBE_COST = 20.0

_LOWER = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))


def normal_words(text: str | None) -> list[bytes]:
    """The words of a text in lower case (ASCII), cut at white space."""
    return (text or "").encode().translate(_LOWER).split()


def fingerprint(text: str | None, width: int = 4) -> int:
    """Majority bits of the XXH64 of all ``width``-word shingles, as a signed 64-bit number."""
    words = normal_words(text)
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    n = max(1, len(words) - width + 1)
    last = ends[min(width, len(words)) - 1 :]
    h = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 65536):
        spans = zip(starts[at : min(n, at + 65536)].tolist(), last[at : at + 65536].tolist(), strict=False)
        hashes = np.array([h(joined[a:b], SEED) for a, b in spans], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 4) -> DataFrame:
    """(doc_id, text_hash, fp) of every whole text of ``docs(doc_id, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                fp = pa.array([fingerprint(t, width) for t in part.column(2).to_pylist()], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), fp], ["doc_id", "text_hash", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def bit_statistics(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and the 64 x 64 counts of bits set together, summed in Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        n = 0
        for batch in batches:
            x = batch.column(0).to_numpy(zero_copy_only=False)
            bits = np.unpackbits(x.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
            n += len(x)
        cells = np.append(total.ravel(), n).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells.size)), pa.array(cells)], ["cell", "n"])

    cells = fps.select("fp").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    flat = np.zeros(BITS * BITS + 1)
    flat[cells["cell"]] = cells["n"]
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def partition_bits(n: int, together: np.ndarray, parts: int) -> list[list[int]]:
    """Groups of nearly equal size; each starts with the lowest free bit and takes those most correlated with it."""
    p = np.diag(together) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    correlation = np.abs((together / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    free, out = list(range(BITS)), []
    for k in range(parts):
        size = (BITS * (k + 1)) // parts - (BITS * k) // parts
        group = [free.pop(0)]
        while len(group) < size:
            best = max(free, key=lambda b: (correlation[b, group].sum(), -b))
            free.remove(best)
            group.append(best)
        out.append(sorted(group))
    return out


def thresholds(n: int, p: np.ndarray, groups: list[list[int]], distance: int) -> tuple[float, list[int]]:
    """Least estimated cost and the threshold of each group: dynamic programming over what is left to allot."""
    cost = []
    for group in groups:
        differ = np.array([1.0])  # distribution of the number of differing bits of two fingerprints
        for b in group:
            q = 2 * p[b] * (1 - p[b])
            differ = np.convolve(differ, [1 - q, q])
        row = [0.0]
        for e in range(distance + 1):
            probes = n * sum(comb(len(group), k) for k in range(e + 1))
            row.append(PROBE_COST * probes + n * n / 2 * differ[: e + 1].sum())
        cost.append(row)
    best = {0: (0.0, [])}
    for row in cost:
        best = {
            t: min((best[t - e][0] + row[e], best[t - e][1] + [e - 1]) for e in range(min(t, distance + 1) + 1) if t - e in best)
            for t in range(distance + 2)
            if any(t - e in best for e in range(min(t, distance + 1) + 1))
        }
    return best[distance + 1]


def plan_search(n: int, together: np.ndarray, distance: int = 4) -> list[tuple[list[int], int]]:
    """Partitions in use with their thresholds, for the number of partitions that costs least."""
    p = np.diag(together) / max(n, 1)
    plans = []
    for parts in range(2, distance + 3):
        groups = partition_bits(n, together, parts)
        cost, es = thresholds(n, p, groups, distance)
        plans.append((cost, [(g, e) for g, e in zip(groups, es, strict=True) if e >= 0]))
    return min(plans, key=lambda x: x[0])[1]


def _value(fp: Column, bits: list[int]) -> Column:
    """The bits of a partition, side by side, each run of adjacent bits moved at once."""
    out, k = F.lit(0).cast("long"), 0
    while k < len(bits):
        run = 1
        while k + run < len(bits) and bits[k + run] == bits[k] + run:
            run += 1
        piece = F.shiftrightunsigned(fp, bits[k]).bitwiseAND(F.lit((1 << run) - 1)) if run < BITS else fp
        out = out.bitwiseOR(F.shiftleft(piece, k))
        k += run
    return out


def _filed(fps: DataFrame, search: list[tuple[list[int], int]]) -> DataFrame:
    """(key, own, fp): each fingerprint under its own value of every partition and under the larger values it probes."""

    def entry(k: int, bits: list[int], e: int) -> Column:
        masks = [sum(1 << b for b in c) for r in range(e + 1) for c in combinations(range(len(bits)), r)]
        value = _value(F.col("fp"), bits)
        return F.transform(
            F.array(*(F.lit(m).cast("long") for m in masks)),
            lambda m: F.struct(value.bitwiseXOR(m).alias("to"), value.alias("v"), F.lit(k).cast("long").alias("k")),
        )

    entries = [entry(k, bits, e) for k, (bits, e) in enumerate(search)]
    rows = fps.select("fp", F.explode(F.concat(*entries)).alias("x")).where("x.to >= x.v")
    return rows.select((F.col("x.k") * (1 << 56) + F.col("x.to")).alias("key"), (F.col("x.to") == F.col("x.v")).alias("own"), "fp")


def _forest(group: pd.DataFrame, distance: int) -> pd.DataFrame:
    """A spanning forest of the links among a group's fingerprints."""
    left = np.unique(group["fp"].to_numpy(np.int64)).view(np.uint64)
    a, b = [], []
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            x = frontier.pop()
            near = np.bitwise_count(left ^ x) <= distance
            if near.any():
                found, left = left[near], left[~near]
                a.append(np.full(len(found), x))
                b.append(found)
                frontier.extend(found)
    cat = lambda x: np.concatenate(x).view(np.int64) if x else np.zeros(0, np.int64)
    return pd.DataFrame({"a": cat(a), "b": cat(b)})


def links(fps: DataFrame, distance: int = 4, *, joined: int = JOINED, block: int = BLOCK) -> DataFrame:
    """Links (a, b) among distinct ``fps(fp)``: all of those that meet under small values, spanning forests for the rest."""
    n, together = bit_statistics(fps)
    filed = _filed(fps, plan_search(n, together, distance))
    sizes = filed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    filed = filed.join(sizes, "key")
    few = filed.where(F.col("n") <= joined).select("key", "own", "fp")
    x, y = few.alias("x"), few.alias("y")
    near = (F.col("x.fp") < F.col("y.fp")) & (F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= distance)
    small = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.own") | F.col("y.own")) & near).select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))

    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    many = filed.where(F.col("n") > joined).select("key", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    many = many.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    large = many.groupBy("key", "i", "j").applyInPandas(lambda g: _forest(g, distance), "a long, b long")
    return small.unionByName(large)


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root): every node of ``edges(a, b)`` with the smallest node it reaches.

    Alternating large-star and small-star rounds; each writes its edges to the shared folder. The number of
    rounds grows with the logarithm of the longest path.
    """
    own = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    own, before = materialise(own, label), None
    while True:
        seen = own.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == before or not seen[0]:
            return own.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(own.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = seen
        both = own.unionByName(own.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = materialise(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), label)


def _grouped(docs: DataFrame, width: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, text_hash, fp) and, for each distinct fingerprint, (fp, root)."""
    rows = materialise(fingerprints(docs, width), "fingerprints")
    distinct = materialise(rows.select("fp").distinct(), "distinct-fingerprints")
    linked = components(links(distinct, distance))
    return rows, distinct.join(linked, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, width: int = 4, distance: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of ``docs(doc_id, text)``."""
    rows, roots = _grouped(docs, width, distance)
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least")).join(roots, "fp")
    ids = least.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = roots.join(ids, "root").select("fp", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(by_fp, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, width: int = 4, distance: int = 4) -> DataFrame:
    """``docs`` with one row of each component: that with the smallest id, then text hash; repeats of it go too."""
    return first_of_each(docs, *_grouped(docs, width, distance))


def first_of_each(docs: DataFrame, rows: DataFrame, roots: DataFrame) -> DataFrame:
    """The first row of ``docs`` in each component, given ``rows(doc_id, text_hash, fp)`` and ``roots(fp, root)``."""
    first = rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "text_hash")).alias("first")).join(roots, "fp")
    id_, hash_ = unused(docs, "__id"), unused(docs, "__hash")
    kept = first.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.doc_id").alias(id_), F.col("first.text_hash").alias(hash_))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(id_)) & (F.xxhash64("text") == F.col(hash_))
    one = docs.join(kept, same, "left_semi").withColumns({id_: F.col("doc_id").cast("long"), hash_: F.xxhash64("text")})
    return one.dropDuplicates([id_, hash_]).drop(id_, hash_)


def op7_simhash(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
