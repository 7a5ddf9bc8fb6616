"""Importance resampling towards a target distribution by hashed n-grams (operator 13).

Words and n-grams are made by Arrow kernels over slices of texts: ``ascii_lower``, ``split_pattern_regex`` by what is
no word, ``list_flatten`` and ``dictionary_encode``. An n-gram is a pair of an (n-1)-gram's number and the shifted
number of the word behind it; only distinct pairs are hashed (CRC-32, carried on from the shorter n-gram's), and
``take`` and sums of segments give each text the gains of its buckets. Counts of a bucket in all documents and in all
target texts are summed in each task before they are shuffled; the gains are a table of ``buckets`` integers, whose
size does not depend on the input, and go with the tasks. The draw numbers all rows by ranges of score.

Edge cases: a null or empty text has no features and weight 0; a null id has no score and is never drawn; repeated
rows are counted, scored and drawn each; ties go to the smaller id; an empty table gives no rows, an empty target
leaves only the smoothing; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import floor, log
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.operators.windows import numbered_by
from skyloom.session import materialise

#: What parts words: all of ASCII but digits and letters.
APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of text that the kernels see at once, beyond the last text.
SLICE = 4_000_000


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """``texts`` in slices of about ``SLICE`` bytes, in order."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + SLICE)))
        yield texts.slice(at, stop - at)
        at = stop


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(numbers of the words in order, the distinct words, words of each text)."""
    # a copy of its own: over some slices of larger arrays ``ascii_lower`` returns shifted bytes
    lower = pc.ascii_lower(pa.concat_arrays([pc.fill_null(texts, ""), pa.array([], texts.type)]))
    parts = pc.split_pattern_regex(lower, pattern=APART)
    flat, owner = pc.list_flatten(parts), pc.list_parent_indices(parts)
    real = pc.not_equal(pc.binary_length(flat), 0)  # before the first word and behind the last
    flat, owner = flat.filter(real), owner.filter(real)
    coded = flat.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary, np.bincount(owner.to_numpy(), minlength=len(texts))


def _features(texts: pa.Array, n: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each width up to ``n``: (number of each feature, bucket of each number, features of each text)."""
    index, words, sizes = _words(texts)
    spelled = [w.encode() for w in words.to_pylist()]
    code, crcs, behind = index, np.array([crc32(w) for w in spelled], np.int64), sizes
    # how many words of its text follow each word, itself included
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(index))
    for width in range(1, n + 1):
        if width > 1:
            fits = left[: len(code)] >= width
            pairs = code[fits] * max(len(spelled), 1) + index[np.flatnonzero(fits) + width - 1]
            distinct, again = np.unique(pairs, return_inverse=True)
            shorter, last = np.divmod(distinct, max(len(spelled), 1))
            crcs = np.array([crc32(b" " + spelled[w], int(crcs[p])) for p, w in zip(shorter.tolist(), last.tolist(), strict=True)], np.int64)
            code = np.zeros(len(index), np.int64)
            code[fits] = again
            behind = np.maximum(sizes - width + 1, 0)
            yield again, crcs % buckets, behind
        else:
            yield code, crcs % buckets, behind


def bucket_counts(texts: DataFrame, n: int, buckets: int) -> DataFrame:
    """(bucket, n): how many features of ``texts(text)`` fall in each bucket; buckets without any are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in _slices(batch.column(0)):
                for code, bucket, _ in _features(part, n, buckets):
                    times = np.bincount(code, minlength=len(bucket)) if len(code) else np.zeros(len(bucket), np.int64)
                    np.add.at(total, bucket, times)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["bucket", "n"])

    return texts.select(F.col("text").cast("string")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, n: int, buckets: int) -> np.ndarray:
    """1000 times the log ratio of each bucket's smoothed share in ``target`` to that in ``docs``, floored."""
    own, wanted = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    for counts, texts in ((own, docs), (wanted, target)):
        for r in bucket_counts(texts, n, buckets).collect():  # at most a row for each bucket
            counts[r.bucket] = r.n
    s, t = int(own.sum()), int(wanted.sum())
    return np.array([floor(1000 * log((b + 1) * (s + buckets) / ((a + 1) * (t + buckets)))) for a, b in zip(own.tolist(), wanted.tolist(), strict=True)], np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, n: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of ``docs(doc_id, text)``: the sum of gains over a text's features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in _slices(batch.column(1)):
                features, weight, words = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64), None
                for code, bucket, sizes in _features(part, n, len(gains)):
                    words = sizes if words is None else words
                    gained = pa.array(gains[bucket]).take(pa.array(code)).to_numpy()
                    upto = np.append(0, np.cumsum(gained))
                    ends = np.cumsum(sizes)
                    features += sizes
                    weight += upto[ends] - upto[ends - sizes]
                columns = [batch.column(0).slice(at, len(part)), *map(pa.array, (words.astype(np.int64), features, weight))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight"])
                at += len(part)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, *, n: int = 1, buckets: int = 10_000, percent: int = 10, least_words: int = 20, seed: int = 2024) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): documents drawn without replacement in proportion to exp(weight / 1000).

    A score is the weight and 1000 times a Gumbel number that follows from seed and id, so the highest scores are such a
    draw; of the documents with ``least_words`` words, ``percent`` of 100 are drawn and ranked from 1.
    """
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("long")
    gumbel = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = weigh(docs, bucket_gains(docs, target, n, buckets), n).withColumn("score", F.col("weight") + gumbel)
    may = (F.col("n_words") >= least_words) & F.col("doc_id").isNotNull()
    scored = materialise(scored.withColumn("__may", may), "importance-scores")
    drawn = scored.where("__may").count() * percent // 100
    placed = numbered_by(scored, [F.desc("__may"), F.desc("score"), F.col("doc_id")])
    rank = F.when(F.col("__may") & (F.col("number") <= drawn), F.col("number")).alias("rank")
    return placed.select("doc_id", "n_features", "weight", "score", rank)


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents weighed towards the benchmark's texts, and the tenth of them that is drawn."""
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE_SQL = rf"""
with table_of as (  -- of CRC-32, by its rule
  select list(list_reduce([n, 1, 2, 3, 4, 5, 6, 7, 8], lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by n) as t
  from (select range::bigint as n from range(256))),
own as (select row_number() over () as r, doc_id, unnest([text]) as text from documents),
found as (
  select r, unnest(regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as w from own
  union all
  select null, unnest(regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) from benchmark),
hashed as (
  select w, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(octet_length(encode(w))),
      lambda i: ('0x' || substr(hex(encode(w)), (2 * i + 1)::bigint, 2))::bigint)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 as bucket
  from (select distinct w from found), table_of),
counts as (select bucket, count(r) as s, count(*) - count(r) as t from found join hashed using (w) group by bucket),
totals as (select sum(s) as bigs, sum(t) as bigt from counts),
gains as (select bucket, floor(1000 * ln((t + 1) * (bigs + 10000)::double / ((s + 1) * (bigt + 10000)::double)))::bigint as gain from counts, totals),
weights as (select r, count(*) as n_features, sum(gain)::bigint as weight from found join hashed using (w) join gains using (bucket) where r is not null group by r),
scored as (
  select r, doc_id, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint as score
  from own left join weights using (r)),
ranked as (select *, row_number() over (partition by n_features >= 20 order by score desc, doc_id) as place, count(*) filter (n_features >= 20) over () as n from scored)
select doc_id, n_features, weight, score, case when n_features >= 20 and place <= n * 10 // 100 then place end as rank from ranked
"""
