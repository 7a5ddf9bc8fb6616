"""Language identification by Bayesian evidence fusion (operator 10).

For each row the log posterior of a language is the sum of
- the text's log-likelihood under character-trigram models (tempered to the weight of ``WEIGHT`` trigrams, as
  neighbouring trigrams are not independent),
- the log-likelihoods of the declared markup language and of the address suffix, from smoothed counts of these
  values by the language that the text alone suggests,
- the log prior of its host: counts of suggested languages of the host, smoothed by those of its domain, which
  are smoothed by those of all rows.
All counts are grouped aggregates over all rows. The trigram models are counts over all labelled texts, kept apart
for two halves of the ids: a row is scored by the counts of the other half, so that its own label is not in the model
that judges it; a copy of its text under another id may be (rows without an id are scored by both halves).

Edge cases: a null or empty text gives even likelihoods, so the other evidence decides; a null host, suffix or
declaration gives no evidence; repeated rows count as often as they stand; ties go to the language that comes
first by name; an empty table gives no rows; without labelled texts the result has no language (null).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.llm.warc import plain_text
from skyloom.session import materialise

BUCKET_BITS = 15
WEIGHT = 60
#: Pseudo-counts: of evidence values, and of the level above in a host's and a domain's prior.
ALPHA, HOST_BACKOFF, DOMAIN_BACKOFF = 1.0, 20.0, 20.0
#: A row is unsure below this probability.
SURE = 0.5

EVIDENCE = "doc_id long, page_id long, text string, declared string, suffix string, host string, domain string"


def trigrams(text: str | None) -> np.ndarray:
    """Buckets of the trigrams of the lower-cased text, white space as one space."""
    x = np.frombuffer(f" {' '.join((text or '').lower().split())} ".encode("utf-32-le"), np.uint32)
    if len(x) < 3:
        return np.zeros(0, np.int64)
    h = (x[:-2] * np.uint32(0x9E3779B1) ^ x[1:-1]) * np.uint32(0x85EBCA77) ^ x[2:]
    return ((h * np.uint32(0xC2B2AE3D)) >> np.uint32(32 - BUCKET_BITS)).astype(np.int64)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _half(doc_id: Column) -> Column:
    """0 or 1 by the id; null for a null id."""
    return F.when(doc_id.isNotNull(), F.pmod(F.xxhash64(doc_id.cast("long"), F.lit("half")), F.lit(2)).cast("int"))


def fit(labelled: DataFrame, *, smoothing: float = 0.1, most: int = 1000) -> tuple[list[str], np.ndarray]:
    """Languages and the log-probabilities (3, bucket, language) of trigrams from ``labelled(doc_id, text, lang)``.

    The first table is for rows of half 0 and leaves their half out, the second for those of half 1, the third is of
    all rows. The driver gets one count for each half, bucket and language; more than ``most`` languages are an error.
    """
    texts = labelled.where("lang is not null").select(F.coalesce(_half(F.col("doc_id")), F.lit(-1)).alias("half"), F.col("lang").cast("string").alias("lang"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[int, str], np.ndarray] = {}
        for batch in _slices(batches):
            for half, lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                mine = counts.setdefault((half, lang), np.zeros(1 << BUCKET_BITS, np.int64))
                x = trigrams(text)
                for at in range(0, len(x), 1 << 20):
                    mine += np.bincount(x[at : at + (1 << 20)], minlength=1 << BUCKET_BITS)
        for (half, lang), c in counts.items():
            held = np.flatnonzero(c)
            n = len(held)
            yield pa.RecordBatch.from_arrays([pa.array([half] * n, pa.int32()), pa.array([lang] * n, pa.string()), pa.array(held), pa.array(c[held])], ["half", "lang", "bucket", "n"])

    counts = materialise(texts.mapInArrow(run, "half int, lang string, bucket long, n long").groupBy("half", "lang", "bucket").agg(F.sum("n").alias("n")), "langid-trigrams")
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().limit(most + 1).collect())
    if len(languages) > most:
        raise ValueError(f"more than {most} languages; raise `most` where workers hold so many tables")
    table = np.zeros((3, 1 << BUCKET_BITS, len(languages)))
    place = {lang: k for k, lang in enumerate(languages)}
    for r in counts.toArrow().to_batches(65536):
        half, lang, bucket, n = (r.column(c).to_numpy(zero_copy_only=False) for c in ("half", "lang", "bucket", "n"))
        lang = np.fromiter((place[x] for x in lang), np.int64, len(lang))
        for k in range(3):
            use = half != k
            np.add.at(table[k], (bucket[use], lang[use]), n[use])
    for k in range(3):
        seen = table[k].sum(0) > 0
        table[k] = np.log((table[k] + smoothing) / (table[k] + smoothing).sum(0))
        if seen.any():  # a language without text in the other half is no likelier than the least likely
            table[k][:, ~seen] = table[k][:, seen].min(1, keepdims=True)
    return languages, table.astype(np.float32)


def text_likelihoods(rows: DataFrame, model: np.ndarray, weight: int = WEIGHT) -> DataFrame:
    """``rows`` with ``ll array<double>`` in place of ``text``: tempered log-likelihoods by language."""
    kept = rows.withColumn("__half", F.coalesce(_half(F.col("doc_id")), F.lit(2)))
    at, half = kept.columns.index("text"), kept.columns.index("__half")
    keep = [k for k in range(len(kept.columns)) if k not in (at, half)]
    schema = T.StructType([*(kept.schema.fields[k] for k in keep), T.StructField("ll", T.ArrayType(T.DoubleType()))])
    none = np.zeros(model.shape[2])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            out = []
            for text, table in zip(batch.column(at).to_pylist(), batch.column(half).to_pylist(), strict=True):
                x = trigrams(text)
                total = none
                for k in range(0, len(x), 1 << 16):
                    total = total + model[table][x[k : k + (1 << 16)]].sum(0, dtype=float)
                out.append(total / max(len(x), 1) * min(len(x), weight))
            flat = pa.array(np.concatenate(out) if out else none[:0])
            offsets = pa.array((np.arange(len(out) + 1) * model.shape[2]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), pa.ListArray.from_arrays(offsets, flat)], schema.names)

    return kept.mapInArrow(run, schema)


def _counts(rows: DataFrame, by: list[str], n: int) -> DataFrame:
    """``by`` and ``c array<double>``: how many rows suggest each language."""
    own = rows.where(~F.isnull(by[-1])).groupBy(*by).agg(*(F.coalesce(F.sum((F.col("best") == k).cast("double")), F.lit(0.0)).alias(f"c{k}") for k in range(n)))
    return own.select(*by, F.array(*(f"c{k}" for k in range(n))).alias("c"))


def _smoothed(c: Column, prior: Column, weight: float) -> Column:
    total = F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(c, prior, lambda x, p: (x + weight * p) / (total + weight))


def fuse(rows: DataFrame, languages: list[str], *, alpha: float = ALPHA) -> DataFrame:
    """``rows`` (``EVIDENCE`` with ``ll``) with ``lang, probability, text_lang``.

    ``rows`` is read for each kind of count and must be a written table. Counts of a host or domain are one
    row each, so a host with many rows meets its counts in a join whose large side can be split.
    """
    n = len(languages)
    rows = rows.withColumn("best", F.when(F.array_max("ll") > F.array_min("ll"), F.array_position("ll", F.array_max("ll")).cast("int") - 1))
    total = rows.where("best is not null").groupBy().agg(*(F.coalesce(F.sum((F.col("best") == k).cast("double")), F.lit(0.0)).alias(f"c{k}") for k in range(n)))
    total = total.select(F.array(*(F.col(f"c{k}") for k in range(n))).alias("all"))
    even = F.array(*[F.lit(1.0 / n)] * n)
    prior = total.select("all", _smoothed(F.col("all"), even, alpha).alias("prior"))

    def likelihood(name: str) -> DataFrame:
        """P(value | language) of each value: counts over the language's counts of all values."""
        found = _counts(rows, [name], n)
        values = found.agg(*(F.sum(F.col("c")[k]).alias(f"s{k}") for k in range(n)), F.count("*").alias("values"))
        share = [F.log((F.col("c")[k] + alpha) / (F.col(f"s{k}") + alpha * (F.col("values") + 1))) for k in range(n)]
        return materialise(found.crossJoin(values).select(name, F.array(*share).alias(f"p_{name}")), "langid-counts")

    domains = _counts(rows, ["domain"], n).crossJoin(prior).select("domain", _smoothed(F.col("c"), F.col("prior"), DOMAIN_BACKOFF).alias("p_domain"))
    hosts = _counts(rows, ["domain", "host"], n).join(domains, "domain")
    hosts = materialise(hosts.select("domain", "host", _smoothed(F.col("c"), F.col("p_domain"), HOST_BACKOFF).alias("p_host")), "langid-hosts")
    prior = materialise(prior.select("prior"), "langid-prior")
    rows = rows.join(hosts, ["domain", "host"], "left").join(likelihood("declared"), "declared", "left").join(likelihood("suffix"), "suffix", "left")
    rows = rows.crossJoin(F.broadcast(prior))
    none = F.array(*[F.lit(0.0)] * n)
    base = F.transform(F.coalesce("p_host", "prior"), lambda p: F.log(p))
    score = F.col("ll")
    for more in (base, F.coalesce("p_declared", none), F.coalesce("p_suffix", none)):
        score = F.zip_with(score, more, lambda a, b: a + b)
    rows = rows.withColumn("score", score).withColumn("top", F.array_max("score"))
    names = F.array(*map(F.lit, languages))
    return rows.select(
        "doc_id", "page_id", "host", "declared", "suffix",
        F.element_at(names, F.array_position("score", F.col("top")).cast("int")).alias("lang"),
        (1 / F.aggregate("score", F.lit(0.0), lambda a, s: a + F.exp(s - F.col("top")))).alias("probability"),
        F.when(F.col("best").isNotNull(), F.element_at(names, F.col("best") + 1)).alias("text_lang"),
    )


def evidence_of_pages(pages: DataFrame) -> DataFrame:
    """``EVIDENCE`` of ``pages(page_id, url, html)``: a domain is the last two labels of a host."""
    host = F.nullif(F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z]+://([^/:?#]+)", 1)), F.lit(""))
    declared = F.nullif(F.lower(F.regexp_extract(F.coalesce("html", F.lit("")), r"(?i)<html[^>]*\slang=[\"']?([a-z]+)", 1)), F.lit(""))
    return pages.select(
        F.lit(None).cast("long").alias("doc_id"), F.col("page_id").cast("long").alias("page_id"), plain_text(F.col("html")).alias("text"),
        declared.alias("declared"), F.substring_index(host, ".", -1).alias("suffix"), host.alias("host"), F.substring_index(host, ".", -2).alias("domain"),
    )


def evidence_of_documents(docs: DataFrame) -> DataFrame:
    """``EVIDENCE`` of ``docs(doc_id, text, source)``: the source is the host, and there is no markup or address."""
    nothing = F.lit(None).cast("string")
    source = F.col("source").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("page_id"), "text",
        nothing.alias("declared"), nothing.alias("suffix"), source.alias("host"), source.alias("domain"),
    )


def identify(evidence: DataFrame, labelled: DataFrame, **options) -> DataFrame:
    """(doc_id, page_id, host, declared, suffix, lang, probability, text_lang, sure) of every row of ``evidence``."""
    languages, model = fit(labelled, **options)
    if not languages:
        return evidence.select("doc_id", "page_id", "host", "declared", "suffix", F.lit(None).cast("string").alias("lang"), F.lit(0.0).alias("probability"), F.lit(None).cast("string").alias("text_lang"), F.lit(False).alias("sure"))
    rows = materialise(text_likelihoods(evidence, model), "langid-evidence")
    return fuse(rows, languages).withColumn("sure", F.col("probability") >= SURE)


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    """Languages of all documents and pages; the trigram models learn from the languages of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return identify(evidence_of_documents(docs).unionByName(evidence_of_pages(pages)), docs)
