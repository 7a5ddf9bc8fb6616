"""Toxicity classifier (operator 5): character n-grams scaled by naive Bayes log-count ratios.

Training reads at most ``max_rows`` labelled rows, those with the smallest hashes of id and text; every n-gram of
theirs counts. N-grams are hashed to ``2**BITS`` buckets. Spark sums how many texts of each class hold a bucket; the
log-count ratios, each drawn smoothly to zero where it is unclear (``CLEAR``), scale the presence features of a
logistic regression, whose gradients are sums over the written
features: each step is a job over ``PARTS`` partitions that returns one array of ``2**BITS`` numbers from each, so
the driver holds a few arrays of fixed size and never a row. Scoring is one map over the texts; a label, language,
source or id is never an input of a score.

Edge cases: a null or empty text holds only its boundary and gets the score of the features it lacks (the
intercept); labels that are null or neither 0 nor 1 are not used, an id with both labels is toxic; with one class
alone or no labels the score is that class's share, 0 without labels; a row that repeats (id and text) is learned
from once and scored each time; an empty table gives no rows; other columns are ignored by ``score_documents`` and
kept by ``attach_scores``, which replaces a column of the score's name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.session import materialise, unused

BITS = 18
SIZES = (3, 4, 5)
#: A ratio of so many standard errors counts half; the factor is z**4 / (z**4 + CLEAR**4), so none is dropped.
CLEAR = 3.0
#: Partitions of the written training features.
PARTS = 8
_MULTIPLIER = np.uint32(0x9E3779B1)


@dataclass
class Model:
    """Weights of the buckets met in training (ratio times coefficient), sorted by bucket."""

    buckets: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    intercept: float = 0.0


def ngram_buckets(text: str | None) -> np.ndarray:
    """Buckets of all character n-grams of the lower-cased text, white space as one space, boundaries as spaces."""
    points = np.frombuffer(f" {' '.join((text or '').lower().split())} ".encode("utf-32-le"), np.uint32)
    out = []
    h = points.copy()
    for n in range(2, max(SIZES) + 1):
        if len(points) < n:
            break
        h = h[:-1] * np.uint32(0x01000193) ^ points[n - 1 :] * _MULTIPLIER
        if n in SIZES:
            out.append(((h ^ (h >> np.uint32(15))) * _MULTIPLIER) >> np.uint32(32 - BITS))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def _texts(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def labelled(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, folds: int = 5) -> DataFrame:
    """Training rows (doc_id, text_hash, text, label): crc32 of the id as text is not divisible by ``folds``.

    At most ``max_rows`` rows. First at most so many ids, so few that the join broadcasts them and no other text is
    shuffled; then, as an id may have many rows, repeats go and the rows with the smallest hashes stay.
    """
    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
    y = y.where(F.col("label").isin(0, 1) & (F.crc32(F.col("doc_id").cast("string")) % folds != 0))
    y = y.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(y), "doc_id")
    rows = materialise(rows.withColumn("text_hash", F.xxhash64("text")).dropDuplicates(["doc_id", "text_hash"]), "toxicity-rows")
    first = rows.select("doc_id", "text_hash").orderBy(F.xxhash64("doc_id", "text_hash"), "doc_id", "text_hash").limit(max_rows)
    return rows.join(F.broadcast(first), ["doc_id", "text_hash"], "left_semi").select("doc_id", "text_hash", "text", "label")


def _features(rows: DataFrame) -> DataFrame:
    """(at binary, label): the distinct buckets of each row, sorted, as 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _texts(batches):
            held = [np.unique(ngram_buckets(t)).astype("<i4").tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary()), batch.column(1)], ["at", "label"])

    return rows.repartition(PARTS, "doc_id", "text_hash").select("text", "label").mapInArrow(run, "at binary, label int")


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(buckets, row of each, labels) of a few rows at a time."""
    for batch in _texts(batches, 64):
        held = [np.frombuffer(x, "<i4") for x in batch.column(0).to_pylist()]
        lengths = np.fromiter(map(len, held), np.int64, len(held))
        yield (np.concatenate(held) if held else np.zeros(0, np.int32)), np.repeat(np.arange(len(held)), lengths), batch.column(1).to_numpy()


def _class_counts(features: DataFrame) -> np.ndarray:
    """Texts of each class (0, 1) that hold a bucket; the last column counts all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, (1 << BITS) + 1), np.int32)
        for held, row, y in _lists(batches):
            for label in (0, 1):
                counts[label, :-1] += np.bincount(held[y[row] == label], minlength=1 << BITS)
                counts[label, -1] += np.count_nonzero(y == label)
        yield pa.RecordBatch.from_arrays([pa.array([counts.tobytes()], pa.binary())], ["sums"])

    out = np.zeros((2, (1 << BITS) + 1), np.int64)
    for r in features.mapInArrow(run, "sums binary").collect():
        out += np.frombuffer(r["sums"], np.int32).reshape(out.shape)
    return out


def _gradient(features: DataFrame, weights: np.ndarray, intercept: float, cost: tuple[float, float]) -> tuple[float, np.ndarray]:
    """Loss and its gradient by bucket weights and intercept, summed over the written features.

    The weights travel in 16 bits with the job itself (half a megabyte), so that no step leaves a broadcast file.
    """
    short = weights.astype(np.float16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, slopes, weights = 0.0, np.zeros((1 << BITS) + 1), short.astype(float)
        for held, row, y in _lists(batches):
            margin = np.bincount(row, weights[held], len(y)) + intercept
            of = np.where(y == 1, cost[1], cost[0])
            total += float((of * np.logaddexp(0, np.where(y == 1, -margin, margin))).sum())
            slope = of * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y)
            slopes[:-1] += np.bincount(held, slope[row], 1 << BITS)
            slopes[-1] += slope.sum()
        yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([slopes.astype(np.float32).tobytes()], pa.binary())], ["loss", "sums"])

    loss, out = 0.0, np.zeros((1 << BITS) + 1)
    for r in features.mapInArrow(run, "loss double, sums binary").collect():
        loss += r["loss"]
        out += np.frombuffer(r["sums"], np.float32)
    return loss, out


def _direction(grad: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Limited-memory quasi-Newton direction from the last moves and changes of the gradient."""
    q, held = grad.copy(), []
    for s, y in reversed(pairs):
        a = (s @ q) / (s @ y)
        q -= a * y
        held.append(a)
    if pairs:
        s, y = pairs[-1]
        q *= (s @ y) / (y @ y)
    for (s, y), a in zip(pairs, reversed(held), strict=True):
        q += s * (a - (y @ q) / (s @ y))
    return -q


def fit(docs: DataFrame, labels: DataFrame, *, max_rows: int = 20_000, smoothing: float = 0.5, l2: float = 1e-3, steps: int = 20, memory: int = 5) -> Model:
    """Fit on at most ``max_rows`` labelled rows outside fold 0, by ``steps`` quasi-Newton steps."""
    features = materialise(_features(labelled(docs, labels, max_rows)), "toxicity-features").coalesce(PARTS)
    counts = _class_counts(features)
    (n_neg, n_pos), (neg, pos) = counts[:, -1], counts[:, :-1]
    if not n_pos or not n_neg:
        return Model(intercept=20.0 if n_pos else -20.0)
    ratio = np.log((pos + smoothing) / (n_pos + 2 * smoothing)) - np.log((neg + smoothing) / (n_neg + 2 * smoothing))
    z4 = (ratio**2 / (1 / (pos + smoothing) + 1 / (neg + smoothing))) ** 2
    ratio = np.where(pos + neg, ratio * z4 / (z4 + CLEAR**4), 0.0).astype(np.float32)
    # half of the cost by row and half by class, so that a rare class is not drowned
    each = [0.5 / (n_pos + n_neg) + 0.25 / n for n in (n_neg, n_pos)]

    def at(w: np.ndarray) -> tuple[float, np.ndarray]:
        loss, slopes = _gradient(features, ratio * w[:-1], float(w[-1]), (each[0], each[1]))
        grad = np.append(slopes[:-1] * ratio + l2 * w[:-1], slopes[-1])
        return loss + l2 / 2 * float(w[:-1] @ w[:-1]), grad

    w = np.zeros((1 << BITS) + 1)
    loss, grad = at(w)
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        way = _direction(grad, pairs)
        size = 1.0 if pairs else 1.0 / max(float(np.abs(grad).max()), 1.0)
        while True:  # halve a move that does not lower the loss
            ahead = w + size * way
            new_loss, new_grad = at(ahead)
            if new_loss <= loss + 1e-4 * size * float(grad @ way) or size < 1e-3:
                break
            size /= 2
        s, y = ahead - w, new_grad - grad
        if float(s @ y) > 1e-12:
            pairs = [*pairs[1 - memory :], (s, y)]
        done = abs(loss - new_loss) <= 1e-4 * abs(loss)
        w, loss, grad = ahead, new_loss, new_grad
        if done:
            break
    held = np.flatnonzero(ratio).astype(np.int32)
    return Model(held, (ratio * w[:-1])[held].astype(np.float32), float(w[-1]))


def attach_scores(docs: DataFrame, model: Model, *, score: str = "score", text: str = "text") -> DataFrame:
    """``docs`` with all its columns and ``score``, the probability of label 1 (a column of that name is replaced)."""
    kept = docs.drop(score)
    at = kept.columns.index(text)
    schema = T.StructType([*kept.schema.fields, T.StructField(score, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(1 << BITS, np.float32)
        weights[model.buckets] = model.weights
        last = np.zeros(1 << BITS, np.int64)
        for batch in _texts(batches):
            out = []
            for t in batch.column(at).to_pylist():
                x = ngram_buckets(t)
                at_x = np.arange(len(x))
                last[x] = at_x
                out.append(float(weights[x[last[x] == at_x]].sum(dtype=float)) + model.intercept)  # each bucket once
            p = 1 / (1 + np.exp(-np.clip(np.array(out), -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], [*batch.schema.names, score])

    return kept.mapInArrow(run, schema)


def score_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Fit on ``labels`` and score every text: (doc_id, held_out, score, predicted)."""
    model = fit(docs, labels, **options)
    scored = attach_scores(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return scored.select(
        "doc_id",
        (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def stage_toxicity(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic: their score, by the classifier fitted on the table ``labels``, is under 0.5.

    A null or empty text has the classifier's intercept for a score; repeated rows are judged alike; an empty table
    gives no rows; all columns stay.
    """
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = unused(docs, "__toxicity")
    return attach_scores(docs, model, score=score).where(F.col(score) < 0.5).drop(score)
