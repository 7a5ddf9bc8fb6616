"""Centroid clustering with Ptolemaic pivot bounds (operator 12).

For any four points Ptolemy's inequality gives d(x, c) >= |d(x, p) d(c, q) - d(x, q) d(c, p)| / d(p, q). The distances of
each vector to a few fixed pivots are computed once and kept with it in a written table, so that a round needs only
those of the centroids to get a lower bound for each vector and centroid. The centroid with the least bound is measured
exactly; the others only where their bound does not rule them out. Bounds are rounded down by more than their
floating-point error and the measured distance is rounded up, so a centroid is left out only if it is farther for
certain; ties go to the smaller number. All else is in integers.

A round is one job: tasks sum their vectors by cluster, Spark adds the sums, and the driver receives a row for each
centroid and component. Centroids and pivots, of fixed number, go with the tasks.

Edge cases: vectors of another length, or with a null or non-finite component, are not kept; fewer vectors than
centroids give fewer centroids, none give no rows; a null id is clustered but never a start; repeated rows count each,
and ties between equal ids are broken by the components; components beyond 2^27 in units of 1/1024, whose squared
distances leave 64 bits, are an error; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.session import materialise

#: Pivots, and how many pairs of them are used, the widest apart first.
PIVOTS, PAIRS = 12, 8
LARGEST = 1 << 27
#: Relative room for rounding in a bound: each of its few operations errs by 2^-53 at most.
ROOM = 2.0**-48
CHUNK = 16_384


def integer_vectors(rows: DataFrame, dims: int, scale: int, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(vec_id, v array<long>): floor(scale * x) of the vectors with ``dims`` finite components."""
    x = F.col(column).cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    kept = rows.select(F.col(key).cast("long").alias("vec_id"), x.alias("x")).where((F.size("x") == dims) & F.coalesce(finite, F.lit(False)))
    limit = F.lit(float(LARGEST))
    whole = lambda v: F.when(F.abs(v * scale) < limit, F.floor(v * scale)).otherwise(F.raise_error(F.lit("component out of range")).cast("long"))
    return kept.select("vec_id", F.transform("x", whole).alias("v"))


def _first(vectors: DataFrame, n: int, seed: str) -> np.ndarray:
    """``n`` vectors by the hash of seed and id."""
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    found = vectors.where("vec_id is not null").orderBy(rank, "v").limit(n).collect()
    return np.array([r.v for r in found], np.int64)


def _squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` to each row of ``y``."""
    out = np.empty((len(x), len(y)), np.int64)
    for j, c in enumerate(y):
        d = x - c
        out[:, j] = np.einsum("ij,ij->i", d, d)
    return out


def pivot_pairs(pivots: np.ndarray, pairs: int = PAIRS) -> list[tuple[int, int, float]]:
    """(p, q, d(p, q) rounded up): the pairs widest apart; equal pivots make none."""
    square = _squared(pivots, pivots)
    found = sorted(((int(square[p, q]), p, q) for p in range(len(pivots)) for q in range(p) if square[p, q]), reverse=True)
    return [(p, q, np.sqrt(float(s)) * (1 + ROOM)) for s, p, q in found[:pairs]]


def lower_bounds(xp: np.ndarray, cp: np.ndarray, pairs: list[tuple[int, int, float]]) -> np.ndarray:
    """Bounds (vectors by centroids) below the true distances, from both sides' distances to the pivots."""
    bound = np.zeros((len(xp), len(cp)))
    for p, q, apart in pairs:
        a, b = np.outer(xp[:, p], cp[:, q]), np.outer(xp[:, q], cp[:, p])
        np.maximum(bound, (np.abs(a - b) - ROOM * (a + b)) / apart, out=bound)
    return bound


def nearest(x: np.ndarray, xp: np.ndarray, centroids: np.ndarray, cp: np.ndarray, pairs: list) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance) of each vector, exact, and how many distances were measured."""
    n, far = np.arange(len(x)), np.iinfo(np.int64).max
    bound = lower_bounds(xp, cp, pairs)
    guess = bound.argmin(1)
    measured = np.full(bound.shape, far)
    d = x - centroids[guess]
    measured[n, guess] = np.einsum("ij,ij->i", d, d)
    most = np.nextafter(measured[n, guess].astype(float), np.inf)
    survive = bound * bound * (1 - ROOM) <= most[:, None]
    survive[n, guess] = False
    i, j = np.nonzero(survive)
    d = x[i] - centroids[j]
    measured[i, j] = np.einsum("ij,ij->i", d, d)
    cluster = measured.argmin(1)
    return cluster, measured[n, cluster], len(x) + len(i)


def _chunks(batches: Iterator[pa.RecordBatch], dims: int, pivots: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray | None]]:
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK):
            part = batch.slice(at, CHUNK)
            x = part.column(1).flatten().to_numpy().reshape(-1, dims)
            xp = part.column(2).flatten().to_numpy().reshape(-1, pivots) if part.num_columns > 2 else None
            yield part.column(0), x, xp


def cluster(vectors: DataFrame, k: int, rounds: int, seed: int, dims: int, pivots: int = PIVOTS, pairs: int = PAIRS) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance), final centroids) of ``vectors(vec_id, v)`` after Lloyd's rounds from ``k`` starts by hash."""
    vectors = materialise(vectors, "centroid-vectors")
    centroids, fixed = _first(vectors, k, f"{seed}"), _first(vectors, pivots, f"pivot:{seed}")
    if not len(centroids):
        return vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).where("false"), centroids
    width, chosen = len(fixed), pivot_pairs(fixed, pairs)

    def cached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x, _ in _chunks(batches, dims, width):
            away = np.sqrt(_squared(x, fixed).astype(float))
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(a.ravel()), a.shape[1]) for a in (x, away)]
            yield pa.RecordBatch.from_arrays([ids, lists[0].cast(pa.list_(pa.int64())), lists[1].cast(pa.list_(pa.float64()))], ["vec_id", "v", "away"])

    table = materialise(vectors.mapInArrow(cached, "vec_id long, v array<long>, away array<double>"), "centroid-pivots")

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total, cp = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64), np.sqrt(_squared(centroids, fixed).astype(float))
        for _, x, xp in _chunks(batches, dims, width):
            c, _, _ = nearest(x, xp, centroids, cp, chosen)
            count += np.bincount(c, minlength=len(centroids))
            np.add.at(total, c, x)
        j, i = np.divmod(np.arange(total.size), dims)
        yield pa.RecordBatch.from_arrays([*map(pa.array, (j, i, total.ravel(), count[j]))], ["cluster", "i", "total", "n"])

    for _ in range(rounds):
        sums = table.mapInArrow(summed, "cluster long, i long, total long, n long").groupBy("cluster", "i").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        centroids = centroids.copy()
        for r in sums.where("n > 0").collect():  # a row for each centroid and component
            centroids[r.cluster, r.i] = r.total // r.n

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cp = np.sqrt(_squared(centroids, fixed).astype(float))
        for ids, x, xp in _chunks(batches, dims, width):
            c, d, _ = nearest(x, xp, centroids, cp, chosen)
            yield pa.RecordBatch.from_arrays([ids, pa.array(c.astype(np.int32)), pa.array(d)], ["vec_id", "cluster", "distance"])

    return table.mapInArrow(assigned, "vec_id long, cluster int, distance long"), centroids


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings in eight clusters, with their squared distances and the clusters' sums and digests."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    found, centroids = cluster(integer_vectors(rows, 64, 1024), 8, 10, 3, 64)
    found = materialise(found, "centroid-result")
    digests = [(j, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(centroids.tolist())]
    by_cluster = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))  # at most eight rows
    whole = found.agg(F.sum("distance").alias("inertia"))
    sums = by_cluster.join(F.broadcast(whole), F.lit(True)).join(F.broadcast(spark.createDataFrame(digests, "cluster int, centroid_sha256 string")), "cluster")
    return found.join(F.broadcast(sums), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle(k: int = 8, rounds: int = 10, seed: int = 3, dims: int = 64, scale: int = 1024) -> str:
    steps = [
        f"""with vectors as materialized (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: floor({scale} * x::double)::bigint) as v from embeddings
  where len(embedding) = {dims} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {dims}),
parts as materialized (select r, i, v[i] as x from vectors, (select unnest(range(1, {dims} + 1)) as i)),
starts as (select v, row_number() over (order by sha256('{seed}:' || vec_id), v) - 1 as cluster from vectors where vec_id is not null),
c0 as materialized (select cluster, i, v[i] as x from starts, (select unnest(range(1, {dims} + 1)) as i) where cluster < {k})"""
    ]
    for n in range(rounds + 1):
        steps.append(
            f"""d{n} as materialized (select r, min((d, cluster)) as best from (
  select r, cluster, sum((p.x - c.x) * (p.x - c.x))::bigint as d from parts p join c{n} c using (i) group by r, cluster) group by r)"""
        )
        if n < rounds:
            steps.append(
                f"""c{n + 1} as materialized (select c.cluster, c.i, coalesce((s.x - ((s.x % s.n) + s.n) % s.n) // s.n, c.x)::bigint as x from c{n} c left join (
  select best[2] as cluster, i, sum(x)::bigint as x, count(*) as n from parts join d{n} using (r) group by all) s using (cluster, i))"""
            )
    return (
        ",\n".join(steps)
        + f""",
last as (select vec_id, best[2]::int as cluster, best[1] as distance from vectors join d{rounds} using (r)),
digest as (select cluster, sha256(string_agg(x::varchar, ',' order by i)) as centroid_sha256 from c{rounds} group by cluster)
select vec_id, l.cluster, distance, (sum(distance) over (partition by l.cluster))::bigint as cluster_inertia, (sum(distance) over ())::bigint as inertia, centroid_sha256
from last l join digest d on l.cluster = d.cluster"""
    )


ORACLE_SQL = _oracle()
