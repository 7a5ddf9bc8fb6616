"""Whether two views show one rigid scene (inventory R18): matches (pair, x, y, u, v) under a fundamental matrix and a homography.

Candidates come from small classes of matches, dealt by a hash; each is the smallest eigenvector of a 9 x 9 normal matrix
that Spark sums, and its factorisation is NumPy. Every match judges every candidate of its pair, in blocks of matches that
meet the pair's candidates once; the best is fitted again to the matches near it, by the same sums. A scene is rigid as far as the better of the two models goes: flat ground
or a camera that turns makes fundamental matrices ambiguous, relief makes homographies fail.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.session import materialise


def _products(rows: list[list[Column]]) -> list[Column]:
    return [F.sum(sum((r[i] * r[j] for r in rows), F.lit(0.0))).alias(f"n_{i}_{j}") for i in range(9) for j in range(i + 1)]


SCALED = ["sx", "sy", "su", "sv"]


def _scaled(size: tuple[int, int]) -> list[Column]:
    """Coordinates about the middle in units of the longer side, so that normal matrices are well conditioned."""
    w, h = size
    return [(F.col(c) - s / 2) / max(w, h) for c, s in zip("xyuv", (w, h, w, h), strict=True)]


def epipolar_rows(x: Column, y: Column, u: Column, v: Column) -> list[list[Column]]:
    return [[u * x, u * y, u, v * x, v * y, v, x, y, F.lit(1.0)]]


def homography_rows(x: Column, y: Column, u: Column, v: Column) -> list[list[Column]]:
    z, one = F.lit(0.0), F.lit(1.0)
    return [[x, y, one, z, z, z, -u * x, -u * y, -u], [z, z, z, x, y, one, -v * x, -v * y, -v]]


def sampson(m: Column, x: Column, y: Column, u: Column, v: Column) -> Column:
    """First-order distance of a match from a fundamental matrix."""
    a, b, c = (m[3 * i] * x + m[3 * i + 1] * y + m[3 * i + 2] for i in range(3))
    d, e = m[0] * u + m[3] * v + m[6], m[1] * u + m[4] * v + m[7]
    return F.abs(u * a + v * b + c) / F.sqrt(F.nullif(a * a + b * b + d * d + e * e, F.lit(0.0)))


def transfer(m: Column, x: Column, y: Column, u: Column, v: Column) -> Column:
    """Distance of a match from where a homography takes it."""
    a, b, c = (m[3 * i] * x + m[3 * i + 1] * y + m[3 * i + 2] for i in range(3))
    c = F.nullif(c, F.lit(0.0))
    return F.hypot(a / c - u, b / c - v)


def _sampson(m: np.ndarray, x: np.ndarray, y: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """``sampson`` of every match from every model, a row of ``m`` each."""
    m = m[:, :, None]
    a, b, c = (m[:, 3 * i] * x + m[:, 3 * i + 1] * y + m[:, 3 * i + 2] for i in range(3))
    d, e = m[:, 0] * u + m[:, 3] * v + m[:, 6], m[:, 1] * u + m[:, 4] * v + m[:, 7]
    return np.abs(u * a + v * b + c) / np.sqrt(a * a + b * b + d * d + e * e)


def _transfer(m: np.ndarray, x: np.ndarray, y: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """``transfer`` of every match under every model, a row of ``m`` each."""
    m = m[:, :, None]
    a, b, c = (m[:, 3 * i] * x + m[:, 3 * i + 1] * y + m[:, 3 * i + 2] for i in range(3))
    return np.hypot(a / c - u, b / c - v)


#: Matches of a pair that are judged together.
BLOCK = 4096


def _blocks(matches: DataFrame, key: str) -> DataFrame:
    """(key, __rows): the scaled coordinates of each pair's matches, in lists of about ``BLOCK`` at most."""
    n = matches.groupBy(key).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("__b"))
    dealt = matches.join(n, key).withColumn("__b", F.pmod(F.xxhash64(*SCALED), F.col("__b")))
    return dealt.groupBy(key, "__b").agg(F.collect_list(F.array(*SCALED)).alias("__rows")).drop("__b")


def _agreeing(blocks: DataFrame, models: DataFrame, key: str, limit: float, off: Callable) -> DataFrame:
    """(key, __k, n): how many matches of ``blocks`` are nearer than ``limit`` to each of ``models(key, __models)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, ks, ns = [], [], []
            for at, (rows, models) in enumerate(zip(batch.column(1), batch.column(2), strict=True)):
                x, y, u, v = rows.values.flatten().to_numpy(zero_copy_only=False).reshape(-1, 4).T
                m = models.values.field("m").flatten().to_numpy(zero_copy_only=False).reshape(-1, 9)
                with np.errstate(all="ignore"):
                    ns += (off(m, x, y, u, v) < limit).sum(1).tolist()
                ks += models.values.field("__k").to_pylist()
                of += [at] * len(m)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of, pa.int64())), pa.array(ks, pa.int64()), pa.array(ns, pa.int64())], [key, "__k", "n"])

    kind = dict(blocks.dtypes)[key]
    counts = blocks.join(models, key).select(key, "__rows", "__models").mapInArrow(run, f"`{key}` {kind}, __k long, n long")
    return counts.groupBy(key, "__k").agg(F.sum("n").alias("n")).where("n > 0")


def _solved(sums: DataFrame, keys: list[str], flat: bool) -> DataFrame:
    """(keys, m array<double>): the smallest eigenvector of each normal matrix; ``flat`` makes its 3 x 3 singular."""
    kinds = dict(sums.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n = np.zeros((len(pdf), 9, 9))
            for i in range(9):
                for j in range(i + 1):
                    n[:, i, j] = n[:, j, i] = pdf[f"n_{i}_{j}"]
            m = np.linalg.eigh(n)[1][:, :, 0] if len(pdf) else np.zeros((0, 9))
            if flat and len(pdf):
                a, s, b = np.linalg.svd(m.reshape(-1, 3, 3))
                s[:, 2] = 0
                m = (a * s[:, None, :] @ b).reshape(-1, 9)
            yield pdf[keys].assign(m=list(m))

    return sums.mapInPandas(run, "".join(f"`{k}` {kinds[k]}, " for k in keys) + "m array<double>")


def consensus(matches: DataFrame, blocks: DataFrame, key: str, size: tuple[int, int], near: float, rows: Callable, off: Callable, judge: Callable, flat: bool, *, candidates: int = 96, sample: int = 8, rounds: int = 2) -> DataFrame:
    """(key, agree, m) of ``matches`` with scaled coordinates: how many matches the best model has within ``near`` cells, and the model in scaled coordinates.

    ``blocks`` are those of ``_blocks``; ``judge`` is ``off`` on arrays.
    """
    c, limit = [F.col(k) for k in SCALED], near / max(size)
    n = matches.groupBy(key).agg(F.count("*").alias("__n")).withColumn("__m", F.greatest(F.lit(1), F.floor(F.col("__n") / sample)).cast("long"))
    times = F.sequence(F.lit(0).cast("long"), F.ceil(F.lit(candidates) / F.col("__m")) - 1)
    dealt = matches.join(n, key).select(key, *"xyuv", *SCALED, "__m", F.explode(times).alias("__t"))
    h = F.md5(F.concat_ws(":", key, *(F.round(k, 4) for k in "xyuv"), "__t"))
    dealt = dealt.withColumn("__k", F.col("__t") * F.col("__m") + F.conv(F.substring(h, 1, 8), 16, 10).cast("long") % F.col("__m"))
    # a class stays small however many matches there are, else each would hold a wrong one; about half have ``sample`` of them
    sums = dealt.where(F.col("__k") < 2 * candidates).groupBy(key, "__k").agg(F.count("*").alias("__n"), *_products(rows(*c))).where(F.col("__n") >= sample)
    solved = materialise(_solved(sums, [key, "__k"], flat), "rigid-models")
    models = solved.groupBy(key).agg(F.collect_list(F.struct("__k", "m")).alias("__models"))  # at most twice ``candidates``
    tried = _agreeing(blocks, models, key, limit, judge).join(solved, [key, "__k"])
    best = tried.groupBy(key).agg(F.max(F.struct("n", -F.col("__k"), "m")).alias("b"))
    best = materialise(best.select(key, F.col("b.n").alias("agree"), F.col("b.m").alias("m")), "rigid-best")
    for _ in range(rounds):
        inside = matches.join(best, key).where(off(F.col("m"), *c) < limit)
        again = _solved(inside.groupBy(key).agg(*_products(rows(*c))), [key], flat)
        counted = matches.join(again, key).where(off(F.col("m"), *c) < limit).groupBy(key, "m").agg(F.count("*").alias("agree"))
        both = best.unionByName(counted.select(key, "agree", "m"))
        best = materialise(both.groupBy(key).agg(F.max(F.struct("agree", "m")).alias("b")).select(key, "b.agree", "b.m"), "rigid-best")
    return best


def rigid_pairs(matches: DataFrame, key: str, size: tuple[int, int], *, near: float = 1.5, near_plane: float = 3.0, least: int = 12, candidates: int = 96) -> DataFrame:
    """(key, matches, rigid, share, shift, rotation, scale) of ``matches(key, x, y, u, v)`` in frames of ``size`` (w, h).

    ``rigid`` is how many matches the better model explains. Motion is that of the frame's middle under the homography,
    in cells, degrees and as a factor. Pairs under ``least`` matches have no share.
    """
    rows = matches.select(key, *(F.col(c).cast("double").alias(c) for c in "xyuv"))
    rows = materialise(rows.withColumns(dict(zip(SCALED, _scaled(size), strict=True))), "rigid-matches")
    n = rows.groupBy(key).agg(F.count("*").alias("matches"))
    enough = rows.join(n.where(F.col("matches") >= least).select(key), key)
    blocks = materialise(_blocks(enough, key), "rigid-blocks")
    f = consensus(enough, blocks, key, size, near, epipolar_rows, sampson, _sampson, True, candidates=candidates).select(key, F.col("agree").alias("__f"))
    h = consensus(enough, blocks, key, size, near_plane, homography_rows, transfer, _transfer, False, candidates=candidates).select(key, F.col("agree").alias("__h"), F.col("m").alias("h"))
    m = F.col("h")
    rigid = F.greatest(F.coalesce("__f", F.lit(0)), F.coalesce("__h", F.lit(0)))
    many = F.col("matches") >= least
    # the middle is the origin of scaled coordinates
    a = [m[k] / F.nullif(m[8], F.lit(0.0)) for k in range(9)]
    motion = {
        "shift": F.hypot(a[2], a[5]) * max(size),
        "rotation": F.degrees(F.atan2(a[3] - a[1], a[0] + a[4])),
        "scale": F.sqrt(F.abs(a[0] * a[4] - a[1] * a[3])),
    }
    made = n.join(f, key, "left").join(h, key, "left")
    return made.select(key, "matches", F.when(many, rigid).otherwise(0).alias("rigid"), F.when(many, rigid / F.col("matches")).alias("share"), *(F.when(many, e).alias(k) for k, e in motion.items()))
