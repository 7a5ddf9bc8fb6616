"""Placing a model in the world: ground plane, robust similarity, cameras, pieces (inventory A34, G13, J31, M22, M27, S38)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions import scalar as S
from skyloom.operators.recurrences import similarity
from skyloom.operators.stats import quantiles
from skyloom.operators.windows import last_per_key
from skyloom.session import materialise


def ground_normal(points: DataFrame, cameras: DataFrame, keys: list[str], xyz: list[str]) -> DataFrame:
    """Unit normal of each key's best plane through its points, on the side of its cameras.

    Sums of products merge in Spark; NumPy solves one 3 x 3 matrix for each key.
    """
    sums = [F.avg(F.col(a) * F.col(b)).alias(f"p_{i}_{j}") for i, a in enumerate(xyz) for j, b in enumerate(xyz[: i + 1])]
    made = points.groupBy(*keys).agg(*(F.avg(c).alias(f"m_{i}") for i, c in enumerate(xyz)), *sums)
    made = made.join(cameras.groupBy(*keys).agg(*(F.avg(c).alias(f"c_{i}") for i, c in enumerate(xyz))), keys)
    kinds = dict(points.dtypes)

    def run(batches):
        for pdf in batches:
            normals = []
            for _, r in pdf.iterrows():
                mean = np.array([r[f"m_{i}"] for i in range(3)], float)
                cov = np.array([[r[f"p_{max(i, j)}_{min(i, j)}"] for j in range(3)] for i in range(3)], float) - np.outer(mean, mean)
                n = np.linalg.eigh(cov)[1][:, 0]
                up = np.array([r[f"c_{i}"] for i in range(3)], float) - mean
                normals.append((n if up @ n > 0 else -n).tolist())
            yield pdf[keys].assign(normal=normals)

    return made.mapInPandas(run, "".join(f"`{k}` {kinds[k]}, " for k in keys) + "normal array<double>")


def _moved(xyz: list[str], fit: str = "") -> list[Column]:
    return S.apply_similarity(xyz, F.col(f"{fit}scale"), F.col(f"{fit}rotation"), F.col(f"{fit}shift"))


def _length(a: list[Column], b: list[Column]) -> Column:
    return F.sqrt(sum((F.pow(x - y, 2) for x, y in zip(a, b, strict=True)), F.lit(0.0)))


def robust_similarity(
    pairs: DataFrame, keys: list[str], id_: str, source: list[str], target: list[str], *, threshold: float, extra: DataFrame | None = None, samples: int = 3, hypotheses: int = 64, rounds: int = 4, seed: int = 0
) -> DataFrame:
    """(keys, scale, rotation, shift, cameras, inliers, rms_all, rms_inliers) by consensus.

    Hypotheses are similarities of ``samples`` pairs, those with the smallest hashes in shares of each key's pairs,
    dealt anew each round; ``extra(keys, source, target, weight)`` (ground pairs, control points) is in every fit. The
    hypothesis with most pairs nearer than ``threshold``, then the least mean distance, is refitted over its inliers.
    """
    own = pairs.select(*keys, id_, *source, *target).withColumn("weight", F.lit(1.0))
    own = materialise(own, "similarity-pairs")
    dealt = own.withColumn("__round", F.explode(F.array(*map(F.lit, range(rounds)))))
    share = F.pmod(F.xxhash64(id_, "__round", F.lit(seed)), F.lit(samples * hypotheses // rounds))
    dealt = dealt.withColumns({"__share": share, "__hash": F.xxhash64(id_, "__round")})
    shares = [*keys, "__round", "__share"]
    least = materialise(dealt.groupBy(*shares).agg(F.min("__hash").alias("__hash")), "similarity-least")  # a number, so no rows are sorted
    picked = dealt.join(least, [*shares, "__hash"]).groupBy(*shares).agg(F.min(F.struct(*source, *target)).alias("p"))
    picked = picked.select(*keys, (F.col("__round") * hypotheses + F.floor(F.col("__share") / samples)).cast("int").alias("__h"), *(F.col(f"p.{c}").alias(c) for c in [*source, *target]), F.lit(1.0).alias("weight"))
    full = picked.groupBy(*keys, "__h").agg(F.count("*").alias("__n")).where(F.col("__n") == samples).select(*keys, "__h")
    picked = picked.join(full, [*keys, "__h"])
    if extra is not None:
        picked = picked.unionByName(extra.select(*keys, *source, *target, "weight").join(full, keys))
    tried = materialise(similarity(picked, [*keys, "__h"], source, target, "weight").where(~F.isnan("scale")).drop("n"), "similarity-tries")
    far = _length(_moved(source), [F.col(c) for c in target])
    judged = own.join(tried, keys).select(*keys, "__h", far.alias("__far"))
    scores = judged.groupBy(*keys, "__h").agg(F.count_if(F.col("__far") < threshold).alias("inliers"), F.avg("__far").alias("__mean"))
    best = scores.groupBy(*keys).agg(F.max_by("__h", F.struct("inliers", -F.col("__mean"), -F.col("__h"))).alias("__h"))
    best = materialise(tried.join(best, [*keys, "__h"]).drop("__h"), "similarity-best")
    inside = own.join(best, keys).where(far < threshold).select(*keys, *source, *target, "weight")
    found = inside if extra is None else inside.unionByName(extra.select(*keys, *source, *target, "weight"))
    fit = materialise(similarity(found, keys, source, target, "weight").drop("n"), "similarity-fit")
    near = own.join(fit, keys).withColumn("__far", far)
    ok = F.col("__far") < threshold
    report = near.groupBy(*keys).agg(
        F.count("*").alias("cameras"), F.count_if(ok).alias("inliers"), F.sqrt(F.avg(F.col("__far") * F.col("__far"))).alias("rms_all"), F.sqrt(F.avg(F.when(ok, F.col("__far") * F.col("__far")))).alias("rms_inliers")
    )
    return fit.join(report, keys)


def posed_cameras(cameras: DataFrame, fit: DataFrame, keys: list[str], centre: list[str], rotation: str) -> DataFrame:
    """Cameras with their centre moved by a key's similarity and their rotation turned with it (R times G transposed)."""
    r, g = F.col(rotation), F.col("fit_rotation")
    turned = F.array(*(sum((r[3 * i + k] * g[3 * j + k] for k in range(3)), F.lit(0.0)) for i in range(3) for j in range(3)))
    rows = cameras.join(fit.select(*keys, *(F.col(c).alias(f"fit_{c}") for c in ("scale", "rotation", "shift"))), keys)
    rest = [c for c in cameras.columns if c not in (*centre, rotation)]
    return rows.select(*rest, *(m.alias(c) for m, c in zip(_moved(centre, "fit_"), centre, strict=True)), turned.alias(rotation))


def merged_pieces(pieces: DataFrame, gps: DataFrame, piece: str, frame: str, source: list[str], target: list[str], least: int, max_rms: float) -> DataFrame:
    """Frames of a model's pieces, each placed by its similarity to GPS; a frame of several is that of the largest.

    Pieces with fewer than ``least`` frames or a larger error are left out.
    """
    pairs = pieces.select(piece, frame, *source).join(gps.select(frame, *target), frame)
    fit = materialise(similarity(pairs, [piece], source, target), "piece-fits")
    placed = pairs.join(fit, piece).withColumn("__far", _length(_moved(source), [F.col(c) for c in target]))
    sound = placed.groupBy(piece).agg(F.first("n").alias("n"), F.sqrt(F.avg(F.pow("__far", 2))).alias("rms")).where((F.col("n") >= least) & (F.col("rms") <= max_rms))
    moved = pieces.select(piece, frame, *source).join(fit.drop("n"), piece).join(sound, piece)
    moved = moved.select(piece, frame, "n", *(c.alias(t) for c, t in zip(_moved(source), target, strict=True)))
    return last_per_key(moved, [frame], [-F.col("n"), F.col(piece)]).drop("n")


def control_on_map(points: DataFrame, lon: str, lat: str, height: str, undulation: str | None = None) -> DataFrame:
    """Control points in map metres; ellipsoidal heights come down by the ``undulation``."""
    e, n = S.utm(lon, lat)
    h = F.col(height) - F.col(undulation) if undulation else F.col(height)
    return points.withColumns({"e": e, "n": n, "h": h, "epsg": S.utm_epsg(lon, lat)})


def residual_bands(residuals: DataFrame, keys: list[str], value: str, good: float, fair: float) -> DataFrame:
    """How well a placement fits: pairs, median and RMS, and the status of the RMS."""
    middle = quantiles(residuals, keys, value, [0.5]).select(*keys, F.col("q0").alias("median"))
    made = residuals.groupBy(*keys).agg(F.count(value).alias("n"), F.sqrt(F.avg(F.pow(value, 2))).alias("rms")).join(middle, keys)
    return made.withColumn("status", S.lower_better("rms", good, fair))


def with_undulation(points: DataFrame, grid: DataFrame, step: float, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """``points`` with ``undulation`` between the four nodes around, from ``grid(row, col, n)``: row and col count
    steps of degrees from -90 and -180. The grid closes at 180 degrees; where a node is missing there is none.

    An equi-join by node: the four nodes of a point are four rows, their weighted values are summed by point.
    """
    around = round(360 / step)
    y, x = (F.col(lat) + 90) / step, F.pmod(F.col(lon) + 180, F.lit(360.0)) / step
    top = round(180 / step) - 1
    r, c = F.least(F.floor(y), F.lit(top)), F.floor(x)
    node = lambda i, j: F.struct((r + i).alias("row"), F.pmod(c + j, F.lit(around)).alias("col"), ((y - r if i else 1 - (y - r)) * (x - c if j else 1 - (x - c))).alias("w"))
    keyed = points.withColumn("__place", F.struct(lon, lat))
    places = keyed.select("__place", lon, lat).distinct()
    four = places.select("__place", F.inline(F.array(*(node(i, j) for i in (0, 1) for j in (0, 1))))).where("w > 0")
    found = four.join(grid, ["row", "col"], "left").groupBy("__place")
    found = found.agg(F.when(F.count("n") == F.count("*"), F.sum(F.col("w") * F.col("n"))).alias("undulation"))
    return keyed.join(found, "__place", "left").drop("__place")
