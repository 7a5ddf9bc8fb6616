"""Exact Euclidean distance transforms over rasters kept as rows of cells."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def lower_envelope(columns: list[int], seeds: list[int], heights: list[int]) -> list[int]:
    """For each of the rising ``columns`` the number of the seed with the least ``(column - seed)^2 + height``.

    Seeds rise too; equal sums go to the smaller seed. All in integers: a seed takes over from the one before it at the
    first column where its parabola is truly lower.
    """
    kept: list[int] = []
    begins: list[int] = []
    for k, (u, f) in enumerate(zip(seeds, heights, strict=True)):
        while kept:
            i, at = kept[-1], begins[-1]
            if (at - seeds[i]) ** 2 + heights[i] <= (at - u) ** 2 + f:
                break
            kept.pop()
            begins.pop()
        if kept:
            i = kept[-1]
            at = (u * u - seeds[i] ** 2 + f - heights[i]) // (2 * (u - seeds[i])) + 1
        else:
            at = min(columns[0], seeds[0])
        if at <= columns[-1]:
            kept.append(k)
            begins.append(at)
    out, at = [], 0
    for c in columns:
        while at + 1 < len(kept) and begins[at + 1] <= c:
            at += 1
        out.append(kept[at])
    return out


def nearest_cells(cells: DataFrame, keys: list[str], row: str, col: str, seed: Column) -> DataFrame:
    """(keys, row, col, near_row, near_col, d2): of each cell the nearest cell where ``seed`` holds, and its squared distance.

    Exact and separable: the nearest seed of a cell's column follows from windows over the column, the nearest of these
    along a row from the lower envelope of their parabolas. A raster must hold all cells of its box; columns and rows
    are its largest groups. Ties go to the smaller column, then the smaller row; a raster without seeds gives nulls.
    """
    up = Window.partitionBy(*keys, col).orderBy(row).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy(*keys, col).orderBy(row).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    at = F.when(seed, F.col(row)).cast("long")
    above, below, r = F.last(at, ignorenulls=True).over(up), F.first(at, ignorenulls=True).over(down), F.col(row)
    first = cells.select(*keys, F.col(row).cast("long").alias(row), F.col(col).cast("long").alias(col), above.alias("__a"), below.alias("__b"))
    near = F.when(F.col("__b").isNull() | (r - F.col("__a") <= F.col("__b") - r), F.col("__a")).otherwise(F.col("__b"))
    lines = first.groupBy(*keys, row).agg(F.sort_array(F.collect_list(F.struct(F.col(col).alias("c"), near.alias("n")))).alias("__line"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for r, line in zip(batch.column(len(keys)).to_pylist(), batch.column(len(keys) + 1).to_pylist(), strict=True):
                columns = [x["c"] for x in line]
                known = [(x["c"], x["n"], (x["n"] - r) ** 2) for x in line if x["n"] is not None]
                if not known:
                    found.append([{"c": c} for c in columns])
                    continue
                seeds, rows, heights = (list(x) for x in zip(*known, strict=True))
                best = lower_envelope(columns, seeds, heights)
                found.append([{"c": c, "near_row": rows[k], "near_col": seeds[k], "d2": (c - seeds[k]) ** 2 + heights[k]} for c, k in zip(columns, best, strict=True)])
            kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("c", "near_row", "near_col", "d2")]))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys) + 1], pa.array(found, kind)], [*keys, row, "__line"])

    kinds = dict(first.dtypes)
    head = "".join(f"`{k}` {kinds[k]}, " for k in [*keys, row])
    done = lines.mapInArrow(run, head + "__line array<struct<c: long, near_row: long, near_col: long, d2: long>>")
    return done.select(*keys, row, F.inline("__line")).withColumnRenamed("c", col)
