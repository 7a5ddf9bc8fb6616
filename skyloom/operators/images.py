"""Pixel statistics of small grey images held in rows (inventory R14 to R16, R28, A79): Arrow batches, NumPy stencils.

An image is ``pixels array<double>`` by rows with its width; one that is empty or smaller than a stencil gives null.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _measure(f: Callable[[np.ndarray], float], least: int) -> Callable[[Column, Column], Column]:
    @F.pandas_udf(DoubleType())
    def run(pixels: pd.Series, width: pd.Series) -> pd.Series:
        out = []
        for p, w in zip(pixels, width, strict=True):
            g = None if p is None or w is None or not len(p) or len(p) % w else np.asarray(p, float).reshape(-1, int(w))
            out.append(None if g is None or min(g.shape) < least else float(f(g)))
        return pd.Series(out, dtype="float64")

    return run


def _laplacian(g: np.ndarray) -> float:
    c = g[1:-1, 1:-1]
    return (g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] - 4 * c).var()


def _blockiness(g: np.ndarray, block: int = 8) -> float:
    """Mean step over block boundaries against the mean step elsewhere."""
    steps = np.abs(np.diff(g, axis=1)).mean(0), np.abs(np.diff(g, axis=0)).mean(1)
    on = np.concatenate([s[block - 1 :: block] for s in steps])
    off = np.concatenate([np.delete(s, np.s_[block - 1 :: block]) for s in steps])
    return on.mean() / max(off.mean(), 1e-9) if len(on) else 1.0


def _anisotropy(g: np.ndarray) -> float:
    """How unevenly spectral power lies over directions: 0 for even, 1 for one direction."""
    power = np.abs(np.fft.fftshift(np.fft.fft2(g - g.mean()))) ** 2
    y, x = np.indices(power.shape)
    angle = 2 * np.arctan2(y - power.shape[0] // 2, x - power.shape[1] // 2)
    total = power.sum()
    return abs((power * np.exp(1j * angle)).sum()) / total if total > 0 else 0.0


def _texture(g: np.ndarray, window: int = 3) -> float:
    """Mean local variance: box mean of squares less the square of the box mean."""
    view = np.lib.stride_tricks.sliding_window_view(g, (window, window))
    return view.var((-2, -1)).mean()


#: R16, R14, R15, R28.
variance_of_laplacian = _measure(_laplacian, 3)
blockiness = _measure(_blockiness, 9)
anisotropy = _measure(_anisotropy, 4)
texture_variance = _measure(_texture, 3)


def saturated_share(pixels: Column, level: float = 250.0) -> Column:
    """Share of pixels at or above a level."""
    return F.when(F.size(pixels) > 0, F.size(F.filter(pixels, lambda p: p >= level)) / F.size(pixels))


def block_boundary(row: Column, col: Column, block: int, px: int) -> Column:
    """Whether a cell lies within ``px`` of a block boundary."""
    near = lambda v: F.least(F.pmod(v, F.lit(block)), block - 1 - F.pmod(v, F.lit(block))) < px
    return near(row) | near(col)


def texture_quality(pixels: Column, empty: float, tolerance: float = 2.0, black: float = 8.0) -> Column:
    """(used, black_pct): share of an atlas that is not the empty value, and the black share of that."""
    used = F.filter(pixels, lambda p: F.abs(p - empty) > tolerance)
    share = F.size(used) / F.nullif(F.size(pixels), F.lit(0))
    dark = F.size(F.filter(used, lambda p: p <= black))
    return F.struct(share.alias("used"), (100 * dark / F.nullif(F.size(used), F.lit(0))).alias("black_pct"))
