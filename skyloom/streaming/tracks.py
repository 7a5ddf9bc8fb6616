"""Streaming forms of the stateful track operators; their results equal the batch operators' (inventory W2, W8, P11).

State is one small record for each track: what the recurrence carries over, never the rows themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def trailing_baseline(stream: DataFrame, key: str, time: str, value: str, rows: int = 30, least: int = 5) -> DataFrame:
    """The median of the ``rows`` values before each row; state holds those values.

    Rows of a batch are put in order of time; batches are taken to come in order, as those of a log do.
    """
    kinds = dict(stream.dtypes)
    schema = f"`{key}` {kinds[key]}, `{time}` {kinds[time]}, `{value}` double, baseline double"

    def step(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = list(state.get[0]) if state.exists else []
        pdf = pd.concat(list(batches)).sort_values(time, kind="stable")
        out = []
        for v in pdf[value]:
            out.append(float(pd.Series(held).median()) if len(held) >= least else None)
            held = [*held, float(v)][-rows:]
        state.update((held,))
        yield pd.DataFrame({key: pdf[key], time: pdf[time], value: pdf[value].astype(float), "baseline": out})

    rows_ = stream.select(key, time, F.col(value).cast("double").alias(value))
    return rows_.groupBy(key).applyInPandasWithState(step, schema, "held array<double>", "append", GroupStateTimeout.NoTimeout)


def rejection_runs(stream: DataFrame, key: str, time: str, flag: str, longer_than: int) -> DataFrame:
    """Runs of rejected rows longer than ``longer_than``, given out when they end."""
    kinds = dict(stream.dtypes)
    schema = f"`{key}` {kinds[key]}, start {kinds[time]}, `end` {kinds[time]}, n long"
    at = kinds[time]

    def step(group: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        start, end, n = state.get if state.exists else (None, None, 0)
        out = []
        for t, bad in pd.concat(list(batches)).sort_values(time, kind="stable")[[time, flag]].itertuples(index=False):
            if bad:
                start, end, n = (t if n == 0 else start), t, n + 1
            else:
                if n > longer_than:
                    out.append((group[0], start, end, n))
                start, end, n = None, None, 0
        state.update((start, end, n))
        yield pd.DataFrame(out, columns=[key, "start", "end", "n"])

    return stream.select(key, time, flag).groupBy(key).applyInPandasWithState(step, schema, f"start {at}, `end` {at}, n long", "append", GroupStateTimeout.NoTimeout)


def windowed_quality(stream: DataFrame, key: str, time: str, value: str, length: str, delay: str) -> DataFrame:
    """Counts, means and extremes of tumbling windows; late rows are taken until the watermark passes."""
    w = stream.withWatermark(time, delay).groupBy(key, F.window(time, length))
    made = w.agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.min(value).alias("least"), F.max(value).alias("most"))
    return made.select(key, F.col("window.start").alias("start"), F.col("window.end").alias("end"), "n", "mean", "least", "most")
