"""Ordered operators over tracks: rolling medians, baselines, runs, forward windows (inventory W, O rows)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyloom.session import materialise


def _sorted_median(values: Column) -> Column:
    """Median of an array without nulls, null when empty; no sum over an open frame is needed."""
    s = F.array_sort(values)
    n = F.size(s)
    mid = (F.get(s, ((n - 1) / 2).cast("int")) + F.get(s, (n / 2).cast("int"))) / 2
    return F.when(n > 0, mid)


def rolling_median(df: DataFrame, keys: list[str], order: list[str], value: str, half: int, out: str = "median") -> DataFrame:
    """Centred median over ``half`` rows on each side; nulls are skipped and edges shortened."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-half, half)
    return df.withColumn(out, _sorted_median(F.collect_list(F.col(value)).over(w)))


def median_outliers(df: DataFrame, keys: list[str], order: list[str], value: str, half: int, tolerance: float) -> DataFrame:
    """Rows whose value is beyond ``tolerance`` of the centred median."""
    df = rolling_median(df, keys, order, value, half)
    residual = F.abs(F.col(value) - F.col("median"))
    return df.withColumn("residual", residual).withColumn("outlier", F.coalesce(residual > tolerance, F.lit(False)))


def trailing_baseline(df: DataFrame, keys: list[str], order: list[str], value: str, rows: int = 30, least: int = 5) -> DataFrame:
    """Median of the ``rows`` values before this one; null where there are fewer than ``least``."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(-rows, -1)
    held = F.collect_list(F.col(value)).over(w)
    return df.withColumn("baseline", F.when(F.size(held) >= least, _sorted_median(held)))


def forward_row(df: DataFrame, keys: list[str], time: str, columns: list[str], after: float, clamp: bool = False) -> DataFrame:
    """Of each row the first row at least ``after`` later, as ``next_<column>``.

    Past the last such row there is none, or with ``clamp`` the track's last row.
    """
    w = Window.partitionBy(*keys).orderBy(time)
    ahead = w.rangeBetween(after, Window.unboundedFollowing)
    rest = w.rowsBetween(0, Window.unboundedFollowing)
    for c in (time, *[c for c in columns if c != time]):
        found = F.first(c).over(ahead)
        df = df.withColumn(f"next_{c}", F.coalesce(found, F.last(c).over(rest)) if clamp else found)
    return df


def sample_rate(df: DataFrame, keys: list[str], time: str, unit: float = 1.0) -> DataFrame:
    """Rows, duration, rate (1 / median of the positive steps) and largest gap of each track."""
    step = F.col(time) - F.lag(time).over(Window.partitionBy(*keys).orderBy(time))
    df = df.withColumn("__step", step / unit)
    positive = F.median(F.when(F.col("__step") > 0, F.col("__step")))
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"),
        ((F.max(time) - F.min(time)) / unit).alias("duration"),
        F.when(positive > 0, 1 / positive).alias("rate"),
        F.max("__step").alias("max_gap"),
    )


def islands(df: DataFrame, keys: list[str], order: list[str], flag: Column, start: str, end: str) -> DataFrame:
    """Runs of rows with a true flag: (keys, island, start, end, n)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    held = F.coalesce(flag, F.lit(False))
    rows = df.withColumn("__on", held).withColumn("__new", (~F.coalesce(F.lag("__on").over(w), F.lit(False))).cast("int"))
    rows = rows.withColumn("island", F.sum(F.when(F.col("__on"), F.col("__new")).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.where("__on").groupBy(*keys, "island").agg(F.min(start).alias("start"), F.max(end).alias("end"), F.count("*").alias("n"))


def value_runs(df: DataFrame, keys: list[str], order: list[str], value: str, longer_than: int = 0) -> DataFrame:
    """Runs of equal values longer than ``longer_than`` rows: (keys, value, first, last, n) by position."""
    w = Window.partitionBy(*keys).orderBy(*order)
    rows = df.withColumn("__pos", F.row_number().over(w))
    group = F.col("__pos") - F.row_number().over(Window.partitionBy(*keys, value).orderBy(*order))
    runs = rows.withColumn("__run", group).groupBy(*keys, value, "__run").agg(F.min("__pos").alias("first"), F.max("__pos").alias("last"), F.count("*").alias("n"))
    return runs.where(F.col("n") > longer_than).drop("__run")


def choose_segment(segments: DataFrame, keys: list[str], target: float | None, tolerance: float) -> DataFrame:
    """Of each key's segments the one whose duration is nearest the target within the tolerance, else the longest."""
    length = F.col("end") - F.col("start")
    off = F.abs(length - F.lit(target)) if target is not None else F.lit(None).cast("double")
    near = F.when(off <= tolerance, off)
    w = Window.partitionBy(*keys).orderBy(near.asc_nulls_last(), F.desc(length), "start")
    return segments.withColumn("__k", F.row_number().over(w)).where("__k = 1").drop("__k")


def last_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order; as an aggregate, so nothing is sorted."""
    others = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("__r")).select(*keys, *(F.col(f"__r.{c}") for c in others))


def rank_share(df: DataFrame, keys: list[str], value: str, tie: str) -> DataFrame:
    """Rank of a value in its group as a share in (0, 1]."""
    w = Window.partitionBy(*keys).orderBy(value, tie)
    return df.withColumn("rank_share", F.row_number().over(w) / F.count("*").over(Window.partitionBy(*keys)))


def central_window(frames: DataFrame, index: str, n: int | Column, size: int) -> DataFrame:
    """Half-overlapping windows of ``size`` over ``n`` frames; each frame with the window it is most central to.

    The windows that hold a frame follow from its index, so no row is copied or moved.
    """
    step = max(1, size // 2)
    n = F.lit(n) if isinstance(n, int) else n
    last = F.greatest(F.lit(0), n - size)
    starts = F.array(last, *(F.least(last, F.greatest(F.lit(0), F.floor(F.col(index) / step) - k) * step) for k in range(3)))
    held = F.filter(starts, lambda s: (F.col(index) >= s) & (F.col(index) < s + size))
    middle = (F.least(F.lit(size), n) - 1) / 2
    best = F.array_min(F.transform(held, lambda s: F.struct(F.abs(F.col(index) - (s + middle)).alias("off"), s.alias("start"))))
    return frames.withColumn("__best", best).where("__best is not null").select(index, F.col("__best.start").alias("start"), F.col("__best.off").alias("off"))


def chunks(n: int, size: int, overlap: int) -> list[tuple[int, int]]:
    """[start, end) of overlapping chunks; a tail shorter than the overlap joins the chunk before."""
    out, start = [], 0
    while start < n:
        end = min(n, start + size)
        if n - end <= overlap:
            end = n
        out.append((start, end))
        if end == n:
            break
        start = end - overlap
    return out


def chunk_spans(n: Column, size: int, overlap: int) -> Column:
    """``chunks`` of a number of rows as an array of (start, stop)."""
    step = size - overlap
    # the k-th chunk is there if the one before did not reach the end
    count = F.greatest(F.lit(1), F.ceil((n - size - overlap) / step) + 1).cast("int")
    starts = F.sequence(F.lit(0), count - 1)
    return F.transform(starts, lambda k: F.struct((k * step).cast("long").alias("start"), F.when(k == count - 1, n).otherwise(k * step + size).cast("long").alias("stop")))


def overlap_series(df: DataFrame, keys: list[str], index: str, overlap: str) -> DataFrame:
    """(index, previous, stride, overlap) of consecutive frames."""
    w = Window.partitionBy(*keys).orderBy(index)
    previous = F.lag(index).over(w)
    return df.select(*keys, index, previous.alias("previous"), (F.col(index) - previous).alias("stride"), overlap)


def prefix_budget(df: DataFrame, keys: list[str], order: list[Column], cost: str, budget: float) -> DataFrame:
    """Rows in order until the budget is passed, the one that passes it included."""
    before = F.coalesce(F.sum(cost).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return df.withColumn("spent", before).where(F.col("spent") < budget)


def sample_by_hash(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows by the smallest MD5 of key and seed, the same each time; a top-k, so no full sort."""
    return df.orderBy(F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed)))), key).limit(n)


def numbered_by(df: DataFrame, order: list[Column], keys: list[str] = ()) -> DataFrame:
    """O2: rows numbered from 1 in order, within keys where given.

    Without keys the rows are dealt by ranges of the order, numbered within each, and moved on by the ranges before.
    """
    if keys:
        return df.withColumn("number", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    dealt = materialise(df.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "ranges")
    sizes = dealt.groupBy("__range").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    sizes = sizes.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    number = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return dealt.join(sizes, "__range").withColumn("number", (number + F.col("__before")).cast("long")).drop("__range", "__before")


def band_medians(df: DataFrame, keys: list[str], order: str, value: str, bands: int = 10) -> DataFrame:
    """Medians over equal-count bands in order."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("band", F.ntile(bands).over(w)).groupBy(*keys, "band").agg(F.count("*").alias("n"), F.median(value).alias("median"))
