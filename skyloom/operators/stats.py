"""Robust statistics and roll-ups (inventory A rows)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyloom.session import materialise

NMAD = 1.4826
#: Rows of a bin up to which its values are counted and put in order.
MANY = 1_000_000


def _log(x: Column) -> Column:
    """A rising function of any double, close to the logarithm of its size, by which values are binned."""
    return F.signum(x) * F.log2(1 + F.abs(x) * 2.0**30)


def quantiles(df: DataFrame, keys: list[str], value: str, shares: list[float]) -> DataFrame:
    """(keys, n, q0, q1, ..): exact interpolated quantiles of each group, nulls left out.

    Counts by wide bins show in which bin each wanted rank lies; while one of these bins holds many rows, counts by
    narrower bins of its rows show where in it; counts by value show the value. Counts merge before they shuffle and are
    written before they are put in order, so a group may hold any share of the rows.
    """
    x = F.col(value).cast("double")
    by = keys or ["__all"]
    rows = df if keys else df.withColumn("__all", F.lit(0))
    rows = rows.where(x.isNotNull()).select(*by, (x + 0.0).alias("__x"))
    ranks = [f(F.lit(float(q)) * (F.col("n") - 1)) for q in shares for f in (F.floor, F.ceil)]
    has = reduce(lambda p, q: p | q, ((r >= F.col("__upto") - F.col("__k")) & (r < F.col("__upto")) for r in ranks))

    def ordered(held: DataFrame, within: list[str], column: str) -> DataFrame:
        """Counts by ``column`` in order within the bins so far, with how many rows of their group lie up to each."""
        counts = materialise(held.groupBy(*within, column).agg(F.count("*").alias("__k")), "quantile-counts")
        return counts.withColumn("__upto", F.sum("__k").over(Window.partitionBy(*within).orderBy(column).rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    def bins(counts: DataFrame) -> DataFrame:
        """The bins that hold a wanted rank; one file, so that its real size decides how it is joined."""
        return materialise(counts.where(has).select(*by, "__b", "n", (F.col("__upto") - F.col("__k")).alias("__start"), "__k").repartition(1), "quantile-bins")

    within = [*by, "__b", "n", "__start"]
    binned = lambda df, scale, name: df.withColumn(name, F.floor(_log(F.col("__x")) * scale).cast("long"))
    scale = 64
    wanted = bins(ordered(binned(rows, scale, "__b"), by, "__b").withColumn("n", F.sum("__k").over(Window.partitionBy(*by))))
    while scale < 1 << 30 and (wanted.agg(F.max("__k")).first()[0] or 0) > MANY:
        inner = binned(binned(rows, scale, "__b").join(wanted.drop("__k"), [*by, "__b"]), scale << 8, "__c")
        finer = ordered(inner, within, "__c").withColumn("__upto", F.col("__upto") + F.col("__start"))
        wanted, scale = bins(finer.drop("__b", "__start").withColumnRenamed("__c", "__b")), scale << 8
    inner = binned(rows, scale, "__b").join(wanted.drop("__k"), [*by, "__b"])
    wanted = ordered(inner, within, "__x").withColumn("__upto", F.col("__upto") + F.col("__start")).where(has)
    pick = lambda r: F.min(F.when(F.col("__upto") > r, F.col("__x")))
    ends = [(pick(ranks[2 * k]), pick(ranks[2 * k + 1])) for k in range(len(shares))]
    found = wanted.groupBy(*by, "n").agg(*(c.alias(f"{e}{k}") for k, pair in enumerate(ends) for e, c in zip("ab", pair, strict=True)))
    part = lambda q: F.lit(float(q)) * (F.col("n") - 1) - F.floor(F.lit(float(q)) * (F.col("n") - 1))
    return found.select(*keys, "n", *((F.col(f"a{k}") + (F.col(f"b{k}") - F.col(f"a{k}")) * part(q)).alias(f"q{k}") for k, q in enumerate(shares)))


def hash_pairs(rows: DataFrame, key: str, place: Column, columns: list[str], pairs: int) -> DataFrame:
    """(key, __k, p, q): about ``pairs`` pairs of unlike rows of each key as structs of ``columns``, the same in each run.

    A hash of ``place`` deals rows into classes, whose first and last row by it are a pair. A key with few rows has half
    as many classes as rows and deals them anew until there are enough; one with many deals them once, in a merged
    aggregate that gathers nothing: the least and greatest beginning of a hash, a number, of each class shows the few rows
    that are compared by the whole of it, so no rows are sorted.
    """
    sizes = rows.groupBy(key).agg(F.count("*").alias("__n")).withColumn("__m", F.greatest(F.lit(1), F.least(F.lit(pairs), F.floor(F.col("__n") / 2))).cast("long"))
    sizes = materialise(sizes, "hash-sizes")  # its real size decides, so that rows stay where they are if keys are few
    times = F.sequence(F.lit(0).cast("long"), F.ceil(F.lit(pairs) / F.col("__m")) - 1)
    dealt = rows.join(sizes, key).select(key, *columns, "__m", place.alias("__p"), F.explode(times).alias("__t"))
    dealt = dealt.withColumn("__h", F.md5(F.concat_ws(":", "__p", "__t")))
    dealt = dealt.withColumn("__b", F.conv(F.substring("__h", 1, 15), 16, 10).cast("long"))
    dealt = dealt.withColumn("__k", F.col("__t") * F.col("__m") + F.shiftright("__b", 36) % F.col("__m"))
    bounds = dealt.groupBy(F.col(key).alias("__key"), F.col("__k").alias("__of")).agg(F.min("__b").alias("__lo"), F.max("__b").alias("__hi"))
    bounds = materialise(bounds, "hash-bounds")
    outer = dealt.join(bounds, F.col(key).eqNullSafe(F.col("__key")) & (F.col("__k") == F.col("__of")) & F.col("__b").isin(F.col("__lo"), F.col("__hi")))
    ends = outer.groupBy(key, "__k").agg(*(f(F.struct("__h", *columns)).alias(n) for f, n in ((F.min, "p"), (F.max, "q"))))
    return ends.where("p.__h <> q.__h")


def error_stats(df: DataFrame, keys: list[str], d: str) -> DataFrame:
    """A1: n, mean, median, RMS, 95th percentile of the size and NMAD of signed errors.

    Sums merge; the percentiles are exact by ``quantiles``, so no group's values meet in one task.
    """
    by = keys or ["__one"]
    rows = (df if keys else df.withColumn("__one", F.lit(0))).where(F.col(d).isNotNull()).select(*by, F.col(d).cast("double").alias("__d"))
    medians = quantiles(rows, by, "__d", [0.5]).select(*by, F.col("q0").alias("median"))
    medians = materialise(medians.repartition(1), "medians")
    sizes = rows.join(medians, by).select(*by, F.posexplode(F.array(F.abs("__d"), F.abs(F.col("__d") - F.col("median")))).alias("__of", "__v"))
    sizes = quantiles(sizes, [*by, "__of"], "__v", [0.5, 0.95])
    sizes = sizes.groupBy(*by).agg(F.max(F.when(F.col("__of") == 0, F.col("q1"))).alias("p95"), (NMAD * F.max(F.when(F.col("__of") == 1, F.col("q0")))).alias("nmad"))
    sums = rows.groupBy(*by).agg(F.count("*").alias("n"), F.avg("__d").alias("mean"), F.sqrt(F.avg(F.col("__d") * F.col("__d"))).alias("rms"))
    return sums.join(medians, by).join(sizes, by).select(*keys, "n", "mean", "median", "rms", "p95", "nmad")


def nmad(df: DataFrame, keys: list[str], value: str, name: str = "nmad") -> DataFrame:
    """A1: NMAD of groups that are each a track or a cell, by Spark's own exact median; ``error_stats`` is for groups of any size."""
    middle = df.groupBy(*keys).agg(F.median(value).alias("__m"))
    off = F.abs(F.col(value) - F.col("__m"))
    return df.select(*keys, value).join(middle, keys).groupBy(*keys).agg((NMAD * F.median(off)).alias(name))


def grouped_error_stats(df: DataFrame, labels: list[Column], d: str, name: str = "grp") -> DataFrame:
    """Error statistics of overlapping groups; a row counts in each group whose label isn't null."""
    rows = df.select(F.explode(F.array_compact(F.array(*labels))).alias(name), d)
    return error_stats(rows, [name], d)


def overlap_stats(df: DataFrame, keys: list[str], order: list[str], value: str, low: float) -> DataFrame:
    """A2: mean, median, 10th and 90th percentile and low count, without each track's first row."""
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    rows = df.withColumn("__k", first).where("__k > 1")
    p = F.percentile(value, F.array(F.lit(0.1), F.lit(0.9)))
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n"), F.avg(value).alias("mean"), F.median(value).alias("median"), p[0].alias("p10"), p[1].alias("p90"), F.count_if(F.col(value) < low).alias("low")
    )


def robust_low_threshold(df: DataFrame, keys: list[str], value: str, sigmas: float) -> DataFrame:
    """A4: median less ``sigmas`` robust deviations of the upper half; half the median where that half is flat."""
    medians = df.groupBy(*keys).agg(F.median(value).alias("median"))
    rows = df.select(*keys, value).join(medians, keys)
    over = F.when(F.col(value) > F.col("median"), F.col(value) - F.col("median"))
    found = rows.groupBy(*keys).agg(F.first("median").alias("median"), F.median(over).alias("spread"))
    spread = F.coalesce("spread", F.lit(0.0))
    return found.select(*keys, "median", F.when(spread > 0, F.col("median") - sigmas * NMAD * spread).otherwise(F.col("median") / 2).alias("threshold"))


def clip_percentiles(df: DataFrame, keys: list[str], columns: list[str], lo: float = 0.05, hi: float = 0.95) -> DataFrame:
    """Values held within two percentiles of their group."""
    bounds = df.groupBy(*keys).agg(*(F.percentile(c, F.array(F.lit(lo), F.lit(hi))).alias(f"__p_{c}") for c in columns))
    rows = df.join(bounds, keys)
    for c in columns:
        rows = rows.withColumn(c, F.least(F.greatest(F.col(c), F.col(f"__p_{c}")[0]), F.col(f"__p_{c}")[1]))
    return rows.drop(*(f"__p_{c}" for c in columns))


def clipped_corr(df: DataFrame, keys: list[str], x: str, y: str, least: int = 5) -> DataFrame:
    """Pearson's r of percentile-clipped pairs; null under ``least`` pairs or without spread."""
    pairs = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*keys, F.col(x).cast("double").alias(x), F.col(y).cast("double").alias(y))
    rows = clip_percentiles(pairs, keys, [x, y])
    flat = (F.stddev_pop(x) == 0) | (F.stddev_pop(y) == 0)
    return rows.groupBy(*keys).agg(F.count("*").alias("n"), F.when((F.count("*") >= least) & ~flat, F.corr(x, y)).alias("r"))


def line_fit(df: DataFrame, keys: list[str], x: str, y: str, symmetric: bool = False) -> DataFrame:
    """Least-squares line, or the symmetric one whose slope is the ratio of deviations."""
    a, b = F.col(x), F.col(y)
    both = F.when(a.isNotNull() & b.isNotNull(), F.lit(1))
    xx, yy = F.when(both.isNotNull(), a), F.when(both.isNotNull(), b)
    slope = F.stddev_pop(yy) / F.stddev_pop(xx) * F.sign(F.corr(xx, yy)) if symmetric else F.regr_slope(b, a)
    made = df.groupBy(*keys).agg(F.count(both).alias("n"), slope.alias("slope"), F.avg(xx).alias("__x"), F.avg(yy).alias("__y"))
    return made.select(*keys, "n", "slope", (F.col("__y") - F.col("slope") * F.col("__x")).alias("intercept"))


def track_length(df: DataFrame, keys: list[str], order: str, coords: list[str]) -> DataFrame:
    """A10: summed steps between consecutive rows whose coordinates are all there."""
    there = df.dropna(subset=coords)
    w = Window.partitionBy(*keys).orderBy(order)
    step = F.sqrt(sum((F.pow(F.col(c) - F.lag(c).over(w), 2) for c in coords), F.lit(0.0)))
    return there.select(*keys, step.alias("__s")).groupBy(*keys).agg(F.coalesce(F.sum("__s"), F.lit(0.0)).alias("length"))


def telemetry_summary(df: DataFrame, keys: list[str], time: str, columns: list[str], flags: str) -> DataFrame:
    """Rows, duration, which columns hold anything, their ranges, and the RTK bit."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"),
        (F.max(time) - F.min(time)).alias("duration"),
        *(F.bool_or(F.col(c).isNotNull()).alias(f"has_{c}") for c in columns),
        *(F.min(c).alias(f"min_{c}") for c in columns),
        *(F.max(c).alias(f"max_{c}") for c in columns),
        (F.bit_or(flags).bitwiseAND(F.lit(32)) != 0).alias("rtk"),
    )


def status_counts(df: DataFrame, keys: list[str], status: str, names: list[str]) -> DataFrame:
    """How many rows have each status, zeros included."""
    return df.groupBy(*keys).agg(*(F.count_if(F.col(status) == n).alias(f"n_{n.lower()}") for n in names))


def stage_score(df: DataFrame, keys: list[str], status: str, cap: str | None = None) -> DataFrame:
    """100 for pass, 50 for warn, 0 for fail, averaged without info rows; failed gates cap it."""
    points = F.when(F.col(status) == "pass", 1.0).when(F.col(status) == "warn", 0.5).when(F.col(status) == "fail", 0.0)
    score = F.avg(points) * 100
    if cap:
        score = F.least(score, F.coalesce(F.min(F.when(F.col(status) == "fail", F.col(cap))), score))
    return df.groupBy(*keys).agg(F.count(points).alias("scored"), score.alias("score"))


def verdict(df: DataFrame, keys: list[str], status: str) -> DataFrame:
    """BLOCKED with any BLOCK, READY_WITH_WARNINGS with any WARN, else READY."""
    worst = F.max(F.when(F.col(status) == "BLOCK", 2).when(F.col(status) == "WARN", 1).otherwise(0))
    return df.groupBy(*keys).agg(F.when(worst == 2, "BLOCKED").when(worst == 1, "READY_WITH_WARNINGS").otherwise("READY").alias("verdict"))


def lag_search(series: DataFrame, reference: DataFrame, key: str, x: str, y: str, lags: list[int], least: int = 5) -> DataFrame:
    """Pearson's r of two regular series at each lag; rows are replicated once for each lag."""
    moved = series.select(F.explode(F.array(*map(F.lit, lags))).alias("lag"), F.col(key), F.col(x))
    moved = moved.withColumn(key, F.col(key) + F.col("lag"))
    joined = moved.join(reference.select(key, y), key)
    return joined.groupBy("lag").agg(F.count("*").alias("n"), F.when(F.count("*") >= least, F.corr(x, y)).alias("r"))


def best_lag(found: DataFrame, far: int) -> DataFrame:
    """The lag with the highest r, and by how much it tops the 90th percentile of lags ``far`` from it."""
    best = found.agg(F.max_by("lag", F.struct("r", -F.col("lag"))).alias("lag"), F.max("r").alias("r"))
    rest = found.select(F.col("lag").alias("l"), F.col("r").alias("rl")).crossJoin(F.broadcast(best)).where(F.abs(F.col("l") - F.col("lag")) > far)
    return rest.groupBy("lag", "r").agg((F.first("r") - F.percentile("rl", 0.9)).alias("margin"))


def doming(df: DataFrame, keys: list[str], x: str, y: str, z: str) -> DataFrame:
    """Z on a plane and r squared; sums in Spark, the 4 x 4 system solved with Cramer's rule as expressions."""
    terms = {"c": F.lit(1.0), "x": F.col(x), "y": F.col(y), "q": F.col(x) * F.col(x) + F.col(y) * F.col(y)}
    names = list(terms)
    sums = [F.sum(terms[a] * terms[b]).alias(f"{a}{b}") for i, a in enumerate(names) for b in names[i:]]
    sums += [F.sum(terms[a] * F.col(z)).alias(f"{a}z") for a in names]
    made = df.groupBy(*keys).agg(F.count("*").alias("n"), *sums)
    m = [[F.col(a + b if names.index(a) <= names.index(b) else b + a) for b in names] for a in names]
    right = [F.col(f"{a}z") for a in names]

    def det(rows: list[list[Column]]) -> Column:
        if len(rows) == 1:
            return rows[0][0]
        out = F.lit(0.0)
        for j, v in enumerate(rows[0]):
            out = out + (1 if j % 2 == 0 else -1) * v * det([r[:j] + r[j + 1 :] for r in rows[1:]])
        return out

    whole = det(m)
    solved = [det([[right[i] if k == j else m[i][k] for k in range(4)] for i in range(4)]) / whole for j in range(4)]
    return made.select(*keys, "n", *(F.when(whole != 0, s).alias(n) for s, n in zip(solved, ("offset", "tilt_x", "tilt_y", "dome"), strict=True)))


def collinearity(df: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """Root of the ratio of the covariance's eigenvalues, in closed form."""
    a, b, c = F.var_samp(x), F.var_samp(y), F.covar_samp(x, y)
    made = df.groupBy(*keys).agg(a.alias("a"), b.alias("b"), c.alias("c"))
    half, root = (F.col("a") + F.col("b")) / 2, F.sqrt(F.pow((F.col("a") - F.col("b")) / 2, 2) + F.pow("c", 2))
    return made.select(*keys, F.when(half + root > 0, F.sqrt(F.greatest(half - root, F.lit(0.0)) / (half + root))).alias("collinearity"))


def truth_kpis(df: DataFrame, keys: list[str], predicted: Column, truth: Column) -> DataFrame:
    """Recall, false-reject rate and leaks of a rejection rule."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("n"),
        (F.count_if(predicted & truth) / F.nullif(F.count_if(truth), F.lit(0))).alias("recall"),
        (F.count_if(predicted & ~truth) / F.nullif(F.count_if(~truth), F.lit(0))).alias("false_reject"),
        F.count_if(~predicted & truth).alias("leaks"),
    )
