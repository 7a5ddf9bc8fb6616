"""Quality rules by robust multivariate outliers (operator 3), native.

Each text gives a vector of transformed statistics. Minimum-covariance-determinant estimates are made for each
language and source, for each language, and for all rows: of several starts (medians and quartiles alone, with the
correlations of squashed values, with those of directions) concentration steps go on to the rows with the smallest
Mahalanobis distances, the share ``keep`` of a group; after ``trials`` steps the start with the least determinant
goes on alone until no group's determinant falls any more. A row is judged by its language's and source's estimate,
drawn towards the language's, that towards the one of all rows, and that towards a wide prior (``PRIOR``), each as if
what it is drawn to stood for ``weight`` rows: one formula for groups of every size. A row whose distance is beyond
``cutoff`` is rejected.

Every step is a grouped aggregate over the written statistics; the distance comes from a Cholesky factor, inverted,
written out as expressions. Quantiles are counts by bins that are merged, written and only then put in order, so that
no group's rows meet in a task and the result does not depend on an order. The last bin counts in part, so that the
nearest rows weigh exactly the share ``keep``. Variances have a floor (``FLOORS``), so a statistic that hardly varies
rejects nothing by itself.

Edge cases: a null or empty text has no words and fails the base rules; null languages and sources are groups of
their own; repeated rows count as often as they stand; an empty table gives no rows; other columns are ignored by
``judge`` and kept by ``keep_good``; columns with clashing names are left as they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyloom.session import materialise, unused

#: Standard deviations added to each statistic, in the order of ``vector``.
FLOORS = (0.5, 0.15, 0.05, 0.15, 0.15, 0.10, 0.10)
#: Squared distance beyond which a row is rejected.
CUTOFF = 30.0
#: Share of rows that an estimate is made of, and what makes its covariance that of a whole normal group.
KEEP, CONSISTENCY = 0.75, 1.33
#: Concentration steps of every start, and at most of the best.
TRIALS, STEPS = 2, 15
#: Bins of a distance for each doubling; bins of a statistic for each unit.
BINS, UNIT_BINS = 64, 512
#: What an estimate is drawn to counts as so many rows.
WEIGHT = 100.0
#: (mean, standard deviation) of each statistic that stand for texts of any kind.
PRIOR = ((5.0, 2.0), (1.7, 0.5), (0.0, 0.3), (0.1, 0.4), (0.2, 0.4), (0.2, 0.25), (0.15, 0.25))

SPACE = r"[\x20\x09-\x0D]+"
WIDTH = 5


def _all(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, columns)


def text_statistics(docs: DataFrame, text: str = "text", prefix: str = "__q_") -> DataFrame:
    """``docs`` with columns ``words, word_chars, symbols, dup_lines, repeat_words, lines, upper, marks`` (prefixed)."""
    p = prefix
    t = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumn(f"{p}w", F.filter(F.split(t, SPACE), lambda w: w != ""))
    df = df.withColumn(f"{p}h", F.transform(f"{p}w", lambda w: F.xxhash64(w)))
    windows = f"""if(size({p}h) < {WIDTH}, cast(array() as array<bigint>),
        transform(sequence(0, size({p}h) - {WIDTH}), i -> xxhash64({", ".join(f"{p}h[i + {k}]" for k in range(WIDTH))})))"""
    df = df.withColumn(f"{p}g", F.expr(windows))
    # the windows found twice or more, as positions in order; only looked for where some window repeats
    df = df.withColumn(f"{p}s", F.expr(f"if(size(array_distinct({p}g)) = size({p}g), null, sort_array(transform({p}g, (x, i) -> struct(x, i))))"))
    again = f"""sort_array(filter(transform({p}s, (x, k) -> if((k > 0 and {p}s[k - 1].x = x.x) or (k + 1 < size({p}s) and {p}s[k + 1].x = x.x), x.i, -1)), i -> i >= 0))"""
    df = df.withColumn(f"{p}a", F.expr(f"if({p}s is null, cast(array() as array<int>), {again})"))
    covered = f"""aggregate({p}a, named_struct('n', 0L, 'end', 0),
        (c, i) -> named_struct('n', c.n + i + {WIDTH} - greatest(i, c.end), 'end', i + {WIDTH})).n"""
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, " \t\n\x0b\x0c\r", "")) > 0)
    df = df.withColumn(f"{p}l", lines)
    size = lambda chars: (F.length(t) - F.length(F.regexp_replace(t, chars, ""))).cast("long")
    return df.select(
        *docs.columns,
        F.size(f"{p}w").cast("long").alias(f"{p}words"),
        F.length(F.regexp_replace(t, SPACE, "")).cast("long").alias(f"{p}word_chars"),
        (F.length(t) - F.length(F.translate(t, "#*$%&|<>", ""))).cast("long").alias(f"{p}symbols"),
        (F.size(f"{p}l") - F.size(F.array_distinct(f"{p}l"))).cast("long").alias(f"{p}dup_lines"),
        F.expr(covered).alias(f"{p}repeat_words"),
        F.size(f"{p}l").cast("long").alias(f"{p}lines"),
        size(r"\p{Lu}").alias(f"{p}upper"),
        size(r"[!-/:-@\[-`{-~]").alias(f"{p}marks"),
    )


def vector(prefix: str = "__q_") -> list[Column]:
    """Transformed statistics: logarithms of sizes, square roots of shares."""
    c = lambda name: F.col(prefix + name).cast("double")
    share = lambda x, of: F.sqrt(F.least(F.lit(1.0), c(x) / (c(of) + 1)))
    return [
        F.log1p(c("words")),
        F.log((c("word_chars") + 1) / (c("words") + 1)),
        share("symbols", "word_chars"),
        share("dup_lines", "lines"),
        share("repeat_words", "words"),
        share("upper", "word_chars"),
        share("marks", "word_chars"),
    ]


def base_failed(prefix: str = "__q_") -> Column:
    words, repeat = F.col(f"{prefix}words"), F.col(f"{prefix}repeat_words")
    return (words < 10) | (100 * repeat > 20 * words)


def _factor(p: int) -> list[tuple[str, Column]]:
    """Lower Cholesky factor l of the covariance columns c_i_j and its inverse k, as columns made one after the other."""
    out = []
    for j in range(p):
        s = F.col(f"c_{j}_{j}")
        for k in range(j):
            s = s - F.col(f"l_{j}_{k}") * F.col(f"l_{j}_{k}")
        out.append((f"l_{j}_{j}", F.sqrt(F.greatest(s, F.lit(1e-9)))))
        for i in range(j + 1, p):
            s = F.col(f"c_{i}_{j}")
            for k in range(j):
                s = s - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            out.append((f"l_{i}_{j}", s / F.col(f"l_{j}_{j}")))
    for i in range(p):
        out.append((f"k_{i}_{i}", 1 / F.col(f"l_{i}_{i}")))
        for j in range(i):
            s = sum((F.col(f"l_{i}_{k}") * F.col(f"k_{k}_{j}") for k in range(j, i)), F.lit(0.0))
            out.append((f"k_{i}_{j}", -s / F.col(f"l_{i}_{i}")))
    return out


def _with_factor(groups: DataFrame, p: int) -> DataFrame:
    """``groups`` with the inverse factor k_i_j and the log-determinant ``logdet`` of its covariance c_i_j."""
    kept = groups.columns
    for name, column in _factor(p):
        groups = groups.withColumn(name, column)
    logdet = 2 * sum((F.log(F.col(f"l_{i}_{i}")) for i in range(p)), F.lit(0.0))
    return groups.select(*kept, *(f"k_{i}_{j}" for i in range(p) for j in range(i + 1)), logdet.alias("logdet"))


def _distance(p: int, x: str = "x_", e: str = "") -> Column:
    """Squared Mahalanobis distance of the columns x_i, given the group's means m_i and inverse factor k_i_j."""
    away = [F.col(f"{x}{i}") - F.col(f"{e}m_{i}") for i in range(p)]
    rows = (sum((F.col(f"{e}k_{i}_{j}") * away[j] for j in range(i + 1)), F.lit(0.0)) for i in range(p))
    return sum((F.pow(r, 2) for r in rows), F.lit(0.0))


def _small(groups: DataFrame, label: str) -> DataFrame:
    """A row for each group (and start), written as one file: it is read as the small table it is, and joined as one."""
    return materialise(groups.repartition(1), label)


def _quartiles(rows: DataFrame, keys: list[str], p: int, floors: tuple[float, ...]) -> DataFrame:
    """(keys, m_i, s_i): medians and floored deviations from quartiles, to a bin of 1 / UNIT_BINS."""
    bins = F.array(*(F.floor(F.col(f"x_{i}") * UNIT_BINS).cast("int") for i in range(p)))
    counts = rows.select(*keys, F.posexplode(bins).alias("i", "bin")).groupBy(*keys, "i", "bin").agg(F.count("*").alias("n"))
    counts = materialise(counts, "quality-bins")
    each = Window.partitionBy(*keys, "i")
    upto = each.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.select(*keys, "i", "bin", F.sum("n").over(upto).alias("upto"), F.sum("n").over(each).alias("all"))
    at = [F.min(F.when(F.col("upto") >= q * F.col("all"), (F.col("bin") + 0.5) / UNIT_BINS)) for q in (0.25, 0.5, 0.75)]
    found = counts.groupBy(*keys, "i").agg(at[1].alias("m"), (at[2] - at[0]).alias("q"))
    pick = lambda name, i: F.max(F.when(F.col("i") == i, F.col(name)))
    return found.groupBy(*keys).agg(
        *(pick("m", i).alias(f"m_{i}") for i in range(p)),
        *(F.sqrt(F.pow(pick("q", i) / 1.349, 2) + floors[i] ** 2 + 1e-12).alias(f"s_{i}") for i in range(p)),
    )


def _starts(rows: DataFrame, keys: list[str], p: int, floors: tuple[float, ...]) -> DataFrame:
    """(keys, start, m_i, c_i_j): the quartiles' scales with no correlations (0), those of squashed values (1), of directions (2)."""
    scales = _small(_quartiles(rows, keys, p, floors), "quality-quartiles")
    z = [(F.col(f"x_{i}") - F.col(f"m_{i}")) / F.col(f"s_{i}") for i in range(p)]
    length = F.sqrt(sum((F.pow(c, 2) for c in z), F.lit(1e-12)))
    rows = rows.join(scales, keys).select(*keys, *(F.tanh(c).alias(f"t_{i}") for i, c in enumerate(z)), *((c / length).alias(f"u_{i}") for i, c in enumerate(z)))
    sums = [F.avg(F.col(f"{a}_{i}") * F.col(f"{a}_{j}")).alias(f"{a}_{i}_{j}") for a in "tu" for i in range(p) for j in range(i + 1)]
    made = rows.groupBy(*keys).agg(*sums).join(scales, keys)

    def start(k: int, a: str) -> Column:
        size = lambda i: F.sqrt(F.col(f"{a}_{i}_{i}") + 1e-9)
        cells = []
        for i in range(p):
            for j in range(i + 1):
                r = F.lit(1.0 if i == j else 0.0) if not a or i == j else F.col(f"{a}_{i}_{j}") / (size(i) * size(j))
                cells.append((F.col(f"s_{i}") * F.col(f"s_{j}") * r).alias(f"c_{i}_{j}"))
        return F.struct(F.lit(k).alias("start"), *cells)

    made = made.select(*keys, *(f"m_{i}" for i in range(p)), F.explode(F.array(start(0, ""), start(1, "t"), start(2, "u"))).alias("x"))
    return made.select(*keys, "x.start", *(f"m_{i}" for i in range(p)), *(f"x.c_{i}_{j}" for i in range(p) for j in range(i + 1)))


def _concentrated(rows: DataFrame, found: DataFrame, keys: list[str], p: int, floors: tuple[float, ...], keep: float, consistency: float) -> DataFrame:
    """One step: (keys, start, n, m_i, c_i_j, k_i_j, logdet) of the share ``keep`` of rows nearest to ``found``."""
    by, x = [*keys, "start"], [f"x_{i}" for i in range(p)]
    factors = found.select(*by, *(f"m_{i}" for i in range(p)), *(f"k_{i}_{j}" for i in range(p) for j in range(i + 1)))
    far = rows.join(factors, keys).select(*by, *x, F.floor(F.log2(_distance(p) + 1e-6) * BINS).cast("int").alias("bin"))
    counts = materialise(far.groupBy(*by, "bin").agg(F.count("*").alias("n")), "quality-bins")
    each = Window.partitionBy(*by)
    upto = each.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.select(*by, "bin", "n", F.sum("n").over(upto).alias("upto"), F.sum("n").over(each).alias("all"))
    share = (keep * F.col("all") - (F.col("upto") - F.col("n"))) / F.col("n")  # of the bin with which `keep` is reached
    limits = counts.where(F.col("upto") >= keep * F.col("all")).groupBy(*by).agg(F.min("bin").alias("limit"), F.min_by(share, "bin").alias("share"), F.max("all").alias("n"))
    # a row for each group and start: written, it is known to be small and the rows stay where they are
    near = far.join(_small(limits, "quality-limits"), by).where("bin <= limit")
    w = F.when(F.col("bin") < F.col("limit"), 1.0).otherwise(F.col("share"))
    sums = [F.sum(w).alias("w"), F.first("n").alias("n")]
    sums += [F.sum(w * F.col(c)).alias(f"a_{i}") for i, c in enumerate(x)]
    sums += [F.sum(w * F.col(x[i]) * F.col(x[j])).alias(f"s_{i}_{j}") for i in range(p) for j in range(i + 1)]
    made = near.groupBy(*by).agg(*sums).select(
        *by, "n", *((F.col(f"a_{i}") / F.col("w")).alias(f"m_{i}") for i in range(p)), *((F.col(f"s_{i}_{j}") / F.col("w")).alias(f"s_{i}_{j}") for i in range(p) for j in range(i + 1))
    )
    cov = [
        (consistency * (F.col(f"s_{i}_{j}") - F.col(f"m_{i}") * F.col(f"m_{j}")) + (floors[i] ** 2 if i == j else 0.0)).alias(f"c_{i}_{j}")
        for i in range(p)
        for j in range(i + 1)
    ]
    return _small(_with_factor(made.select(*by, "n", *(f"m_{i}" for i in range(p)), *cov), p), "quality-step")


def robust_estimates(
    rows: DataFrame, p: int, floors: tuple[float, ...], *, keys: list[str], keep: float = KEEP, consistency: float = CONSISTENCY, trials: int = TRIALS, steps: int = STEPS
) -> DataFrame:
    """Minimum-covariance-determinant estimates of ``rows(keys, x_0 ..)``: keys, n, means m_i, covariances c_i_j, k_i_j, logdet.

    ``rows`` is read in every step and must come from a written table; each step's estimates, a row for each group
    and start, are written too. The driver reads one number after each step.
    """
    found = _small(_with_factor(_starts(rows, keys, p, floors), p), "quality-start")
    for _ in range(trials):
        found = _concentrated(rows, found, keys, p, floors, keep, consistency)
    best = F.row_number().over(Window.partitionBy(*keys).orderBy("logdet", "start"))
    found = _small(found.withColumn("__best", best).where("__best = 1").drop("__best"), "quality-best")
    for _ in range(steps):
        ahead = _concentrated(rows, found, keys, p, floors, keep, consistency)
        before = found.select(*keys, F.col("logdet").alias("before"))
        fell = ahead.join(before, keys).agg(F.max(F.abs(F.col("logdet") - F.col("before")))).first()[0]
        found = ahead
        if fell is None or fell < 1e-4:
            break
    return found.drop("start")


def _drawn(stats: DataFrame, found: DataFrame, p: int, weight: float) -> DataFrame:
    """(lang, source, m_i, k_i_j): each estimate drawn to its language's, to that of all rows and to the prior."""
    groups = stats.select("lang", "source").distinct()
    cells = [(i, j) for i in range(p) for j in range(i + 1)]
    m, c = [F.lit(mean) for mean, _ in PRIOR[:p]], [F.lit(PRIOR[i][1] ** 2 if i == j else 0.0) for i, j in cells]
    for k, (lang, source) in enumerate(((F.lit("*"), F.lit("*")), (_name("lang"), F.lit("*")), (_name("lang"), _name("source")))):
        level = found.select("g_lang", "g_source", F.struct("n", *(f"m_{i}" for i in range(p)), *(f"c_{i}_{j}" for i, j in cells)).alias(f"e{k}"))
        groups = groups.join(level, (F.col("g_lang") == lang) & (F.col("g_source") == source), "left").drop("g_lang", "g_source")
        a = F.coalesce(F.col(f"e{k}.n") / (F.col(f"e{k}.n") + weight), F.lit(0.0))
        mix = lambda own, above, a=a: a * F.coalesce(own, above) + (1 - a) * above
        m = [mix(F.col(f"e{k}.m_{i}"), above) for i, above in enumerate(m)]
        c = [mix(F.col(f"e{k}.c_{i}_{j}"), above) for (i, j), above in zip(cells, c, strict=True)]
        names = [f"m{k}_{i}" for i in range(p)] + [f"c{k}_{i}_{j}" for i, j in cells]
        groups = groups.withColumns(dict(zip(names, [*m, *c], strict=True)))
        m, c = [F.col(n) for n in names[:p]], [F.col(n) for n in names[p:]]
    made = groups.select("lang", "source", *(x.alias(f"m_{i}") for i, x in enumerate(m)), *(x.alias(f"c_{i}_{j}") for (i, j), x in zip(cells, c, strict=True)))
    return _with_factor(made, p).drop("logdet", *(f"c_{i}_{j}" for i, j in cells))


def _name(c: str) -> Column:
    """A group's name of a value that may be null; none is that of a pool, ``*``."""
    return F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-"))


def _measured(docs: DataFrame, prefix: str) -> DataFrame:
    """``docs`` with the statistics and, as ``<prefix>x_i``, their vector."""
    stats = text_statistics(docs, prefix=prefix)
    return stats.select("*", *(c.alias(f"{prefix}x_{i}") for i, c in enumerate(vector(prefix))))


def estimates(measured: DataFrame, prefix: str = "__q_", *, floors: tuple[float, ...] = FLOORS, weight: float = WEIGHT, **options) -> DataFrame:
    """(lang, source, m_i, k_i_j) for each language and source in the written table ``measured``."""
    p = len(FLOORS)
    stats = measured.select(F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), (~base_failed(prefix)).alias("good"), *(F.col(f"{prefix}x_{i}").alias(f"x_{i}") for i in range(p)))
    group = lambda a, b: F.struct(a.alias("g_lang"), b.alias("g_source"))
    levels = F.array(group(F.lit("*"), F.lit("*")), group(_name("lang"), F.lit("*")), group(_name("lang"), _name("source")))
    rows = stats.where("good").select(F.explode(levels).alias("g"), *(f"x_{i}" for i in range(p))).select("g.*", *(f"x_{i}" for i in range(p)))
    found = robust_estimates(rows, p, floors, keys=["g_lang", "g_source"], **options)
    return _small(_drawn(stats, found, p, weight), "quality-estimates")


def _judged(rows: DataFrame, found: DataFrame, prefix: str, cutoff: float) -> DataFrame:
    """``rows`` (measured) with ``<prefix>d2`` and ``<prefix>kept``."""
    of = F.struct(F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))
    named = found.select(F.struct("lang", "source").alias(f"{prefix}of"), F.struct(*(c for c in found.columns if c not in ("lang", "source"))).alias(f"{prefix}e"))
    rows = rows.withColumn(f"{prefix}key", of)
    same = F.col(f"{prefix}key.lang").eqNullSafe(F.col(f"{prefix}of.lang")) & F.col(f"{prefix}key.source").eqNullSafe(F.col(f"{prefix}of.source"))
    d2 = _distance(len(FLOORS), f"{prefix}x_", f"{prefix}e.")
    rows = rows.join(named, same, "left").withColumn(f"{prefix}d2", d2)
    return rows.withColumn(f"{prefix}kept", ~base_failed(prefix) & ~F.coalesce(F.col(f"{prefix}d2") > cutoff, F.lit(False)))


def judge(docs: DataFrame, *, cutoff: float = CUTOFF, **options) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance2) of every row."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", "text")
    rows = materialise(_measured(own, "__q_").drop("text"), "quality-statistics")
    rows = _judged(rows, estimates(rows, **options), "__q_", cutoff)
    return rows.select(
        "doc_id",
        F.col("__q_words").alias("n_words"),
        F.col("__q_word_chars").alias("word_chars"),
        F.col("__q_symbols").alias("n_symbols"),
        F.col("__q_dup_lines").alias("n_dup_lines"),
        F.col("__q_repeat_words").alias("n_repeat_words"),
        base_failed().alias("base_failed"),
        F.col("__q_kept").alias("kept"),
        F.col("__q_d2").alias("distance2"),
    )


def keep_good(docs: DataFrame, *, cutoff: float = CUTOFF, **options) -> DataFrame:
    """``docs``, with all its columns, without the rows that ``judge`` rejects.

    The rows are written once with their statistics; the estimates read the statistics alone.
    """
    prefix = unused(docs, "__q_")
    rows = materialise(_measured(docs, prefix), "quality-rows")
    return _judged(rows, estimates(rows, prefix, **options), prefix, cutoff).where(f"{prefix}kept").select(*docs.columns)


def op3_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Verdicts on all documents."""
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def stage_quality(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, with all their columns.

    Null and empty texts go, as they fail the base rules; repeated rows are judged alike; an empty table stays empty.
    """
    return keep_good(docs)
