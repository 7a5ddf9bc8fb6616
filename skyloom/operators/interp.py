"""Interpolating as-of joins and gap filling (inventory J2 to J7, J26, J33).

Both sides are put on one time line; window functions carry the nearest measured rows before and after each
target, so one shuffle by track serves any number of columns and no range join is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _neighbours(name: str, time: str, keys: list[str]) -> tuple[Column, Column]:
    """The measured (time, value) structs of a column at or before and at or after each row."""
    order = Window.partitionBy(*keys).orderBy(time, "__target")
    back = Window.partitionBy(*keys).orderBy(F.col(time).desc(), "__target")
    held = F.when(F.col(name).isNotNull() & ~F.col("__target"), F.struct(F.col(time).alias("t"), F.col(name).alias("v")))
    upto = lambda w: w.rowsBetween(Window.unboundedPreceding, 0)
    return F.last(held, True).over(upto(order)), F.last(held, True).over(upto(back))


def _blend(a: Column, b: Column, time: Column, va: Column, vb: Column) -> Column:
    share = (time - a["t"]) / (b["t"] - a["t"])
    return F.when(a["t"] == b["t"], va).otherwise(va + (vb - va) * share)


def at_times(source: DataFrame, targets: DataFrame, keys: list[str], time: str, linear: list[str], angles: list[str] = (), *, clamp: bool = False, lone_fills: bool = True) -> DataFrame:
    """Values of ``source`` at the times of ``targets(keys, time)``.

    Linear between the nearest measured values of each column; angles on the unit circle, in 0 to 360. Outside
    the measured range a value is null, or with ``clamp`` the nearest one; a column with one value in all fills
    its track (``lone_fills``). ``interpolated`` tells targets at which nothing was measured.
    """
    columns = [*linear, *angles]
    rows = source.select(*keys, F.col(time).cast("double").alias(time), *columns, F.lit(False).alias("__target"))
    asked = targets.select(*keys, F.col(time).cast("double").alias(time)).distinct()
    rows = rows.unionByName(asked.withColumn("__target", F.lit(True)), allowMissingColumns=True)
    track = Window.partitionBy(*keys)
    t = F.col(time)
    made = []
    for c in columns:
        a, b = _neighbours(c, time, keys)
        rows = rows.withColumn(f"__a_{c}", a).withColumn(f"__b_{c}", b)
        count = F.count(F.when(~F.col("__target"), F.col(c))).over(track)
        lone = F.first(F.when(~F.col("__target"), F.col(c)), True).over(track.orderBy(time).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        rows = rows.withColumn(f"__lone_{c}", F.when(count == 1, lone) if lone_fills else F.lit(None).cast("double"))
        a, b = F.col(f"__a_{c}"), F.col(f"__b_{c}")
        if c in angles:
            ra, rb = F.radians(a["v"]), F.radians(b["v"])
            mixed = F.pmod(F.degrees(F.atan2(_blend(a, b, t, F.sin(ra), F.sin(rb)), _blend(a, b, t, F.cos(ra), F.cos(rb)))), F.lit(360.0))
        else:
            mixed = _blend(a, b, t, a["v"].cast("double"), b["v"].cast("double"))
        edges = F.coalesce(a["v"], b["v"]).cast("double") if clamp else F.lit(None).cast("double")
        made.append(F.coalesce(F.when(a.isNotNull() & b.isNotNull(), mixed), edges, F.col(f"__lone_{c}")).alias(c))
    first = columns[0]
    measured = F.coalesce(F.col(f"__a_{first}")["t"] == t, F.lit(False))
    return rows.where("__target").select(*keys, time, *made, (~measured).alias("interpolated"))


def fill_gaps(primary: DataFrame, secondary: DataFrame, keys: list[str], time: str, linear: list[str], angles: list[str] = ()) -> DataFrame:
    """``primary`` wins; its nulls are filled with ``secondary`` at the same times."""
    other = at_times(secondary, primary, keys, time, linear, angles).drop("interpolated")
    named = other.withColumnsRenamed({c: f"__{c}" for c in [*linear, *angles]})
    joined = primary.withColumn(time, F.col(time).cast("double")).join(named, [*keys, time], "left")
    keep = [c for c in primary.columns if c not in [*keys, time, *linear, *angles]]
    return joined.select(*keys, time, *keep, *(F.coalesce(c, f"__{c}").alias(c) for c in [*linear, *angles]))


def central_speed(source: DataFrame, targets: DataFrame, keys: list[str], time: str, value: str, half: float) -> DataFrame:
    """Change of a value between ``half`` after and ``half`` before each target, by time."""
    t = F.col(time).cast("double")
    both = targets.select(*keys, F.explode(F.array(t - half, t + half)).alias(time))
    at = at_times(source, both, keys, time, [value])
    # times are joined in whole microseconds: sums of doubles need not come back to the same number
    shifted = lambda by, name: at.select(*keys, F.round((F.col(time) + by) * 1000000).cast("long").alias("__us"), F.col(value).alias(name))
    joined = shifted(half, "__before").join(shifted(-half, "__after"), [*keys, "__us"])
    return joined.select(*keys, (F.col("__us") / 1000000).alias(time), ((F.col("__after") - F.col("__before")) / (2 * half)).alias("speed"))
