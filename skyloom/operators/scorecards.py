"""Scorecards: KPI rows from measured columns by declared rules (inventory A25 to A28, A56 to A74, P26 to P28).

A scorecard is a list of rules; each makes one KPI row for each measured row, in one ``inline`` over an array of structs,
so a card costs one pass however many KPIs it has.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.scalar import band_status, lower_better


@dataclass(frozen=True)
class Rule:
    """A KPI: its value, how it is judged, its unit and the score that a failure caps at."""

    key: str
    grp: str
    value: Column
    status: Column
    target: str = ""
    unit: str = ""
    cap: float | None = None
    when: Column | None = None


def at_most(key: str, grp: str, value: Column, good: float, ok: float, unit: str = "", cap: float | None = None) -> Rule:
    return Rule(key, grp, value, lower_better(value, good, ok), f"<= {good:g}", unit, cap)


def at_least(key: str, grp: str, value: Column, good: float, ok: float, unit: str = "", cap: float | None = None) -> Rule:
    status = F.when(value.isNull(), "info").when(value >= good, "pass").when(value >= ok, "warn").otherwise("fail")
    return Rule(key, grp, value, status, f">= {good:g}", unit, cap)


def within(key: str, grp: str, value: Column, lo: float, hi: float, slack: float, unit: str = "", cap: float | None = None) -> Rule:
    return Rule(key, grp, value, band_status(value, lo, hi, slack), f"{lo:g} to {hi:g}", unit, cap)


def info(key: str, grp: str, value: Column, unit: str = "") -> Rule:
    return Rule(key, grp, value, F.lit("info"), "", unit)


def scorecard(df: DataFrame, keys: list[str], rules: list[Rule]) -> DataFrame:
    """(keys, key, grp, value, status, target, unit, cap): one row for each rule whose condition, where it has one, holds."""
    held = lambda r, row: row if r.when is None else F.when(r.when, row)
    rows = [
        held(r, F.struct(
            F.lit(r.key).alias("key"), F.lit(r.grp).alias("grp"), r.value.cast("double").alias("value"), r.status.alias("status"),
            F.lit(r.target).alias("target"), F.lit(r.unit).alias("unit"), F.lit(r.cap).cast("double").alias("cap"),
        ))
        for r in rules
    ]
    return df.select(*keys, F.inline(F.array_compact(F.array(*rows))))


#: Cards by stage; each takes the measured columns it names.
CARDS = {
    "ingest": lambda: [
        at_least("overlap_median", "overlap", F.col("overlap_median"), 0.65, 0.5),
        at_most("blur_rejected", "blur", F.col("blur_rejected"), 0.1, 0.25),
        within("frames_kept", "selection", F.col("frames_kept"), 5, 40, 10),
        info("duration", "run", F.col("duration"), "s"),
    ],
    "condition": lambda: [
        at_most("gps_outliers", "gps", F.col("gps_outliers"), 0.02, 0.1, cap=70.0),
        at_least("survival", "gps", F.col("survival"), 0.9, 0.75),
        at_most("clamp_fraction", "illumination", F.col("clamp_fraction"), 0.05, 0.2),
    ],
}


def missing_inputs(registry: DataFrame, found: DataFrame, name: str = "name") -> DataFrame:
    """Each optional input with its status: present, absent or unknown (null where nothing was recorded)."""
    held = found.select(name, F.col("present").alias("__p"), F.lit(True).alias("__seen"))
    status = F.when(F.col("__seen").isNull(), "unknown").when(F.col("__p"), "present").otherwise("absent")
    return registry.join(held, name, "left").withColumn("status", status).drop("__p", "__seen")


def limitations(rules: dict[str, Column]) -> Column:
    """The sentences whose conditions hold, in order."""
    return F.array_compact(F.array(*(F.when(cond, F.lit(text)) for text, cond in rules.items())))
