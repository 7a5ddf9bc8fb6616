"""Staged runs that resume (inventory G1 to G3, F19, U7, J32, A76).

A stage is a function of DataFrames whose result is written as Parquet; the manifest, a small table beside the
results, holds each stage's status and the fingerprint of the settings it depends on. A stage is used again if it
is done, its fingerprint is the same and its result is there; else it and all after it are computed anew.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

MANIFEST = "seq long, stage string, status string, fingerprint string, started double, seconds double, rows long, error string"


def deep_merge(base: dict, over: dict) -> dict:
    """Maps merged key by key, lists and values replaced."""
    return base | {k: deep_merge(base[k], v) if isinstance(base.get(k), dict) and isinstance(v, dict) else v for k, v in over.items()}


def get_path(config: dict, path: str, *default):
    """P25: a dotted path; raises KeyError where it is missing and no default is given."""
    for part in path.split("."):
        if not isinstance(config, dict) or part not in config:
            if default:
                return default[0]
            raise KeyError(path)
        config = config[part]
    return config


def parse_override(text: str) -> tuple[str, object]:
    """``a.b=value`` with the value typed as JSON where it is JSON."""
    path, mark, raw = text.partition("=")
    if not mark or not path.strip():
        raise ValueError(f"expected key.path=value, got {text!r}")
    try:
        return path.strip(), json.loads(raw)
    except ValueError:
        return path.strip(), raw


def settings_fingerprint(config: dict, paths: list[str]) -> str:
    """first 16 hex digits of the SHA-256 of the settings a stage depends on."""
    held = {p: get_path(config, p, None) for p in paths}
    return hashlib.sha256(json.dumps(held, sort_keys=True, separators=(",", ":")).encode()).hexdigest()[:16]


@dataclass(frozen=True)
class Stage:
    """``run(spark, inputs by stage name, config) -> DataFrame``; ``settings`` are the dotted paths it depends on."""

    name: str
    run: Callable[[SparkSession, dict[str, DataFrame], dict], DataFrame]
    settings: tuple[str, ...] = ()


class StagedRun:
    """Stages in order over a folder that any Spark file system reads."""

    def __init__(self, spark: SparkSession, folder: str, stages: list[Stage], config: dict) -> None:
        self.spark, self.folder, self.stages, self.config = spark, folder.rstrip("/"), stages, config

    def manifest(self) -> DataFrame:
        """The last row of each stage."""
        try:
            rows = self.spark.read.schema(MANIFEST).json(f"{self.folder}/manifest")
        except AnalysisException:
            rows = self.spark.createDataFrame([], MANIFEST)
        last = rows.groupBy("stage").agg(F.max_by(F.struct("*"), "seq").alias("r"))
        return last.select("r.*")

    def _put(self, stage: str, status: str, fingerprint: str, started: float, rows: int | None = None, error: str | None = None) -> None:
        row = (time.time_ns(), stage, status, fingerprint, started, time.time() - started, rows, error)
        self.spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").json(f"{self.folder}/manifest")

    def _result(self, stage: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.folder}/{stage}")
        except AnalysisException:
            return None

    def run(self, force: str | None = None) -> dict[str, DataFrame]:
        """Results by stage; from ``force`` on, or from the first stage that can't be used again, all are computed."""
        known = {r.stage: r for r in self.manifest().collect()}
        done: dict[str, DataFrame] = {}
        anew = False
        for stage in self.stages:
            mark = settings_fingerprint(self.config, list(stage.settings))
            row, held = known.get(stage.name), self._result(stage.name)
            anew = anew or stage.name == force or held is None or row is None or row.status != "done" or row.fingerprint != mark
            if anew:
                began = time.time()
                self._put(stage.name, "running", mark, began)
                try:
                    stage.run(self.spark, dict(done), self.config).write.mode("overwrite").parquet(f"{self.folder}/{stage.name}")
                except Exception as e:
                    self._put(stage.name, "failed", mark, began, error=f"{type(e).__name__}: {e}"[:500])
                    raise
                held = self._result(stage.name)
                self._put(stage.name, "done", mark, began, rows=held.count())
            done[stage.name] = held
        return done
