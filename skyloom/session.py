"""Session and storage helpers shared by the library."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", shuffle_partitions: int = 8, name: str = "skyloom") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors share: ``spark.checkpoint.dir``.

    Only a session on one machine that leaves the setting empty gets a folder of its own.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(own)
    return own


_TABLE = "table:"
_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def new_folder(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no one else uses; ``scratch`` knows of it."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if (made := _MADE.get()) is not None:
        made.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Removes, at its end, what ``materialise`` and ``bucketed`` wrote within; paths taken off the list stay.

    For use around work whose result is written, as a frame that is still to be computed needs its tables.
    """
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(token)
        for path in made:
            if path.startswith(_TABLE):
                spark.sql(f"drop table if exists {path.removeprefix(_TABLE)}")
                continue
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet into the shared folder and read it back."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, column: str, parts: int, label: str, **options: str) -> DataFrame:
    """``df`` written in the shared folder in ``parts`` buckets by ``column``, so that later joins by it leave it in place.

    Buckets need an entry in the session's catalogue; ``scratch`` drops it with the files.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    name = path.rpartition("/")[2].replace("-", "_")
    df.write.format("parquet").option("path", path).options(compression="zstd", **options).bucketBy(parts, column).saveAsTable(name)
    if (made := _MADE.get()) is not None:
        made.append(_TABLE + name)
    return spark.table(name)


def settled(spark: SparkSession, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """What ``build()`` returns, written; all that it wrote on its way is removed."""
    with scratch(spark) as made:
        done = materialise(build(), label)
        path = made.pop()
    if (outer := _MADE.get()) is not None:
        outer.append(path)
    return done


def parts(df: DataFrame, rows: int = 1_000_000) -> int:
    """Partitions that hold about ``rows`` rows of ``df`` each, so that a task's memory doesn't grow with the input; no fewer than the session's."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // rows))


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column begins so, case aside."""
    while any(c.lower().startswith(name.lower()) for c in df.columns):
        name = f"_{name}"
    return name
