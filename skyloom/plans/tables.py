"""Views of the driver's tables as the engine's domain tables; the stand-ins have no physical meaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that the order of summation doesn't show."""
    return df.select(*(F.round(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes))


def halves_up(x: Column, digits: int) -> Column:
    """``x`` rounded as DuckDB does, by what its product with a power of ten is nearest; Spark's ``round`` goes by the shortest
    decimals of ``x``, which may be just below a half that the product is."""
    return F.round(x * 10.0**digits, 0) / 10.0**digits


def spread(df: DataFrame, arrays: dict[str, int], digits: int = 4) -> DataFrame:
    """Arrays of numbers as rounded columns, ``name_0`` on; no negative zero."""
    rest = [c for c in df.columns if c not in arrays]
    return df.select(*rest, *((F.round(F.col(c)[k], digits) + 0.0).alias(f"{c}_{k}") for c, n in arrays.items() for k in range(n)))


def spread_sql(name: str, values: list[float]) -> str:
    return ", ".join(f"{float(v)!r}::double as {name}_{k}" for k, v in enumerate(values))


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as telemetry: track, t in seconds since 2024-01-01, channel, value, and made-up coordinates."""
    e = table(spark, sf_dir, "events")
    us = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01 00:00:00', ts)")
    return e.select(
        "event_id",
        F.col("user_id").alias("track"),
        us.alias("us"),
        (us / 1000000).alias("t"),
        F.col("event_type").alias("channel"),
        "value",
        (28.0 + (F.col("value") - 245) / 100000).alias("lat"),
        (77.0 + F.pmod(F.col("event_id") * 37, F.lit(1000)) / 50000).alias("lon"),
        F.pmod(F.col("value") * 7, F.lit(360)).alias("yaw"),
        "props",
    )


TELEMETRY_SQL = """(select event_id, user_id as track, epoch_us(ts) - epoch_us(timestamp '2024-01-01') as us,
  (epoch_us(ts) - epoch_us(timestamp '2024-01-01')) / 1e6 as t, event_type as channel, value,
  28.0e0 + (value - 245) / 100000 as lat, 77.0e0 + ((event_id * 37) % 1000) / 50000e0 as lon, (value * 7) % 360 as yaw, props from events)"""


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as a large point cloud: x, y, z, view (camera), voxel, class and source."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("point_id"),
        F.col("l_quantity").alias("x"),
        (F.col("l_discount") * 100).alias("y"),
        (F.col("l_extendedprice") / 1000).alias("z"),
        F.col("l_suppkey").alias("view"),
        F.col("l_partkey").alias("voxel"),
        F.col("l_returnflag").alias("class"),
        F.col("l_linestatus").alias("source"),
        F.col("l_tax").alias("weight"),
    )


POINTS_SQL = """(select l_orderkey * 8 + l_linenumber as point_id, l_quantity as x, l_discount * 100 as y, l_extendedprice / 1000 as z,
  l_suppkey as view, l_partkey as voxel, l_returnflag as class, l_linestatus as source, l_tax as weight from lineitem)"""


def small_cloud(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as a small point cloud."""
    at = lambda k: F.col("embedding")[k].cast("double")
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("point_id"), at(0).alias("x"), at(1).alias("y"), at(2).alias("z"), F.col("label").alias("zone"))


SMALL_CLOUD_SQL = """(select vec_id as point_id, cast(embedding[1] as double) as x, cast(embedding[2] as double) as y,
  cast(embedding[3] as double) as z, label as zone from embeddings)"""


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as a frame series of each customer: index, sharpness, overlap, status."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("video"),
        F.col("o_orderkey").alias("frame"),
        F.col("o_totalprice").alias("sharpness"),
        (F.pmod(F.col("o_totalprice"), F.lit(1000)) / 1000).alias("overlap"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").alias("taken"),
    )


FRAMES_SQL = """(select o_custkey as video, o_orderkey as frame, o_totalprice as sharpness, (o_totalprice % 1000) / 1000 as overlap,
  o_orderstatus as status, o_orderpriority as priority, o_orderdate as taken from orders)"""
