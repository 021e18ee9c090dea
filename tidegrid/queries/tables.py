"""The standard tables, with the columns that queries use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(ts: str) -> Column:
    """Microseconds since 1970 of a timestamp without zone, whatever the session's zone."""
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast({ts} AS timestamp_ntz))")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``t`` in microseconds."""
    return table(spark, sf_dir, "events").withColumn("t", micros("ts"))


def quaternions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as two poses each: positions and raw quaternions from the first fourteen elements."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", F.slice("embedding", 1, 7).alias("p"), F.slice("embedding", 8, 7).alias("q"))
