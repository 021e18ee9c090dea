"""Text, JSON, stamps, paths and layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as col
from ..functions import profiles
from .tables import events, table


def format_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    path = F.when(F.col("conv_id") % 3 == 0, F.concat(F.lit("/abs/"), "role")).otherwise(F.col("role"))
    return c.select("conv_id", "turn", col.frame_path(F.col("conv_id"), F.col("turn")).alias("frame"), col.episode_path(F.col("conv_id"), "data/").alias("file"), col.resolve_path(path, "/data/root/").alias("resolved"))


def frame_id_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    raw = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("|fid="), F.col("event_id"))).when(F.col("event_id") % 5 == 1, F.concat("event_type", F.lit("|fid=x"))).when(F.col("event_id") % 5 == 2, F.concat("event_type", F.lit("|fid=9|fid="), F.col("user_id"))).otherwise(F.concat("event_type", F.lit("|fid="), F.col("event_id")))
    out = e.select("event_id", col.frame_id(raw).alias("f"))
    return out.select("event_id", "f.serial", "f.frame")


def stamp_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    nanos = F.col("t") * 1000 + 7
    out = e.select("event_id", nanos.alias("ns"), col.split_nanos(nanos).alias("s"))
    return out.select("event_id", "ns", "s.sec", "s.nanosec", F.round(col.stamp_seconds(F.col("s.sec"), F.col("s.nanosec")), 3).alias("seconds"), (col.stamp_nanos(F.col("s.sec"), F.col("s.nanosec")) == F.col("ns")).alias("same"))


def layout_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    m = F.create_map(F.lit("nf_len"), F.col("c_nationkey").cast("long"), F.lit("cap_len"), F.col("c_custkey"))
    return c.select("c_custkey", col.sorted_json(F.when(F.col("c_custkey") % 4 != 0, m)).alias("layout"))


def parse_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    raw = F.when(F.col("event_id") % 4 == 0, F.col("props")).when(F.col("event_id") % 4 == 1, F.col("user_id").cast("string")).when(F.col("event_id") % 4 == 2, F.lit("{bad")).otherwise(F.lit('"text"'))
    return e.select("event_id", col.parse_json(raw).alias("j")).groupBy("j.kind").agg(F.count("*").alias("n"))


def first_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key that is present but null ends the search."""
    e = table(spark, sf_dir, "events")
    keys = F.when(F.col("event_id") % 3 == 0, F.create_map(F.lit("pose"), F.lit(None).cast("string"), F.lit("pos"), F.col("event_type"))).when(F.col("event_id") % 3 == 1, F.create_map(F.lit("pos"), F.col("event_type"))).otherwise(F.create_map(F.lit("x"), F.col("event_type")))
    return e.select("event_id", col.first_present(keys, "pose", "ee_pose", "pos").alias("found"))


def layout_contiguity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of frames, one for each customer: each starts where the last ended, and is as long as its shape says."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", (F.col("o_orderkey") % 48 + 1).alias("height"), (F.col("o_custkey") % 64 + 1).alias("width"), F.lit(3).alias("channels"), F.lit(4).alias("itemsize"))
    return profiles.placed_segments(o, ["o_custkey"], ["o_orderkey"], ["height", "width", "channels", "itemsize"]).select("o_orderkey", "o_custkey", "start", "length")


def numeric_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    raw = F.when(F.col("event_id") % 3 == 0, F.col("value").cast("string")).when(F.col("event_id") % 3 == 1, F.lit("n/a"))
    return e.select("event_id", F.round(col.to_number(raw), 4).alias("number"), col.is_finite(col.to_number(raw)).alias("finite"))


def clip_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.round(col.clip(F.col("value"), 2.0, 15.0), 4).alias("clipped"), F.round(col.midpoint(F.col("value"), F.lit(3.0)), 4).alias("middle"), (col.truth(F.col("value") > 5)).alias("truth"))


_FID = "CASE event_id % 5 WHEN 0 THEN '|fid=' || event_id WHEN 1 THEN event_type || '|fid=x' WHEN 2 THEN event_type || '|fid=9|fid=' || user_id ELSE event_type || '|fid=' || event_id END"

QUERIES = {
    "format_paths": (
        format_paths,
        "SELECT conv_id, turn, printf('episode_%06d/frame_%06d.png', conv_id, turn) AS frame, printf('data/episode_%06d.parquet', conv_id) AS file, CASE WHEN conv_id % 3 = 0 THEN '/abs/' || role ELSE '/data/root/' || role END AS resolved FROM conversations",
    ),
    "frame_id_parse": (frame_id_parse, f"SELECT event_id, nullif(regexp_extract(f, '^(.+)\\|fid=(\\d+)$', 1), '') AS serial, try_cast(nullif(regexp_extract(f, '^(.+)\\|fid=(\\d+)$', 2), '') AS BIGINT) AS frame FROM (SELECT event_id, {_FID} AS f FROM events)"),
    "stamp_math": (
        stamp_math,
        "SELECT event_id, ns, ns // 1000000000 AS sec, ns % 1000000000 AS nanosec, round(ns // 1000000000 + (ns % 1000000000) * 1e-9, 3) AS seconds, true AS same FROM (SELECT event_id, epoch_us(ts) * 1000 + 7 AS ns FROM events)",
    ),
    "layout_json": (layout_json, "SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN '{\"cap_len\":' || c_custkey || ',\"nf_len\":' || c_nationkey || '}' ELSE '{}' END AS layout FROM customer"),
    "parse_json": (parse_json, "SELECT CASE event_id % 4 WHEN 0 THEN 'object' WHEN 2 THEN 'error' ELSE 'value' END AS kind, count(*) AS n FROM events GROUP BY 1"),
    "first_present": (first_present, "SELECT event_id, CASE WHEN event_id % 3 = 1 THEN event_type END AS found FROM events"),
    "layout_contiguity": (
        layout_contiguity,
        """WITH s AS (SELECT o_orderkey, o_custkey, (o_orderkey % 48 + 1) * (o_custkey % 64 + 1) * 12 AS length FROM orders)
        SELECT *, coalesce(sum(length) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM s""",
    ),
    "numeric_coercion": (numeric_coercion, "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN round(value, 4) END AS number, event_id % 3 = 0 AND value IS NOT NULL AS finite FROM events"),
    "clip_values": (clip_values, "SELECT event_id, round(least(greatest(value, 2.0), 15.0), 4) AS clipped, round((value + 3.0) / 2, 4) AS middle, coalesce(value > 5, false)::INTEGER AS truth FROM events"),
}
