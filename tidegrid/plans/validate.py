"""Rules over an exported dataset, alone and against the raw rows it came from."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import c, vector_problem
from ..operators.lookups import by_cursor, missing_columns, within
from ..operators.sequences import contiguity
from ..operators.statistics import all_close
from ..sources.readers import relative_episode
from ..sources.schemas import EXPORT_VECTORS
from .check import _found, _told

TOLERANCE, TIME_TOLERANCE = 1e-6, 1e-5
# fixed values: columns that episodes must have
EPISODE_COLUMNS = ["episode_index", "length", "from", "to", "dataset_from_index", "dataset_to_index", "task_index", "tasks"]


def vector_types(spark: SparkSession, files: list[str], dims: dict[str, int]) -> DataFrame:
    """Findings over data files' own schemas: vectors must be lists of a fixed size of float32.

    Only the files' footers are read, each where its task runs.
    """
    from ..sources.arrays import _open

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        for batch in batches:
            found = []
            for path in batch.column(0).to_pylist():
                store, place = _open(path)
                schema = pq.read_schema(place, filesystem=store)
                for name, dim in dims.items():
                    kind = schema.field(name).type if name in schema.names else None
                    if kind != pa.list_(pa.float32(), dim):
                        found.append((f"vector type {name}", f"{path}: {kind}"))
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.string()) for i in range(2)], names=["rule", "example"])

    each = spark.createDataFrame([(f,) for f in files], "path string").repartition(max(1, min(len(files), 64))).mapInArrow(run, "rule string, example string")
    return each.groupBy("rule").agg(F.count("*").alias("count"), F.min("example").alias("example")).select("rule", F.lit("error").alias("level"), "count", "example")


def against_stores(rows: DataFrame, episodes: DataFrame, raw: DataFrame, stores: dict[str, DataFrame], tolerance: float = TOLERANCE) -> DataFrame:
    """``against_raw`` for the sensors' vectors, which the raw rows have by index into their stores."""
    for side, store in stores.items():
        data = store.select(F.col("store_index").alias("at__"), F.col("data").cast("array<float>").alias(f"store.{side}"))
        raw = raw.join(data, c(f"tactile.{side}.zarr_index") == F.col("at__"), "left").drop("at__")
    return against_raw(rows, episodes, raw, {f"observation.tactile_{s}": f"store.{s}" for s in stores}, tolerance)


def validate(rows: DataFrame, episodes: DataFrame, info: dict, dims: dict[str, int], time_tolerance: float = TIME_TOLERANCE, as_float: bool = True) -> DataFrame:
    """Totals, columns, vectors, ranges, indices and timestamps.

    Timestamps are compared as float32, as they are stored; with ``as_float`` off, as doubles,
    under which long episodes miss the tolerance.
    """
    spark = rows.sparkSession
    absent = missing_columns(rows, ["index", "episode_index", "frame_index", "timestamp", "task_index", *EXPORT_VECTORS])
    if absent:
        return _told(spark, "columns", ", ".join(absent), len(absent))
    parts = []
    absent = missing_columns(episodes, EPISODE_COLUMNS)
    if absent:
        return _told(spark, "episode columns", ", ".join(absent), len(absent))
    episodes = episodes.withColumns({"from_index": F.col("dataset_from_index"), "to_index": F.col("dataset_to_index")})
    apart = (F.col("from") != F.col("from_index")) | (F.col("to") != F.col("to_index"))
    parts.append(_found(episodes, "episode from and to", F.coalesce(apart, F.lit(True)), F.col("episode_index")))
    parts.append(_found(episodes, "episode empty", F.coalesce(F.col("from_index") >= F.col("to_index"), F.lit(True)), F.col("episode_index")))
    n, m = rows.count(), episodes.count()
    parts += [_told(spark, f"total {k}", f"{info.get(f'total_{k}')}, not {x}") for k, x in (("frames", n), ("episodes", m)) if info.get(f"total_{k}") != x]
    for name, dim in dims.items():
        problem = vector_problem(c(name), dim)
        parts.append(_found(rows, f"vector {name}", problem.isNotNull(), problem))
    inside = within(rows.select("index", F.col("episode_index").alias("own")), episodes.select("episode_index", "from_index", "to_index"), "index", "from_index", "to_index")
    counted = inside.groupBy("episode_index").agg(F.count("*").alias("rows"), F.bool_or(F.col("own") != F.col("episode_index")).alias("foreign"))
    joined = episodes.select("episode_index", "length", "from_index", "to_index").join(counted, "episode_index", "left")
    parts.append(_found(joined, "episode length", (F.col("length") != F.coalesce("rows", F.lit(0))) | (F.col("to_index") - F.col("from_index") != F.col("length")), F.col("episode_index")))
    parts.append(_found(joined, "episode range", F.col("foreign"), F.col("episode_index")))
    parts.append(_found(contiguity(rows, ["episode_index"], "frame_index", ["index"]), "frame_index", ~F.col("contiguous"), F.col("episode_index")))
    span = rows.agg(F.min("index").alias("a"), F.max("index").alias("z"), F.count_distinct("index").alias("d"))
    parts.append(_found(span, "index", (F.col("a") != 0) | (F.col("z") != n - 1) | (F.col("d") != n), F.col("z")))
    due = F.col("frame_index") / F.lit(float(info["fps"]))
    due = due.cast("float") if as_float else due
    parts.append(_found(rows, "timestamp", F.abs(F.col("timestamp").cast("double") - due.cast("double")) > time_tolerance, F.col("index")))
    return reduce(DataFrame.unionByName, parts)


def against_raw(rows: DataFrame, episodes: DataFrame, raw: DataFrame, columns: dict[str, str], tolerance: float = TOLERANCE) -> DataFrame:
    """Per column: rows compared, greatest difference, where, and whether all are close.

    Episodes use their raw file's rows up in order.  ``raw``: raw_episode, row and the columns; episodes have the
    file relative to the root.
    """
    raw_rows = raw.select(relative_episode(F.col("raw_episode")).alias("raw_episode"), "row", *[c(v).alias(f"r{i}") for i, v in enumerate(columns.values())])
    listed = by_cursor(episodes.select("raw_episode", "episode_index", "length"), raw_rows, "raw_episode", "episode_index", "length", "row")
    pairs = rows.select("episode_index", "frame_index", "index", *[c(k).alias(f"e{i}") for i, k in enumerate(columns)])
    raw_side = listed.select("episode_index", F.col("position").cast("long").alias("frame_index"), *[f"r{i}" for i in range(len(columns))])
    joined = pairs.join(raw_side, ["episode_index", "frame_index"], "left")
    parts = []
    for i, name in enumerate(columns):
        long = joined.select("index", F.posexplode(F.arrays_zip(F.col(f"e{i}").alias("a"), F.col(f"r{i}").alias("b"))).alias("dim", "p"))
        a, b = F.col("p.a").cast("double"), F.col("p.b").cast("double")
        missing = joined.where(F.col(f"r{i}").isNull()).agg(F.count("*").alias("unmatched"))
        one = long.select("index", "dim", a.alias("a"), b.alias("b")).agg(F.count("*").alias("values"), F.max(F.abs(F.col("a") - F.col("b"))).alias("max_diff"), F.max_by("index", F.abs(F.col("a") - F.col("b"))).alias("at_index"), all_close(F.col("a"), F.col("b"), tolerance).alias("close"))
        parts.append(one.crossJoin(missing).select(F.lit(name).alias("column"), "*"))  # one row by one row
    return reduce(DataFrame.unionByName, parts)
