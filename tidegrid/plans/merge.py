"""Several raw datasets to one, renumbered, with their stores and logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c, frame_path
from ..operators.lookups import require_columns
from ..operators.sequences import reindex
from ..sources.schemas import COMPATIBLE, IMAGE_LOG, MERGE_REQUIRED, METADATA_LOG, SIDES


def incompatible(infos: list[dict]) -> list[str]:
    """What keeps datasets from merging: fields that differ from the first one's."""
    return [f"source {i}: {k} is {d.get(k)!r}, not {infos[0].get(k)!r}" for i, d in enumerate(infos) for k in COMPATIBLE if d.get(k) != infos[0].get(k)]


def merge(sources: list[DataFrame], stores: list[dict[str, DataFrame]], infos: list[dict]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Rows of all sources in the order given, and each side's store.

    Rows get new index, episode_index and store indices, which follow the order of the rows; ``source``, the
    old ``source_episode`` and ``source_index``, and ``old.<side>``, the old store indices, stay.  Sources that differ in what the contract
    names, or lack a column, are an error; rows whose index a store lacks as well.
    """
    found = incompatible(infos)
    if found:
        raise ValueError("; ".join(found))
    parts = []
    for i, df in enumerate(sources):
        require_columns(df, MERGE_REQUIRED, f"source {i}")
        parts.append(df.withColumns({"source": F.lit(i), "source_episode": F.col("episode_index"), "source_index": F.col("index")}))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    old = {s: f"tactile.{s}.zarr_index" for s in SIDES}
    rows = reindex(rows.drop("index", "episode_index", "frame_index"), ["source", "source_episode"], ["source_index"])
    merged = {}
    for side in SIDES:
        store = reduce(DataFrame.unionByName, [s[side].withColumn("source__", F.lit(i)) for i, s in enumerate(stores)])
        wanted = rows.select(F.col("source").alias("source__"), c(old[side]).alias("store_index"), F.col("index").alias("new__"))
        lost = wanted.join(store, ["source__", "store_index"], "left_anti").limit(1).collect()
        if lost:
            raise ValueError(f"source {lost[0]['source__']}: {side} index {lost[0]['store_index']} is not in the store")
        merged[side] = store.join(wanted, ["source__", "store_index"]).select(F.col("new__").alias("store_index"), "data")
        rows = rows.withColumns({f"old.{side}": c(old[side]), old[side]: F.col("index")})
    return rows, merged


def source_totals(rows: DataFrame) -> DataFrame:
    """Per source its frames, episodes and half-open ranges in the merged table."""
    return rows.groupBy("source").agg(
        F.count("*").alias("frames"), F.count_distinct("episode_index").alias("episodes"), F.min("index").alias("from_index"), (F.max("index") + 1).alias("to_index"), F.min("episode_index").alias("from_episode"), (F.max("episode_index") + 1).alias("to_episode")
    )


def place_images(rows: DataFrame, roots: list[str], folders: dict[str, str]) -> DataFrame:
    """Rows with their images' places in the merged dataset; ``old.<path>`` is the source's path, ``from.<path>`` where that lies."""
    root = F.element_at(F.array(*[F.lit(r.rstrip("/") + "/") for r in roots]), F.col("source") + 1)
    for camera, folder in folders.items():
        old = c(f"{camera}.path")
        lies = F.when(old.startswith("/") | old.contains("://"), old).otherwise(F.concat(root, old))
        rows = rows.withColumns({f"old.{camera}.path": old, f"from.{camera}.path": lies})
        rows = rows.withColumn(f"{camera}.path", frame_path(F.col("episode_index"), F.col("frame_index"), f"{folder}/"))
    return rows


def rewritten_log(rows: DataFrame, logs: list[DataFrame], key: str, row_key: str, schema: str, changed: dict[str, Column]) -> DataFrame:
    """A log with an entry for each merged row: the source's own, if it has one, with the changed fields.

    ``logs`` has each source's log, one entry for each key.  ``changed`` has expressions over the rows.
    """
    spark = rows.sparkSession
    whole = spark.createDataFrame([], f"source__ int, {schema}")
    for i, log in enumerate(logs):
        whole = whole.unionByName(log.withColumn("source__", F.lit(i)))
    fields = [f.name for f in whole.schema if f.name != "source__"]
    entry = whole.select("source__", F.col(key).alias("key__"), F.struct(*fields).alias("entry"))
    joined = rows.join(entry, (F.col("source") == F.col("source__")) & (c(row_key) == F.col("key__")), "left")
    out = joined.select(F.col("index").alias("index__"), *[(F.coalesce(changed[n], F.col(f"entry.{n}")) if n in changed else F.col(f"entry.{n}")).alias(n) for n in fields])
    return out.repartitionByRange("index__").sortWithinPartitions("index__").drop("index__")


def image_log(rows: DataFrame, logs: list[DataFrame], camera: str) -> DataFrame:
    """A camera's index: of each row its place in the merged dataset, and its image's properties."""
    told = ("height", "width", "encoding", "step", "ros_stamp_sec", "ros_stamp_nanosec", "ros_stamp_float", "frame_id")
    changed = {"episode_index": c("episode_index"), "record_frame_index": c("frame_index"), "path": c(f"{camera}.path")}
    changed |= {n: c(f"{camera}.{n}") for n in told if f"{camera}.{n}" in rows.columns}
    return rewritten_log(rows, logs, "path", f"old.{camera}.path", IMAGE_LOG, changed)


def sensor_log(rows: DataFrame, logs: list[DataFrame], side: str, place: str) -> DataFrame:
    """A sensor's metadata: of each row its new index, episode and frame."""
    changed = {"episode_index": c("episode_index"), "frame_index": c("frame_index"), "zarr_index": c(f"tactile.{side}.zarr_index"), "zarr_path": F.lit(place)}
    changed |= {n: c(n) for n in ("timestamp", "wall_time") if n in rows.columns}
    return rewritten_log(rows, logs, "zarr_index", f"old.{side}", METADATA_LOG, changed)


__all__ = ["image_log", "incompatible", "merge", "place_images", "rewritten_log", "sensor_log", "source_totals"]
