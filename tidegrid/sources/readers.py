"""Scans of episode tables, stores, logs, images and settings."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lookups import keep_last
from .lines import read_numbered


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _path(spark, path)
    return bool(fs.exists(target))


def matches(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, in order of their names."""
    target, fs = _path(spark, pattern)
    return sorted(s.getPath().toString() for s in (fs.globStatus(target) or []))


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, through the store that Spark reads from."""
    rows = spark.read.text(path, wholetext=True).collect()
    return "\n".join(r[0] for r in rows)


def read_json(spark: SparkSession, path: str, missing=None):
    """A JSON document; ``missing`` in place of one that is not there, an error if that is None."""
    if not exists(spark, path):
        if missing is None:
            raise FileNotFoundError(path)
        return missing
    return json.loads(read_text(spark, path))


def storage_path(root: str, info: dict, key: str, default: str) -> str:
    """Where the dataset's settings say a part lies; relative places are under the root."""
    place = (info.get("storage") or {}).get(key, default)
    return place if place.startswith("/") or "://" in place else f"{root.rstrip('/')}/{place}"


def read_episodes(spark: SparkSession, root: str, schema: str | None = None, fallback: bool = True) -> DataFrame:
    """Rows of all episode files with ``raw_episode``, the file, and ``row``, the place in it.

    Without episode files the master table is read, unless ``fallback`` is off: then that is an error.
    """
    files = matches(spark, f"{root}/data/episodes/episode_*.parquet")
    if not files:
        files = matches(spark, f"{root}/data/chunk-*/file-*.parquet") if fallback else []
    if not files:
        raise FileNotFoundError(f"no episode tables under {root}/data")
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(*files).select("*", F.col("_metadata.file_path").alias("raw_episode"), F.col("_metadata.row_index").alias("row"))


def relative_episode(path: Column) -> Column:
    """An episode file's path relative to the root of its dataset."""
    return F.regexp_replace(path, r"^.*?/(data/(?:episodes|chunk-\d+)/[^/]+\.parquet)(?:/[^/]+)?$", "$1")


def read_master(spark: SparkSession, root: str, info: dict, schema: str | None = None) -> DataFrame:
    path = storage_path(root, info, "data_path", "data/chunk-000/file-000.parquet")
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def read_chunks(spark: SparkSession, root: str, schema: str | None = None) -> DataFrame:
    """An exported dataset's rows; their order is that of ``index``."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(f"{root}/data/chunk-*/file-*.parquet")


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Lines of JSON; the first malformed one is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_log_tolerant(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Lines of JSON as ``value``, with their ``line`` from 1 and ``error``, the text of a malformed one."""
    lines = read_numbered(spark, path).where(F.trim("text") != "")
    parsed = F.from_json("text", f"{schema}, `_bad` string", {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"})
    out = lines.select("line", "text", parsed.alias("value"))
    bad = F.col("value").isNull() | F.col("value._bad").isNotNull()
    return out.select("line", F.when(~bad, F.col("value").dropFields("_bad")).alias("value"), F.when(bad, F.col("text")).alias("error"))


def read_log_by(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """One row for each key of a log: the last, over all files in the order of their names if it is a folder."""
    lines = read_numbered(spark, path).where(F.trim("text") != "")
    rows = lines.select("place", F.from_json("text", schema, {"mode": "FAILFAST"}).alias("v")).select(F.col("place").alias("place__"), "v.*")
    return keep_last(rows, [key], "place__").drop("place__")


#: Older names of settings that stand in for newer ones.
FALLBACKS = {"image": "zed_image", "wrist_image": "d405_image", "max_image_dt_sec": "max_cloud_dt_sec"}


def settings(given: dict, defaults: dict) -> dict:
    """Defaults overridden by what is given, level by level, with older names understood."""
    out = {}
    for key, default in defaults.items():
        value = given.get(key, given.get(FALLBACKS.get(key, key), default))
        out[key] = settings(value or {}, default) if isinstance(default, dict) else value
    return out


def read_settings(spark: SparkSession, path: str, defaults: dict) -> dict:
    """Settings from a YAML or JSON file over their defaults; YAML needs its parser to be installed."""
    text = read_text(spark, path)
    if path.endswith(".json"):
        return settings(json.loads(text), defaults)
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError(f"{path}: no YAML parser is installed") from e
    return settings(yaml.safe_load(text) or {}, defaults)


def stream_log(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 1) -> DataFrame:
    """A folder of JSON-lines files as a stream, oldest first, with ``source_file``, the file a line is from."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).schema(schema).json(folder)
    return lines.select("*", F.col("_metadata.file_path").alias("source_file"))
