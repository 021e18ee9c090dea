"""Durable outputs: tables, stores, logs, documents and wide text."""

from __future__ import annotations

import io
import json
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import c
from ..sources.readers import _path, exists, matches


def remove(spark: SparkSession, path: str) -> None:
    target, fs = _path(spark, path)
    fs.delete(target, True)


def prepare(spark: SparkSession, root: str, overwrite: bool = False) -> str:
    """A root that is free: an error if it exists, unless it may be overwritten."""
    if exists(spark, root):
        if not overwrite:
            raise FileExistsError(root)
        remove(spark, root)
    return root


def publish(spark: SparkSession, root: str, write: Callable[[str], object], overwrite: bool = False):
    """Runs ``write`` on a hidden folder next to ``root`` and renames it when all is written.

    What was at ``root`` is renamed aside first and goes last.  If anything fails the hidden folder goes, and
    what was at ``root`` is there again.
    """
    there = exists(spark, root)
    if there and not overwrite:
        raise FileExistsError(root)
    base, _, name = root.rstrip("/").rpartition("/")
    draft, aside = (f"{base}/.{name}.{kind}.{uuid.uuid4().hex}" for kind in ("new", "old"))
    target, fs = _path(spark, root)
    place = lambda path: _path(spark, path)[0]
    try:
        result = write(draft)
        if there and not fs.rename(target, place(aside)):
            raise OSError(f"{root} could not be put aside")
        if not fs.rename(place(draft), target):
            if there and not fs.rename(place(aside), target):
                raise OSError(f"{draft} could not be renamed to {root}; what was there is {aside}")
            raise OSError(f"{draft} could not be renamed to {root}")
    except BaseException:
        remove(spark, draft)
        raise
    if there:
        remove(spark, aside)
    return result


def write_episodes(df: DataFrame, root: str, mode: str = "errorifexists") -> None:
    """A folder for each episode, so that readers of one episode read it alone."""
    df.repartition("episode_index").sortWithinPartitions("episode_index", "frame_index").write.mode(mode).partitionBy("episode_index").parquet(f"{root}/data/episodes")


def write_fixed_lists(df: DataFrame, folder: str, dims: dict[str, int]) -> None:
    """Parquet whose vectors are lists of a fixed size, which Spark's writer does not make.

    Partitions become files, named after their place; a task that is repeated writes the same file again.
    """
    names = df.columns

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        from ..sources.arrays import _open

        store, base = _open(folder)
        store.create_dir(base, recursive=True)
        part = TaskContext.get().partitionId()
        final, draft = f"{base}/file-{part:03d}.parquet", f"{base}/.file-{part:03d}-{TaskContext.get().taskAttemptId()}"
        writer, rows = None, 0
        for batch in batches:
            columns = []
            for i, n in enumerate(names):
                x = batch.column(i)
                columns.append(pa.FixedSizeListArray.from_arrays(x.flatten().cast(pa.float32()), dims[n]) if n in dims else x)
            table = pa.Table.from_arrays(columns, names=names)
            writer = writer or pq.ParquetWriter(draft, table.schema, filesystem=store)
            writer.write_table(table)
            rows += len(table)
        if writer:
            writer.close()
            store.move(draft, final)
        yield pa.RecordBatch.from_arrays([pa.array([rows])], names=["rows"])

    checks = [F.size(c(n)) == d for n, d in dims.items()]
    for check in checks:
        if df.where(~F.coalesce(check, F.lit(False))).limit(1).count():
            raise ValueError(f"a vector has another size than {dims}")
    # plain names on the way, as dots would be taken for fields
    df.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(write, "rows long").agg(F.sum("rows")).collect()


def write_table_file(df: DataFrame, path: str) -> None:
    """One Parquet file at ``path`` of a table of moderate size, such as one row for each episode."""
    spark = df.sparkSession
    draft = f"{path}.{uuid.uuid4().hex}"
    df.coalesce(1).write.parquet(draft)
    target, fs = _path(spark, path)
    (part,) = matches(spark, f"{draft}/part-*.parquet")
    fs.mkdirs(target.getParent())
    if not fs.rename(_path(spark, part)[0], target):
        raise OSError(f"{path} could not be written")
    remove(spark, draft)


def write_task_file(spark: SparkSession, path: str, tasks: list[str]) -> None:
    """Tasks and their numbers, the text as the table's index."""
    import pandas as pd

    made = io.BytesIO()
    pd.DataFrame({"task_index": range(len(tasks))}, index=pd.Index(tasks, name="task")).to_parquet(made)
    _write_bytes(spark, path, made.getvalue())


def write_episode_files(df: DataFrame, folder: str) -> int:
    """A file ``episode_<number>.parquet`` for each episode, written in one pass and then renamed; their number."""
    spark = df.sparkSession
    draft = f"{folder}.{uuid.uuid4().hex}"
    placed = df.withColumn("file__", F.col("episode_index")).repartition("file__").sortWithinPartitions("file__", "frame_index")
    placed.write.partitionBy("file__").parquet(draft)
    target, fs = _path(spark, folder)
    fs.mkdirs(target)
    parts = matches(spark, f"{draft}/file__=*/part-*.parquet")
    for part in parts:
        number = int(part.rsplit("file__=", 1)[1].split("/")[0])
        if not fs.rename(_path(spark, part)[0], _path(spark, f"{folder}/episode_{number:06d}.parquet")[0]):
            raise OSError(f"episode {number} could not be put in place")
    remove(spark, draft)
    return len(parts)


def copy_files(files: DataFrame) -> int:
    """Copies each ``source`` to its ``target``, where the tasks run; their number.  A missing source is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ..sources.arrays import _open

        for batch in batches:
            for source, target in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                have, place = _open(source)
                store, goal = _open(target)
                store.create_dir(goal.rsplit("/", 1)[0], recursive=True)
                # written beside and moved, so that a task that runs again finds no half file
                draft = f"{goal}.{TaskContext.get().taskAttemptId()}"
                with have.open_input_stream(place) as read, store.open_output_stream(draft) as write:
                    while part := read.read(1 << 20):
                        write.write(part)
                store.move(draft, goal)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    return files.select("source", "target").mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def copy_document(spark: SparkSession, source: str, target: str) -> bool:
    """Copies one small file; false if there is none."""
    if not exists(spark, source):
        return False
    (old, have), (new, store) = _path(spark, source), _path(spark, target)
    return spark._jvm.org.apache.hadoop.fs.FileUtil.copy(have, old, store, new, False, spark.sparkContext._jsc.hadoopConfiguration())


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def write_document(spark: SparkSession, path: str, value) -> None:
    """A JSON document, indented, with its characters as they are."""
    _write_bytes(spark, path, json.dumps(value, ensure_ascii=False, indent=2).encode())


def _write_bytes(spark: SparkSession, path: str, value: bytes) -> None:
    target, fs = _path(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray(value))
    finally:
        out.close()


def write_wide(df: DataFrame, path: str, single: bool = False, mode: str = "errorifexists") -> None:
    """CSV with a header; one file if asked for, which one task then writes."""
    (df.coalesce(1) if single else df).write.mode(mode).option("header", True).csv(path)


def concat_logs(logs: list[DataFrame], path: str) -> None:
    """All logs' lines, one log after the other, appended."""
    for log in logs:
        append_log(log, path)


def video_manifest(rows: DataFrame, cameras: dict[str, str], fps: float) -> DataFrame:
    """Frames of each camera's video in order: key, index, image path and time range."""
    parts = F.explode(F.array(*[F.struct(F.lit(k).alias("video_key"), c(p).alias("path")) for k, p in cameras.items()]))
    out = rows.select("episode_index", "index", parts.alias("v")).select("v.video_key", "episode_index", "index", "v.path")
    return out.withColumns({"from_timestamp": F.col("index") / F.lit(float(fps)), "to_timestamp": (F.col("index") + 1) / F.lit(float(fps))})
