"""Raw rows to a training export: segments, vectors from the store, new indices, statistics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import c, vector_problem
from ..operators.lookups import missing_columns, require_columns
from ..operators.sequences import episode_ranges, gap_segments, reindex, retime
from ..operators.statistics import vector_stats
from ..sinks.writers import publish, video_manifest, write_document, write_fixed_lists, write_table_file, write_task_file
from ..sources.readers import read_episodes, read_json, relative_episode
from ..sources.schemas import EXPORT_VECTORS, SIDES


@dataclass(frozen=True)
class Export:
    fps: float
    task: str = ""
    split_on_gap: bool = False
    gap_factor: float = 1.5


# fixed values: names of an export's videos, and of the values of its state and action
VIDEOS = {"observation.images.front": "image", "observation.images.wrist": "wrist_image"}
STATE_NAMES = ["x", "y", "z", "rx", "ry", "rz", "gripper"]
#: Rows of a data file, about: an episode is never cut.
FILE_ROWS = 1_000_000


@dataclass(frozen=True)
class Exported:
    """The parts of an export, all lazy; ``files`` is the rows with the number of their ``file``."""

    rows: DataFrame
    files: DataFrame
    episodes: DataFrame
    stats: DataFrame
    videos: DataFrame


def build(raw: DataFrame, stores: dict[str, DataFrame], how: Export) -> Exported:
    """``raw`` has ``raw_episode`` and the recorded columns; a store has store_index and data."""
    if not how.fps > 0:
        raise ValueError(f"fps is {how.fps}")
    needed = ["timestamp", "observation.state", "action", "image.path", "wrist_image.path", *[f"tactile.{s}.zarr_index" for s in SIDES]]
    require_columns(raw, [*needed, "raw_episode"], "raw rows")
    raw = raw.withColumn("order__", F.col("row" if "row" in raw.columns else "frame_index"))
    order = ["order__"]
    most = how.gap_factor / how.fps if how.split_on_gap else float("inf")
    rows = gap_segments(raw, ["raw_episode"], order, "timestamp", most)
    for side in SIDES:
        store = stores[side].select(F.col("store_index").alias(f"{side}__"), F.col("data").cast("array<float>").alias(f"observation.tactile_{side}"))
        rows = rows.join(store, c(f"tactile.{side}.zarr_index") == F.col(f"{side}__"), "left").drop(f"{side}__")
    # the numbers a recording had go; those of the export come
    kept = rows.drop("index", "episode_index", "frame_index", "timestamp", "task_index")
    numbered = retime(reindex(kept, ["raw_episode", "segment"], order), "frame_index", how.fps)
    numbered = numbered.withColumn("task_index", F.lit(0).cast("long"))
    vectors = [c(n).cast("array<float>").alias(n) for n in EXPORT_VECTORS]
    file = F.floor((F.col("index") - F.col("frame_index")) / FILE_ROWS).cast("int").alias("file")
    files = numbered.select("index", "episode_index", "frame_index", "timestamp", "task_index", *vectors, file)
    table = files.drop("file")
    ranges = episode_ranges(numbered, "episode_index", "index", how.fps)
    source = numbered.groupBy("episode_index").agg(F.first("raw_episode").alias("raw_episode"))
    start, end, zero = F.col("from_index"), F.col("to_index"), F.lit(0).cast("long")
    columns = {"tasks": F.array(F.lit(how.task)), "length": F.col("length"), "from": start, "to": end, "dataset_from_index": start, "dataset_to_index": end}
    columns |= {"data/chunk_index": zero, "data/file_index": F.floor(start / FILE_ROWS).cast("long")}
    for key in VIDEOS:
        columns |= {f"videos/{key}/chunk_index": zero, f"videos/{key}/file_index": zero, f"videos/{key}/from_timestamp": F.col("from_timestamp"), f"videos/{key}/to_timestamp": F.col("to_timestamp")}
    columns |= {"task_index": zero, "raw_episode": relative_episode(F.col("raw_episode"))}
    episodes = ranges.join(source, "episode_index").select("episode_index", *[x.alias(n) for n, x in columns.items()])
    videos = video_manifest(numbered, {k: f"{p}.path" for k, p in VIDEOS.items()}, how.fps)
    return Exported(table, files, episodes, vector_stats(table, EXPORT_VECTORS), videos)


def problems(rows: DataFrame, dims: dict[str, int]) -> DataFrame:
    """Rows whose vectors are missing, of another size or not finite: index, column, problem."""
    found = F.explode(F.array(*[F.struct(F.lit(n).alias("column"), vector_problem(c(n), d).alias("problem")) for n, d in dims.items()]))
    return rows.select("index", found.alias("f")).where("f.problem is not null").select("index", "f.column", "f.problem")


def stats_document(stats: DataFrame) -> dict:
    """Statistics by column, as lists over dimensions: as many values as the vectors have."""
    out: dict[str, dict] = {}
    for r in stats.orderBy("column", "dim").collect():
        one = out.setdefault(r["column"], {"mean": [], "std": [], "min": [], "max": [], "count": [r["count"]]})
        for k in ("mean", "std", "min", "max"):
            one[k].append(r[k])
    return out


def _features(dims: dict[str, int], sizes: dict[str, list[int] | None], fps: float) -> dict:
    """What an export's columns and videos hold."""
    videos = {k: {"dtype": "video", "shape": [*(shape or [None, None]), 3], "names": ["height", "width", "channel"], "info": {"video.fps": fps}} for k, shape in sizes.items()}
    names = {"observation.state": STATE_NAMES, "action": [f"d{n}" if n != "gripper" else n for n in STATE_NAMES]}
    vectors = {n: {"dtype": "float32", "shape": [d], "names": names.get(n)} for n, d in dims.items()}
    scalars = {n: {"dtype": "float32" if n == "timestamp" else "int64", "shape": [1], "names": None} for n in ("timestamp", "frame_index", "episode_index", "task_index", "index")}
    return videos | vectors | scalars


def export(spark, raw_root: str, out_root: str, stores: dict[str, DataFrame], how: Export | None = None, overwrite: bool = False) -> dict:
    """Reads a raw dataset, writes the export and returns its totals."""
    info = read_json(spark, f"{raw_root}/meta/info.json")
    how = how or Export(float(info["fps"]), info.get("task_description", ""))
    raw = read_episodes(spark, raw_root)
    built = build(raw, stores, how)
    dims = {"observation.state": 7, "action": 7} | {f"observation.tactile_{s}": len(stores[s].select("data").first()["data"]) for s in SIDES}
    bad = problems(built.rows, dims).limit(1).collect()
    if bad:
        raise ValueError(f"row {bad[0]['index']}: {bad[0]['column']} is {bad[0]['problem']}")
    totals = built.episodes.agg(F.count("*").alias("episodes"), F.sum("length").alias("frames")).first()
    frames = totals["frames"] or 0
    if not frames:
        raise ValueError(f"{raw_root} has no rows")
    sized = {k: [f"{p}.height", f"{p}.width"] for k, p in VIDEOS.items() if not missing_columns(raw, [f"{p}.height", f"{p}.width"])}
    first = raw.limit(1).select(*[c(n).cast("int") for names in sized.values() for n in names]).first() if sized else []
    sizes = {k: list(first[2 * i : 2 * i + 2]) if k in sized else None for i, k in enumerate(VIDEOS)}

    def write(root: str) -> dict:
        by_file = built.files.repartitionById(-(-frames // FILE_ROWS), "file").sortWithinPartitions("index").drop("file")
        write_fixed_lists(by_file, f"{root}/data/chunk-000", dims)
        write_table_file(built.episodes.orderBy("episode_index"), f"{root}/meta/episodes/chunk-000/file-000.parquet")
        write_task_file(spark, f"{root}/meta/tasks.parquet", [how.task])
        built.videos.write.parquet(f"{root}/meta/videos")
        found = {
            "codebase_version": "v3.0",
            "source_dataset_type": info.get("dataset_type"),
            "source_raw_root": raw_root,
            "tactile_msg_package": info.get("tactile_msg_package"),
            "fps": how.fps,
            "task": how.task,
            "total_episodes": totals["episodes"],
            "total_frames": frames,
            "total_tasks": 1,
            "total_chunks": 1,
            "chunks_size": 1000,
            "splits": {"train": f"0:{totals['episodes']}"},
            "data_path": "data/chunk-{chunk_index:03d}/file-{file_index:03d}.parquet",
            "video_path": "videos/{video_key}/chunk-{chunk_index:03d}/file-{file_index:03d}.mp4",
            "features": _features(dims, sizes, how.fps),
        }
        write_document(spark, f"{root}/meta/stats.json", stats_document(built.stats))
        write_document(spark, f"{root}/meta/info.json", found)
        return found

    return publish(spark, out_root, write, overwrite)
