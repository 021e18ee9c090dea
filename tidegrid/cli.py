"""Commands over datasets: ``python -m tidegrid <command> ...``."""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.columns import c
from .operators.lookups import missing_columns, require_columns
from .operators.sequences import contiguity
from .plans import check as checks
from .plans import export as exports
from .plans import inspect as views
from .plans import media
from .plans import merge as merges
from .plans import validate as validations
from .sinks.writers import copy_document, copy_files, prepare, publish, write_document, write_episode_files, write_wide
from .sources import arrays, readers, schemas
from .sources.images import list_images

# fixed values: places of a dataset's parts
INFO, EPISODE_LOG, IMAGES = "meta/info.json", "meta/episodes.jsonl", {"image": "image/front", "wrist_image": "image/wrist"}
EVENT_LOGS = ("raw/command_events.jsonl", "raw/robot_state_events.jsonl", "raw/vr_controller_events.jsonl")


def open_store(spark: SparkSession, root: str, info: dict, side: str) -> tuple[DataFrame, str] | None:
    """A side's vectors and their type: a chunked array store, or a table with a side column; None if absent."""
    path = readers.storage_path(root, info, f"tactile_{side}_zarr", f"tactile/tactile_{side}/data.zarr")
    if not readers.exists(spark, path):
        return None
    if arrays.find_format(path) is not None:
        return arrays.read_array(spark, path), arrays.describe(path).dtype.name
    return spark.read.parquet(path).select("store_index", "data"), "float32"


def _kinds(spark: SparkSession, root: str, info: dict) -> dict[str, tuple[DataFrame, str]]:
    found = {s: open_store(spark, root, info, s) for s in schemas.SIDES}
    absent = [s for s, x in found.items() if x is None]
    if absent:
        raise FileNotFoundError(f"{root}: no store for {absent}")
    return found


def _stores(spark: SparkSession, root: str, info: dict) -> dict[str, DataFrame]:
    return {s: x[0] for s, x in _kinds(spark, root, info).items()}


def check_dataset(spark: SparkSession, root: str, sample_images: int = 5) -> DataFrame:
    """Findings of all rules over a raw dataset."""
    info = readers.read_json(spark, f"{root}/{INFO}", {})
    master = readers.read_master(spark, root, info)
    rows = readers.read_episodes(spark, root, fallback=False) if readers.matches(spark, f"{root}/data/episodes/episode_*.parquet") else master.withColumns({"raw_episode": F.lit(""), "row": F.col("index")}).limit(0)
    number = F.regexp_extract("raw_episode", r"episode_(\d+)\.parquet", 1).try_cast("long")
    each = contiguity(rows.withColumn("file__", number), ["file__"], "frame_index", ["row"])
    own = rows.groupBy(number.alias("file__")).agg(F.max_by("episode_index", F.abs(F.col("episode_index") - number)).alias("file_episode"))
    files = each.join(own, "file__").select(F.col("file__").alias("episode_index"), "file_episode", F.col("rows").alias("num_rows"), "contiguous")
    log = readers.read_log_tolerant(spark, f"{root}/{EPISODE_LOG}", schemas.EPISODE_LOG) if readers.exists(spark, f"{root}/{EPISODE_LOG}") else None
    entries = log.where("error is null").select("value.*") if log is not None else spark.createDataFrame([], schemas.EPISODE_LOG)
    images = {}
    for camera, place in IMAGES.items():
        where = readers.storage_path(root, info, f"{camera}_dir", place)
        if readers.exists(spark, where) and not missing_columns(master, [f"{camera}.path", f"{camera}.height", f"{camera}.width"]):
            base = F.regexp_replace("path", "^file:/+", "/")
            images[camera] = list_images(spark, where).withColumn("path", base)
            master = master.withColumn(f"{camera}.path", F.when(c(f"{camera}.path").startswith("/"), c(f"{camera}.path")).otherwise(F.concat(F.lit(f"{root.rstrip('/')}/"), c(f"{camera}.path"))))
    stores = {s: x for s in schemas.SIDES if (x := open_store(spark, root, info, s)) is not None}
    found = checks.check(master, info, entries, files, images, stores, sample_images)
    if log is None:
        return found.unionByName(checks._told(spark, "episode log", "missing"))
    return found.unionByName(checks._found(log, "episode log", F.col("error").isNotNull(), F.col("line")))


def _log_by(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    return readers.read_log_by(spark, path, schema, key) if readers.exists(spark, path) else spark.createDataFrame([], schema)


def merge_datasets(spark: SparkSession, roots: list[str], out_root: str, overwrite: bool = False) -> dict:
    """Writes the merged dataset, with its images, stores, metadata and logs; returns totals and each source's part."""
    infos = [readers.read_json(spark, f"{r}/{INFO}") for r in roots]
    sources = [readers.read_episodes(spark, r, fallback=False).drop("row") for r in roots]
    found = [_kinds(spark, r, i) for r, i in zip(roots, infos, strict=True)]
    types = {s: {f[s][1] for f in found} for s in schemas.SIDES}
    if mixed := [s for s, t in types.items() if len(t) > 1]:
        raise ValueError(f"stores of {mixed} differ in type: {types}")
    rows, stores = merges.merge(sources, [{s: x[0] for s, x in f.items()} for f in found], infos)
    storage = infos[0].get("storage") or {}
    folders = {camera: storage.get(f"{camera}_dir", place) for camera, place in IMAGES.items()}
    sensors = {s: f"tactile/tactile_{s}" for s in schemas.SIDES}
    rows = merges.place_images(rows, roots, folders).withColumns({f"tactile.{s}.zarr_path": F.lit(f"{p}/data.zarr") for s, p in sensors.items()})
    helpers = [n for n in rows.columns if n.startswith(("old.", "from."))]

    def write(root: str) -> dict:
        plain = rows.select(*[c(n) for n in rows.columns if n not in (*helpers, "raw_episode")])
        plain.repartitionByRange("index").sortWithinPartitions("index").write.parquet(f"{root}/data/chunk-000/file-000.parquet")
        write_episode_files(plain, f"{root}/data/episodes")
        for camera, folder in folders.items():
            copy_files(rows.select(c(f"from.{camera}.path").alias("source"), F.concat(F.lit(f"{root}/"), c(f"{camera}.path")).alias("target")))
            logs = [_log_by(spark, f"{r}/{folder}/index.jsonl", schemas.IMAGE_LOG, "path") for r in roots]
            merges.image_log(rows, logs, camera).write.option("ignoreNullFields", "false").json(f"{root}/{folder}/index.jsonl")
        for side, place in sensors.items():
            first = found[0][side][0].first()
            arrays.write_array(stores[side], f"{root}/{place}/data.zarr", len(first["data"]) if first else 1, *types[side])
            logs = [_log_by(spark, f"{r}/{place}/meta.jsonl", schemas.METADATA_LOG, "zarr_index") for r in roots]
            merges.sensor_log(rows, logs, side, f"{place}/data.zarr").write.option("ignoreNullFields", "false").json(f"{root}/{place}/meta.jsonl")
        named = F.element_at(F.array(*[F.lit(r) for r in roots]), F.col("source") + 1)
        task = F.coalesce(F.first("task_index").cast("long"), F.lit(int(infos[0].get("task_index", 0))))
        log = rows.groupBy("episode_index").agg(F.count("*").alias("num_frames"), F.first("source").alias("source"), F.first("raw_episode").alias("file"), task.alias("task_index"))
        file = F.regexp_extract("file", r"(data/episodes/[^/]+\.parquet)", 1)
        episode = lambda folder: F.format_string(f"{folder}/episode_%06d", "episode_index")
        log = log.select(
            "episode_index",
            "num_frames",
            F.concat(episode("data/episodes"), F.lit(".parquet")).alias("data_path"),
            *[episode(folder).alias(f"{camera}_dir") for camera, folder in folders.items()],
            *[F.lit(f"{place}/data.zarr").alias(f"tactile_{side}_zarr") for side, place in sensors.items()],
            "task_index",
            F.lit(infos[0].get("task_description", "teleoperation")).alias("task_description"),
            named.alias("source_raw_root"),
            file.alias("source_episode_path"),
        )
        log.repartitionByRange("episode_index").sortWithinPartitions("episode_index").write.json(f"{root}/{EPISODE_LOG}")
        for place in EVENT_LOGS:
            have = [spark.read.text(f"{r}/{place}") for r in roots if readers.exists(spark, f"{r}/{place}")]
            if have:
                whole = have[0]
                for more in have[1:]:
                    whole = whole.unionByName(more)
                whole.write.text(f"{root}/{place}")
        parts = [r.asDict() | {"raw_root": roots[r["source"]]} for r in merges.source_totals(rows).orderBy("source").collect()]
        totals = {"total_frames": sum(p["frames"] for p in parts), "total_episodes": sum(p["episodes"] for p in parts), "merged_from_raw_roots": roots, "merge_sources": parts}
        places = {f"{camera}_dir": folder for camera, folder in folders.items()} | {f"tactile_{s}_zarr": f"{p}/data.zarr" for s, p in sensors.items()}
        write_document(spark, f"{root}/{INFO}", infos[0] | totals | {"storage": storage | places | {"data_path": "data/chunk-000/file-000.parquet"}})
        write_document(spark, f"{root}/meta/merge_sources.json", {"sources": parts})
        copy_document(spark, f"{roots[0]}/meta/config.yaml", f"{root}/meta/config.yaml")
        return totals

    return publish(spark, out_root, write, overwrite)


def export_dataset(spark: SparkSession, raw_root: str, out_root: str, fps: float | None = None, task: str | None = None, split_on_gap: bool = False, gap_factor: float = 1.5, overwrite: bool = False) -> dict:
    info = readers.read_json(spark, f"{raw_root}/{INFO}")
    how = exports.Export(float(fps or info["fps"]), task if task is not None else info.get("task_description", ""), split_on_gap, gap_factor)
    return exports.export(spark, raw_root, out_root, _stores(spark, raw_root, info), how, overwrite)


# fixed values: files that an export must have
EXPORTED = [INFO, "data/chunk-000/file-000.parquet", "meta/episodes/chunk-000/file-000.parquet", "meta/tasks.parquet", "meta/stats.json"]


def _exported(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, dict]:
    info = readers.read_json(spark, f"{root}/{INFO}")
    return readers.read_chunks(spark, root), spark.read.parquet(f"{root}/meta/episodes/chunk-*/file-*.parquet"), info


def validate_dataset(spark: SparkSession, root: str, raw_root: str | None = None) -> DataFrame:
    """Findings over an export, and over its likeness to the raw rows and stores if they are given.

    Rules over videos are told as skipped, as videos are not written and cannot be decoded here.
    """
    absent = [f for f in EXPORTED if not readers.exists(spark, f"{root}/{f}")]
    if absent:
        return checks._told(spark, "required files", ", ".join(absent), len(absent))
    rows, episodes, info = _exported(spark, root)
    features = info["features"]
    dims = {n: features[n]["shape"][0] for n in schemas.EXPORT_VECTORS if n in features}
    told = [(n, features.get(n)) for n in schemas.EXPORT_VECTORS if n not in features or features[n].get("dtype") != "float32" or len(features[n]["shape"]) != 1]
    found = validations.validate(rows, episodes, info, dims).unionByName(validations.vector_types(spark, readers.matches(spark, f"{root}/data/chunk-*/file-*.parquet"), dims))
    for name, feature in told:
        found = found.unionByName(checks._told(spark, "feature", f"{name}: {feature}"))
    if not spark.read.parquet(f"{root}/meta/tasks.parquet").limit(1).count():
        found = found.unionByName(checks._told(spark, "tasks", "no tasks"))
    for key in exports.VIDEOS:
        found = found.unionByName(checks._told(spark, f"video {key}", "no decoder" if media.decoder() is None else "not written", level="skipped"))
    if raw_root is not None:
        raw = readers.read_episodes(spark, raw_root)
        require_columns(raw, ["observation.state", "action"], raw_root)
        likeness = validations.against_raw(rows, episodes, raw, {n: n for n in ("observation.state", "action")})
        sensors = validations.against_stores(rows, episodes, raw, _stores(spark, raw_root, readers.read_json(spark, f"{raw_root}/{INFO}")))
        likeness = likeness.unionByName(sensors)
        found = found.unionByName(checks._found(likeness, "raw rows", ~F.col("close") | (F.col("unmatched") > 0), F.col("column")))
    return found


def inspect_row(spark: SparkSession, root: str, index: int | None = None, episode: int | None = None, frame: int | None = None) -> DataFrame:
    rows, episodes, _ = _exported(spark, root)
    return views.summary(views.locate(rows, episodes, index, episode, frame), schemas.EXPORT_VECTORS)


def _write_sides(spark: SparkSession, out: str, which: str, table: Callable[[str], DataFrame]) -> dict:
    prepare(spark, out)
    counts = {}
    for side in views.sides(which):
        write_wide(table(side), f"{out}/tactile_{side}", single=True)
        counts[side] = spark.read.option("header", True).csv(f"{out}/tactile_{side}").count()
    write_document(spark, f"{out}/summary.json", {"rows": counts})
    return counts


def raw_csv(spark: SparkSession, root: str, out: str, side: str = "both", start: int = 0, limit: int | None = None) -> dict:
    """Wide CSV of a raw dataset's sensor vectors, a folder for each side."""
    info = readers.read_json(spark, f"{root}/{INFO}")
    stores = _stores(spark, root, info)

    def table(which: str) -> DataFrame:
        path = f"{root}/tactile/tactile_{which}/meta.jsonl"
        log = readers.read_log_by(spark, path, schemas.METADATA_LOG, "zarr_index") if readers.exists(spark, path) else spark.createDataFrame([], schemas.METADATA_LOG)
        layout = log.where("layout is not null").agg(F.min_by("layout", "zarr_index")).first()[0]
        dim = len(stores[which].first()["data"])
        return views.raw_wide(stores[which], log, which, dim, info.get("tactile_msg_package"), layout, start, limit)

    return _write_sides(spark, out, side, table)


def export_csv(spark: SparkSession, root: str, out: str, side: str = "both", start: int = 0, limit: int | None = None) -> dict:
    """Wide CSV of an export's sensor vectors, a folder for each side."""
    rows, _, info = _exported(spark, root)
    return _write_sides(spark, out, side, lambda s: views.export_wide(rows, s, info["features"][f"observation.tactile_{s}"]["shape"][0], start=start, limit=limit))


def main(args: list[str] | None = None) -> int:
    top = argparse.ArgumentParser(prog="tidegrid", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, **options: dict) -> None:
        one = commands.add_parser(name)
        for option, how in options.items():
            one.add_argument("--" + option.replace("_", "-"), **how)

    place, whole = {"required": True}, {"type": int}
    wide = {"root": place, "out": place, "side": {"default": "both", "choices": ["left", "right", "both"]}, "start": {"type": int, "default": 0}, "limit": whole}
    command("check", root=place, sample_images={"type": int, "default": 5}, strict={"action": "store_true"})
    command("merge", raw_root={"action": "append", "required": True}, out_root=place, overwrite={"action": "store_true"})
    command("export", raw_root=place, out_root=place, fps={"type": float}, task={}, split_on_gap={"action": "store_true"}, gap_factor={"type": float, "default": 1.5}, overwrite={"action": "store_true"})
    command("validate", root=place, raw_root={})
    command("inspect", root=place, index=whole, episode=whole, frame=whole)
    command("raw-csv", **wide)
    command("export-csv", **wide)
    given = vars(top.parse_args(args))
    name = given.pop("command")
    spark = SparkSession.builder.appName(f"tidegrid {name}").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    strict = given.pop("strict", False)
    if name == "merge":
        given["roots"] = given.pop("raw_root")
    run = {"check": check_dataset, "merge": merge_datasets, "export": export_dataset, "validate": validate_dataset, "inspect": inspect_row, "raw-csv": raw_csv, "export-csv": export_csv}[name]
    result = run(spark, **given)
    if isinstance(result, dict):
        print(json.dumps(result, indent=2, ensure_ascii=False))
        return 0
    found = result.collect()
    for row in found:
        print(json.dumps(row.asDict(recursive=True), ensure_ascii=False))
    return int(name in ("check", "validate") and any(r["level"] == "error" or (strict and r["level"] != "skipped") for r in found))


__all__ = ["check_dataset", "export_csv", "export_dataset", "inspect_row", "main", "merge_datasets", "raw_csv", "validate_dataset"]
