"""Rules over a raw dataset; each is a row: rule, level, count and an example."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import profiles
from ..functions.columns import c, to_number, vector_problem
from ..operators.lookups import missing_columns, reconcile, unmatched
from ..operators.sequences import contiguity, sampled_rows
from ..sources.images import probe_images, read_pixels
from ..sources.schemas import REQUIRED, SIDES, VECTORS

_SCHEMA = "rule string, level string, count long, example string"


def _found(df: DataFrame, rule: str, bad: Column, example: Column, level: str = "error") -> DataFrame:
    """One row if any row is bad."""
    out = df.where(F.coalesce(bad, F.lit(False))).agg(F.count("*").alias("count"), F.min(example.cast("string")).alias("example"))
    return out.where("count > 0").select(F.lit(rule).alias("rule"), F.lit(level).alias("level"), "count", "example")


def _told(spark: SparkSession, rule: str, text: str, n: int = 1, level: str = "error") -> DataFrame:
    return spark.createDataFrame([(rule, level, n, text)], _SCHEMA)


def check_rows(master: DataFrame) -> list[DataFrame]:
    """Columns, indices and vectors of the master table."""
    spark, out = master.sparkSession, []
    absent = missing_columns(master, REQUIRED)
    if absent:
        out.append(_told(spark, "columns", ", ".join(absent), len(absent)))
    if not master.limit(1).count():
        out.append(_told(spark, "empty", "the master table has no rows"))
    if "index" in master.columns:
        n = to_number(c("index"))
        totals = master.agg(F.count("*").alias("rows"), F.min(n).alias("a"), F.max(n).alias("z"), F.count_distinct(n).alias("d"))
        out.append(_found(totals, "index", F.coalesce((F.col("a") != 0) | (F.col("z") != F.col("rows") - 1) | (F.col("d") != F.col("rows")), F.col("rows") > 0), F.format_string("%s..%s", "a", "z")))
    if {"episode_index", "frame_index"} <= set(master.columns):
        order = ["index"] if "index" in master.columns else None
        out.append(_found(contiguity(master, ["episode_index"], "frame_index", order), "frame_index", ~F.col("contiguous"), F.col("episode_index")))
    for name, dim in VECTORS.items():
        if name in master.columns:
            problem = vector_problem(c(name), dim)
            out.append(_found(master, f"vector {name}", problem.isNotNull() & (problem != "missing"), problem))
    return out


def check_log(master: DataFrame, log: DataFrame, files: DataFrame) -> list[DataFrame]:
    """Episode log, episode tables and master rows agree; ``files``: episode_index, file_episode, num_rows and contiguous."""
    rows = master.groupBy("episode_index").agg(F.count("*").alias("n"))
    per_file = files.groupBy("episode_index").agg(F.sum("num_rows").alias("n"))
    sides = {"log": log.select("episode_index", F.col("num_frames").alias("n")), "file": per_file, "master": rows}
    agreed = reconcile(sides, "episode_index", "n")
    totals = rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("master")).crossJoin(per_file.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("files")))  # one row by one row
    return [
        _found(agreed, "episode file missing", F.col("file").isNull() & F.col("log").isNotNull(), F.col("episode_index")),
        _found(agreed, "episode rows", F.col("file") != F.col("log"), F.col("episode_index")),
        _found(agreed, "master rows", F.col("file") != F.coalesce("master", F.lit(0)), F.col("episode_index")),
        _found(agreed, "episode not in log", F.col("log").isNull() & F.col("master").isNotNull(), F.col("episode_index")),
        _found(files, "foreign episode", F.col("file_episode") != F.col("episode_index"), F.col("episode_index")),
        _found(files, "episode contiguity", ~F.col("contiguous"), F.col("episode_index")),
        _found(totals, "total rows", F.col("master") != F.col("files"), F.format_string("%d, %d", "master", "files")),
    ]


def check_images(master: DataFrame, images: DataFrame, camera: str, sample: int = 5) -> list[DataFrame]:
    """Every image exists; sampled ones are 8-bit RGB of the recorded size and have all their pixels.

    ``images`` lists paths, for which no file is opened; headers are read of the sampled ones, unless
    the list has them.  Rows are sampled by their place, whatever ``index`` holds.
    """
    paths = master.select(c(f"{camera}.path").alias("wanted"), c(f"{camera}.height").alias("h"), c(f"{camera}.width").alias("w"), "index")
    absent = unmatched(paths.where("wanted is not null"), images.select(F.col("path").alias("store_index")), "wanted")
    some = sampled_rows(paths, sample).select("wanted", "h", "w")
    if "rgb8" in images.columns:
        found, broken = some.join(images, F.col("wanted") == F.col("path")), []
    else:
        known = some.join(images.select("path"), F.col("wanted") == F.col("path")).select("wanted", "h", "w")
        found = known.join(probe_images(known, "wanted"), F.col("wanted") == F.col("path"))
        pixels = read_pixels(found.where("format = 'png' AND rgb8").select("wanted"), "wanted")
        broken = [_found(pixels, f"{camera} pixels", F.col("problem").isNotNull(), F.concat_ws(": ", "path", "problem"))]
    return [
        _found(paths, f"{camera} path", F.col("wanted").isNull(), F.col("index")),
        _found(absent, f"{camera} missing", F.lit(True), F.col("wanted")),
        _found(found, f"{camera} format", ~F.coalesce("rgb8", F.lit(False)), F.col("path")),
        _found(found, f"{camera} size", (F.col("height") != F.col("h")) | (F.col("width") != F.col("w")), F.col("path")),
        *broken,
    ]


def check_store(master: DataFrame, store: DataFrame, side: str, dtype: str, package: str | None = None) -> list[DataFrame]:
    """Indices into a side's store, and the lengths and types that rows state; ``store``: store_index and data."""
    prefix, spark = f"tactile.{side}", master.sparkSession
    if f"{prefix}.zarr_index" not in master.columns:
        return [_told(spark, f"{prefix} index", "column missing")]
    known = store.agg(F.count("*").alias("size"), F.max(F.size("data")).alias("dim")).first()
    size, dim = known["size"], known["dim"] or 0
    n = to_number(c(f"{prefix}.zarr_index"))
    out = [
        _found(master, f"{prefix} index", n.isNull(), c("index")),
        _found(master, f"{prefix} range", (n < 0) | (n >= size), n),
        _found(master.groupBy(n.alias("n")).agg(F.count("*").alias("times")), f"{prefix} unique", F.col("n").isNotNull() & (F.col("times") > 1), F.col("n"), "warning"),
    ]
    if f"{prefix}.data_len" in master.columns:
        length = to_number(c(f"{prefix}.data_len"))
        out.append(_found(master, f"{prefix} length", length != dim, length))
    if f"{prefix}.data_dtype" in master.columns:
        kind = c(f"{prefix}.data_dtype")
        out.append(_found(master, f"{prefix} type", kind != dtype, kind))
    profile = profiles.PROFILES.get(package or "")
    if profile is not None:
        if profile.dim is not None and profile.dim != dim:
            out.append(_told(spark, f"{prefix} profile size", f"{dim}, not {profile.dim}", level="warning"))
        if profile.dtype != dtype:
            out.append(_told(spark, f"{prefix} profile type", f"{dtype}, not {profile.dtype}", level="warning"))
        if package == profiles.IMAGE_PACKAGE:
            out += check_packed(master, side, dim)
    return out


def check_packed(master: DataFrame, side: str, width: int) -> list[DataFrame]:
    """Layout of packed frames: constant, gapless, as long as its shapes say, and as wide as the store."""
    prefix, spark = f"tactile.{side}", master.sparkSession
    absent = missing_columns(master, [f"{prefix}.schema_version", f"{prefix}.packed_frame_bytes"])
    if absent:
        return [_told(spark, f"{prefix} packed columns", ", ".join(absent))]
    versions = [r[0] for r in master.select(to_number(c(f"{prefix}.schema_version"))).distinct().limit(3).collect() if r[0] is not None]
    if len(versions) != 1:
        return [_told(spark, f"{prefix} packed version", f"{versions}")]
    names = {1: tuple(profiles.PACKED_V1), 2: profiles.PACKED_V2}.get(int(versions[0]))
    if names is None:
        return [_told(spark, f"{prefix} packed version", f"{versions[0]:g} is not known")]
    fields = ("start", "len", "height", "width", "channels", "itemsize")
    column = lambda s, f: f"{prefix}.{s}_{f}"
    absent = missing_columns(master, [column(s, f) for s in names for f in fields])
    if absent:
        return [_told(spark, f"{prefix} packed columns", ", ".join(absent), len(absent))]
    out, at = [], F.lit(0).cast("double")
    number = lambda s, f: to_number(c(column(s, f)))
    usual = profiles.segments(profiles.PACKED_V1)
    layout = master.select(*[number(s, f).alias(f"{s}_{f}") for s in names for f in fields], to_number(c(f"{prefix}.packed_frame_bytes")).alias("total")).distinct()
    kinds = layout.limit(2).count()
    if kinds > 1:
        out.append(_told(spark, f"{prefix} packed layout", "the layout is not constant"))
    for i, s in enumerate(names):
        x = lambda f, s=s: F.col(f"{s}_{f}")
        out.append(_found(layout, f"{prefix} packed offset", x("start") != at, F.lit(s)))
        out.append(_found(layout, f"{prefix} packed length", x("len") != x("height") * x("width") * x("channels") * x("itemsize"), F.lit(s)))
        if names == tuple(profiles.PACKED_V1):
            wrong = reduce(lambda a, b: a | b, [x(f) != usual[i][f] for f in ("height", "width", "channels", "itemsize")])
            out.append(_found(layout, f"{prefix} packed shape", wrong, F.lit(s)))
        at = x("start") + x("len")
    out.append(_found(layout, f"{prefix} packed size", (F.col("total") != at) | (F.col("total") != width), F.col("total")))
    return out


def check(master: DataFrame, info: dict, log: DataFrame, files: DataFrame, images: dict[str, DataFrame], stores: dict[str, tuple[DataFrame, str]], sample: int = 5) -> DataFrame:
    """All findings, errors first; no rows mean a sound dataset."""
    spark = master.sparkSession
    parts = [_told(spark, f"info {k}", f"{info.get(k)}, not 7") for k in ("state_dim", "action_dim") if info.get(k) != 7]
    parts += check_rows(master) + check_log(master, log, files)
    for camera, found in images.items():
        parts += check_images(master, found, camera, sample)
    for side in SIDES:
        if side in stores:
            parts += check_store(master, stores[side][0], side, stores[side][1], info.get("tactile_msg_package"))
        else:
            parts.append(_told(spark, f"tactile.{side} store", "missing"))
    return reduce(DataFrame.unionByName, parts).orderBy("level", "rule", "example")
