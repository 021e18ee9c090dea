from __future__ import annotations


import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.functions import profiles
from tidegrid.functions.columns import c
from tidegrid.plans import check, export, inspect, merge, record, validate
from tidegrid.sinks import writers
from tidegrid.sources import readers, schemas


def raw_rows(spark, episodes=((0, 4), (1, 3)), gap_at=None, root="/data"):
    """A sound small dataset: rows as a recording writes them, in episode order."""
    rows, index = [], 0
    for e, n in episodes:
        for f in range(n):
            late = 5.0 if gap_at is not None and f >= gap_at else 0.0
            rows.append((f / 10 + late, f, e, index, 0, [0.1 * f] * 7, [0.2] * 7, [0.0] * 6 + [1.0, 0.5], f"{root}/i{index}.png", f"{root}/w{index}.png", 4, 6, 4, 6, index, index, 2, 2, "float32", "float32", *[0.01] * 6))
            index += 1
    schema = "`timestamp` double, `frame_index` long, `episode_index` long, `index` long, `task_index` long, `observation.state` array<double>, `action` array<double>, `action.sent_action8` array<double>, `image.path` string, `wrist_image.path` string, `image.height` long, `image.width` long, `wrist_image.height` long, `wrist_image.width` long, `tactile.left.zarr_index` long, `tactile.right.zarr_index` long, `tactile.left.data_len` long, `tactile.right.data_len` long, `tactile.left.data_dtype` string, `tactile.right.data_dtype` string, " + ", ".join(f"`{n}` double" for n in schemas.REQUIRED[-6:])
    return spark.createDataFrame(rows, schema)


def store(spark, n, dim=2):
    return spark.createDataFrame([(i, [float(i)] * dim) for i in range(n)], "store_index long, data array<float>")


def logs(spark, master):
    log = spark.createDataFrame([(0, 4), (1, 3)], "episode_index long, num_frames long")
    files = spark.createDataFrame([(0, 0, 4, True), (1, 1, 3, True)], "episode_index long, file_episode long, num_rows long, contiguous boolean")
    images = {}
    for camera, letter in (("image", "i"), ("wrist_image", "w")):
        images[camera] = spark.createDataFrame([(f"/data/{letter}{i}.png", 6, 4, True) for i in range(7)], "path string, width long, height long, rgb8 boolean")
    return {"log": log, "files": files, "images": images, "stores": {s: (store(spark, 7), "float32") for s in ("left", "right")}}


INFO = {"state_dim": 7, "action_dim": 7}


def test_sound_dataset_has_no_findings(spark):
    master = raw_rows(spark)
    assert check.check(master, INFO, **logs(spark, master)).collect() == []


def _with(df, name, value):
    return df.withColumn(name, value)


DEFECTS = {
    "index": lambda m: m.withColumn("index", F.when(F.col("index") == 3, 9).otherwise(F.col("index"))),
    "frame_index": lambda m: m.withColumn("frame_index", F.when(F.col("index") == 2, 7).otherwise(F.col("frame_index"))),
    "vector action": lambda m: m.withColumn("action", F.when(F.col("index") == 2, F.slice("action", 1, 6)).otherwise(F.col("action"))),
    "vector observation.state": lambda m: m.withColumn("observation.state", F.when(F.col("index") == 2, F.transform(c("observation.state"), lambda v: F.lit(float("nan")))).otherwise(c("observation.state"))),
    "columns": lambda m: m.drop("task_index"),
    "image path": lambda m: m.withColumn("image.path", F.when(F.col("index") != 1, c("image.path"))),
    "image missing": lambda m: m.withColumn("image.path", F.when(F.col("index") == 1, F.lit("/no.png")).otherwise(c("image.path"))),
    "wrist_image size": lambda m: m.withColumn("wrist_image.width", F.lit(9)),
    "tactile.left index": lambda m: m.withColumn("tactile.left.zarr_index", F.when(F.col("index") != 1, c("tactile.left.zarr_index"))),
    "tactile.left range": lambda m: m.withColumn("tactile.left.zarr_index", c("tactile.left.zarr_index") + 1),
    "tactile.right unique": lambda m: m.withColumn("tactile.right.zarr_index", F.lit(2)),
    "tactile.right length": lambda m: m.withColumn("tactile.right.data_len", F.lit(3)),
    "tactile.left type": lambda m: m.withColumn("tactile.left.data_dtype", F.lit("uint8")),
}


@pytest.mark.parametrize("rule", list(DEFECTS))
def test_each_defect_is_found_alone(spark, rule):
    master = DEFECTS[rule](raw_rows(spark))
    found = check.check(master, INFO, **logs(spark, master)).collect()
    assert {r["rule"] for r in found} == {rule}
    assert all(r["level"] == ("warning" if rule.endswith("unique") else "error") for r in found)


def test_log_defects(spark):
    master = raw_rows(spark)
    log = spark.createDataFrame([(0, 4), (1, 2), (5, 1)], "episode_index long, num_frames long")
    files = spark.createDataFrame([(0, 0, 4, False), (1, 2, 3, True)], "episode_index long, file_episode long, num_rows long, contiguous boolean")
    found = {r["rule"] for part in check.check_log(master, log, files) for r in part.collect()}
    assert found == {"episode file missing", "episode rows", "foreign episode", "episode contiguity"}


def test_packed_layout(spark):
    shapes = profiles.segments(profiles.PACKED_V1)
    fields = {f"tactile.left.{s['segment']}_{f}": s[k] for s in shapes for f, k in (("start", "start"), ("len", "length"), ("height", "height"), ("width", "width"), ("channels", "channels"), ("itemsize", "itemsize"))}
    good = raw_rows(spark).withColumns({n: F.lit(v) for n, v in fields.items()} | {"tactile.left.schema_version": F.lit(1), "tactile.left.packed_frame_bytes": F.lit(1_920_000)})
    rules = lambda m, w=1_920_000: {r["rule"].removeprefix("tactile.left packed ") for part in check.check_packed(m, "left", w) for r in part.collect()}
    assert rules(good) == set()
    assert rules(good, 5) == {"size"}
    assert rules(good.withColumn("tactile.left.shear_start", F.lit(7))) == {"offset"}
    assert rules(good.withColumn("tactile.left.depth_len", F.lit(7))) == {"length", "size"}
    assert rules(good.withColumn("tactile.left.schema_version", F.lit(3))) == {"version"}
    assert rules(good.drop("tactile.left.depth_len")) == {"columns"}
    assert "layout" in rules(good.withColumn("tactile.left.normal_start", F.when(F.col("index") > 2, 1).otherwise(c("tactile.left.normal_start"))))


def test_profile_expectations_warn(spark):
    found = [r for part in check.check_store(raw_rows(spark), store(spark, 7), "left", "float32", profiles.FORCE_PACKAGE) for r in part.collect()]
    assert {(r["rule"], r["level"]) for r in found} == {("tactile.left profile size", "warning"), ("tactile.left profile type", "warning")}


def test_export_validate_and_read_back(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    master = raw_rows(spark, gap_at=2)
    for e in (0, 1):
        master.where(F.col("episode_index") == e).orderBy("frame_index").coalesce(1).write.parquet(f"{raw}/data/episodes/episode_{e:06d}.parquet")
    writers.write_document(spark, f"{raw}/meta/info.json", {"fps": 10, "task_description": "pick"})
    stores = {"left": store(spark, 7), "right": store(spark, 7, 3)}
    how = export.Export(10.0, "pick", split_on_gap=True)
    totals = export.export(spark, raw, out, stores, how)
    assert (totals["total_frames"], totals["total_episodes"]) == (7, 4)
    rows, episodes = readers.read_chunks(spark, out), spark.read.parquet(f"{out}/meta/episodes/chunk-000/file-000.parquet")
    dims = {"observation.state": 7, "action": 7, "observation.tactile_left": 2, "observation.tactile_right": 3}
    info = readers.read_json(spark, f"{out}/meta/info.json")
    assert validate.validate(rows, episodes, info, dims).collect() == []
    assert [r["frame_index"] for r in rows.orderBy("index").collect()] == [0, 1, 0, 1, 0, 1, 0]
    import pyarrow.parquet as pq

    file = readers.matches(spark, f"{out}/data/chunk-000/file-*.parquet")[0].removeprefix("file:")
    assert str(pq.read_schema(file).field("action").type).startswith("fixed_size_list<")
    assert episodes.columns[:9] == ["episode_index", "tasks", "length", "from", "to", "dataset_from_index", "dataset_to_index", "data/chunk_index", "data/file_index"] and "videos/observation.images.wrist/to_timestamp" in episodes.columns
    assert episodes.orderBy("episode_index").first()["raw_episode"] == "data/episodes/episode_000000.parquet"
    import pandas as pd

    assert pd.read_parquet(f"{out}/meta/tasks.parquet").to_dict() == {"task_index": {"pick": 0}}
    assert validate.vector_types(spark, readers.matches(spark, f"{out}/data/chunk-000/file-*.parquet"), dims).collect() == []
    wrong = validate.vector_types(spark, readers.matches(spark, f"{out}/data/chunk-000/file-*.parquet"), dims | {"action": 8}).collect()
    assert [r["rule"] for r in wrong] == ["vector type action"]
    shifted = episodes.withColumn("from", F.col("from") + 1).withColumn("dataset_to_index", F.col("dataset_from_index"))
    assert {"episode from and to", "episode empty"} <= {r["rule"] for r in validate.validate(rows, shifted, info, dims).collect()}
    stats = readers.read_json(spark, f"{out}/meta/stats.json")
    assert stats["observation.tactile_right"]["mean"] == [3.0] * 3 and stats["action"]["count"] == [7]
    with pytest.raises(FileExistsError):
        export.export(spark, raw, out, stores, how)
    again = readers.read_episodes(spark, raw)
    compared = validate.against_raw(rows, episodes, again, {"action": "action", "observation.state": "observation.state"}).collect()
    assert all(r["close"] and r["max_diff"] < 1e-6 and r["values"] == 49 and not r["unmatched"] for r in compared)
    assert inspect.locate(rows, episodes, episode=2, frame=1).first()["index"] == 5
    with pytest.raises(ValueError):
        inspect.locate(rows, episodes, episode=2, frame=2)
    assert inspect.summary(rows, ["action"]).count() == 7
    wide = inspect.export_wide(rows, "left", 2, start=1, limit=3)
    assert wide.columns == [*schemas.EXPORT_META, "value_000", "value_001"] and wide.count() == 3


@pytest.mark.parametrize(
    ("rule", "spoil"),
    [
        ("total frames", lambda r: r.where("index < 6")),
        ("vector action", lambda r: r.withColumn("action", F.slice("action", 1, 3))),
        ("timestamp", lambda r: r.withColumn("timestamp", F.col("timestamp") + 1)),
        ("episode range", lambda r: r.withColumn("episode_index", F.when(F.col("index") == 2, 1).otherwise(F.col("episode_index")))),
        ("columns", lambda r: r.drop("timestamp")),
    ],
)
def test_validation_finds(spark, rule, spoil):
    raw = raw_rows(spark).withColumn("raw_episode", F.col("episode_index").cast("string"))
    built = export.build(raw, {"left": store(spark, 7), "right": store(spark, 7)}, export.Export(10.0))
    dims = {"observation.state": 7, "action": 7, "observation.tactile_left": 2, "observation.tactile_right": 2}
    info = {"total_frames": 7, "total_episodes": 2, "fps": 10}
    assert validate.validate(built.rows, built.episodes, info, dims).collect() == []
    assert rule in {r["rule"] for r in validate.validate(spoil(built.rows), built.episodes, info, dims).collect()}


def test_long_episodes_need_float_comparison(spark):
    rows = spark.range(3001).select(F.col("id").alias("index"), F.lit(0).alias("episode_index"), F.col("id").alias("frame_index"), (F.col("id") / 10.0).cast("float").alias("timestamp"), F.lit(0).alias("task_index"), *[F.array(F.lit(0.0)).alias(n) for n in schemas.EXPORT_VECTORS])
    episodes = spark.createDataFrame([(0, 3001, 0, 3001, 0, 3001, 0, ["t"])], "episode_index int, length long, from long, to long, dataset_from_index long, dataset_to_index long, task_index long, tasks array<string>")
    info, dims = {"total_frames": 3001, "total_episodes": 1, "fps": 10}, dict.fromkeys(schemas.EXPORT_VECTORS, 1)
    assert validate.validate(rows, episodes, info, dims).collect() == []
    assert [r["count"] for r in validate.validate(rows, episodes, info, dims, as_float=False).collect()] == [176]


def test_merge(spark):
    a, b = raw_rows(spark), raw_rows(spark, ((0, 2),)).withColumn("extra", F.lit(1))
    info = {"dataset_type": "t", "tactile_msg_package": "p", "fps": 10, "state_dim": 7, "action_dim": 7}
    rows, stores = merge.merge([a, b], [{s: store(spark, n) for s in ("left", "right")} for n in (7, 2)], [info, dict(info)])
    got = rows.orderBy("index").select("index", "episode_index", "frame_index", "source").collect()
    assert [tuple(r) for r in got][-3:] == [(6, 1, 2, 0), (7, 2, 0, 1), (8, 2, 1, 1)]
    assert [r["data"][0] for r in stores["left"].orderBy("store_index").collect()] == [0, 1, 2, 3, 4, 5, 6, 0, 1]
    assert [tuple(r) for r in merge.source_totals(rows).orderBy("source").collect()] == [(0, 7, 2, 0, 7, 0, 2), (1, 2, 1, 7, 9, 2, 3)]
    with pytest.raises(ValueError, match="fps"):
        merge.merge([a, b], [], [info, info | {"fps": 30}])
    with pytest.raises(ValueError, match="not in the store"):
        merge.merge([a, b], [{s: store(spark, 3) for s in ("left", "right")}] * 2, [info, info])
    placed = merge.place_images(rows, ["/data", "/b"], {"image": "image/front", "wrist_image": "image/wrist"})
    logs = [spark.createDataFrame([(9, 9, "/data/i1.png", 1, "topic")], "episode_index long, record_frame_index long, path string, height long, topic string").selectExpr(*[f"CAST({n if n in ('episode_index', 'record_frame_index', 'path', 'height', 'topic') else 'NULL'} AS {k}) AS {n}" for n, k in (f.split() for f in schemas.IMAGE_LOG.split(", "))])]
    out = merge.image_log(placed, logs, "image").collect()
    assert [r["path"] for r in out][-1] == "image/front/episode_000002/frame_000001.png" and len(out) == 9
    assert (out[1]["episode_index"], out[1]["record_frame_index"], out[1]["height"], out[1]["topic"]) == (0, 1, 4, "topic") and out[0]["topic"] is None
    meta = merge.sensor_log(placed, [], "left", "tactile/tactile_left/data.zarr").collect()
    assert [r["zarr_index"] for r in meta] == list(range(9)) and meta[8]["frame_index"] == 1


def test_record(spark):
    episodes = spark.createDataFrame([(0, 0.0, 0.5)], "episode_index int, start double, end double")
    unit = [0.0, 0, 0, 0, 0, 0, 1]

    def stream(fields, rows):
        return spark.createDataFrame([(0, t, i, *v) for i, (t, *v) in enumerate(rows)], f"episode_index int, t double, seq long, {fields}")

    action = stream("action8 array<double>, target_gripper double", [(k / 10, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 2.0, 0.3], 0.7) for k in range(4)])
    streams = {
        "image": (stream("path string", [(k / 10 + 0.01, f"i{k}") for k in range(5)]), ["path"]),
        "wrist_image": (stream("path string", [(k / 10, f"w{k}") for k in range(5)]), ["path"]),
        "action": (action, ["action8", "target_gripper"]),
        "state": (stream("pose array<double>, width double", [(k / 10, [float(v) for v in unit], 0.05) for k in range(5)]), ["pose", "width"]),
        "vr": (stream("enabled boolean", [(9.0, True)]), ["enabled"]),
        "enabled": (stream("enabled boolean", [(0.0, False), (0.15, True)]), ["enabled"]),
        "tactile_left": (stream("data_len int", [(k / 10, 25) for k in range(5)]), ["data_len"]),
        "tactile_right": (stream("data_len int", [(k / 10, 25 if k != 2 else 24) for k in range(5)]), ["data_len"]),
    }
    rows, rejected = record.record(episodes, streams)
    assert {r["candidate_index"]: r["reason"] for r in rejected.collect()} == {0: "enabled false or missing", 2: "left and right lengths differ", 4: "action not in time"}
    kept = rows.orderBy("candidate_index").collect()
    assert [(r["candidate_index"], r["frame_index"]) for r in kept] == [(1, 0), (3, 1)]
    assert np.allclose(kept[0]["action"], [1, 0, 0, 0, 0, 0, 0.7]) and np.allclose(kept[0]["action.sent_action8"][3:7], [0, 0, 0, 1])
    assert record.Recording().lateness == 0.2


def test_state_keys_by_presence(spark):
    log = spark.createDataFrame([("state", True, None, None, None, 1.0, 2.0, None, s) for s in ('{"pose":null,"pos":[1,2,3,4,5,6,7]}', '{"pos":[1,2,3,4,5,6,7,8],"gripper":[0.4]}', '{"ee_pose":[1],"gripper_pos":0.2}')], schemas.STATE_LOG)
    got = record.parse_states(log).collect()
    assert [r["pose"] for r in got] == [None, [1, 2, 3, 4, 5, 6, 7], [1]] and [r["width"] for r in got] == [None, 0.4, 0.2]


def test_logs_images_arrays_and_stores(spark, tmp_path):
    log = tmp_path / "a.jsonl"
    log.write_text('{"k": 1, "v": "a"}\n{bad\n\n{"k": 1, "v": "b"}\n{"k": 2, "v": null}\n')
    tolerant = readers.read_log_tolerant(spark, str(log), "k long, v string").orderBy("line").collect()
    assert [(r["line"], r["value"] and r["value"]["v"], r["error"]) for r in tolerant] == [(1, "a", None), (2, None, "{bad"), (4, "b", None), (5, None, None)]
    with pytest.raises(Exception):  # noqa: B017
        readers.read_log(spark, str(log), "k long, v string").collect()
    log.write_text('{"k": 1, "v": "a"}\n{"k": 2, "v": "c"}\n{"k": 1, "v": "b"}\n')
    assert sorted(tuple(r) for r in readers.read_log_by(spark, str(log), "k long, v string", "k").collect()) == [(1, "b"), (2, "c")]

    path = str(tmp_path / "store")
    spark.range(4).write.parquet(path)

    def fail(draft):
        spark.range(3).write.parquet(draft)
        raise RuntimeError

    with pytest.raises(RuntimeError):
        writers.publish(spark, path, fail, overwrite=True)
    assert spark.read.parquet(path).count() == 4 and len(list(tmp_path.glob(".store*"))) == 0
    assert readers.settings({"zed_image": "x", "sync": {"max_cloud_dt_sec": 1}}, {"image": "i", "fps": 10, "sync": {"max_image_dt_sec": 2}}) == {"image": "x", "fps": 10, "sync": {"max_image_dt_sec": 1}}


def test_raw_wide(spark):
    meta = spark.createDataFrame([(1, 0, {"b": 1, "a": 2})], "zarr_index long, episode_index long, layout map<string,long>")
    wide = inspect.raw_wide(store(spark, 3), meta, "left", 2, start=1)
    got = wide.orderBy("zarr_index").collect()
    assert wide.columns == [*schemas.RAW_META, "value_000", "value_001"]
    assert [(r["zarr_index"], r["layout_json"], r["value_001"]) for r in got] == [(1, '{"a":2,"b":1}', 1.0), (2, "{}", 2.0)]
    assert inspect.sides("both") == ("left", "right")
