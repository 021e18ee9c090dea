from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tidegrid.functions import frames, observations
from tidegrid.plans import media
from tidegrid.sources import readers


def test_camera_and_sensor_columns(spark):
    df = spark.createDataFrame([(1.0, (1.5, 2, 500_000_000, "cam", 4, 6, [1.0], [0.0], "plumb")), (1.0, None)], "tick double, item struct<t:double,sec:long,nanosec:long,frame_id:string,height:int,width:int,k:array<double>,d:array<double>,distortion_model:string>")
    got = df.select(*observations.camera_info(F.col("item"), F.col("tick"), "info")).collect()
    assert (got[0]["info.available"], got[0]["info.dt"], got[0]["info.ros_stamp_float"], got[0]["info.width"]) == (True, 0.5, 2.5, 6)
    assert got[1]["info.available"] is False and got[1]["info.dt"] is None
    kinds = {"zarr_index": "long", "sensor_index": "long", "frame_idx": "long", "capture_time": "double", "repeated": "boolean", "recv_time": "double", "data_len": "long"}
    fields = ",".join(f"{n}:{kinds.get(n, 'string')}" for n in observations.RECORD)
    values = {"long": 3, "double": 0.5, "boolean": False, "string": "s"}
    record = (*[values[kinds.get(n, "string")] for n in observations.RECORD], 2.0, 1, 2, {"cap_len": 16})
    row = spark.createDataFrame([(1.0, record)], f"tick double, r struct<{fields},t:double,sec:long,nanosec:long,layout:map<string,int>>")
    out = row.select(*observations.sensor_fields(F.col("r"), F.col("tick"), "tactile.left", ("cap_len", "nf_len"))).first()
    assert (out["tactile.left.sync_dt"], out["tactile.left.cap_len"], out["tactile.left.nf_len"], out["tactile.left.zarr_index"]) == (1.0, 16, None, 3)


def test_spans_and_policy_inputs(spark):
    df = spark.createDataFrame([(0.0, 5.0), (0.0, None), (0.0, 99.0)], "s double, f double")
    spans = [r[0] for r in df.select(observations.episode_span(F.col("s"), F.col("f"), 30.0, 0.2)).collect()]
    assert [(r["end"], r["drained"]) for r in spans] == [(5.0, 5.2), (30.0, 30.2), (30.0, 30.2)]
    rows = spark.createDataFrame([([1.0] * 7, [0.0, 1.0], [0.0, 1.0], "i"), ([1.0] * 7, [0.0, float("nan")], [0.0], "i")], "`o.state` array<double>, l array<double>, r array<double>, image string")
    out = rows.select(observations.policy_input("o.state", "l", "r", {"front": "image"}).alias("x"))
    problems = out.select(observations.policy_problem(F.col("x"), {"state": 7, "tactile_left": 2, "tactile_right": 2})).collect()
    assert [r[0] for r in problems] == [None, "tactile_left"] and out.first()["x"]["front"] == "i"
    fixed = spark.createDataFrame([([1.0], [0.1, 0.2, 0.3, 0.4])], "x array<double>, r array<double>").select(observations.static_transform(F.col("x"), F.col("r"))).first()[0]
    assert (fixed["xyz"], fixed["rpy"]) == ([1.0, 0.0, 0.0], [0.1, 0.2, 0.3])


def test_images_and_videos(spark):
    image = np.arange(48, dtype=np.uint8).reshape(-1, 3) * 5
    swapped = image[:, ::-1].tobytes()
    df = spark.createDataFrame([(bytearray(image.tobytes()), bytearray(image.tobytes())), (bytearray(image.tobytes()), bytearray(swapped)), (bytearray(b"abc"), None)], "a binary, b binary")
    got = df.select(frames.image_difference("a", "b").alias("d"), frames.image_summary("a").alias("s"))
    rows = got.collect()
    assert (rows[0]["d"]["mae"], rows[0]["d"]["swapped"], rows[1]["d"]["swapped"], rows[2]["d"]["mae"]) == (0.0, False, True, None)
    assert rows[0]["s"]["max"] == image.max() and np.allclose(rows[0]["s"]["channels"], image.mean(axis=0))
    assert media.findings(got).count() == 2
    videos = spark.createDataFrame([("/none.mp4", 3)], "path string, frames long")
    assert media.probe(videos, 10.0).first()["status"] in ("skipped", "error")


def test_settings_and_log_streams(spark, tmp_path):
    (tmp_path / "s.json").write_text('{"fps": 5}')
    assert readers.read_settings(spark, str(tmp_path / "s.json"), {"fps": 10, "a": 1}) == {"fps": 5, "a": 1}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"k": 1}\n{"k": 2}\n')
    query = readers.stream_log(spark, str(tmp_path / "in"), "k long").writeStream.format("memory").queryName("logged").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert [r["k"] for r in spark.table("logged").orderBy("k").collect()] == [1, 2]
