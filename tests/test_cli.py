from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tests.images import PLAIN
from tests.test_plans import raw_rows
from tidegrid import cli
from tidegrid.sources import readers, schemas


def dataset(spark, root, episodes=((0, 4), (1, 3))):
    """A sound raw dataset on disk."""
    rows = raw_rows(spark, episodes, root=str(root / "image" / "front")).withColumn("wrist_image.path", F.regexp_replace("`wrist_image.path`", "/image/front/", "/image/wrist/"))
    rows.coalesce(1).write.parquet(str(root / "data/chunk-000/file-000.parquet"))
    for e, _ in episodes:
        rows.where(F.col("episode_index") == e).orderBy("frame_index").coalesce(1).write.parquet(str(root / f"data/episodes/episode_{e:06d}.parquet"))
    n = sum(m for _, m in episodes)
    for side in ("left", "right"):
        z = root / f"tactile/tactile_{side}/data.zarr"
        z.mkdir(parents=True)
        import numpy as np

        (z / ".zarray").write_text(json.dumps({"zarr_format": 2, "shape": [n, 2], "chunks": [n, 2], "dtype": "<f4", "compressor": None, "fill_value": 0, "order": "C", "filters": None}))
        (z / "0.0").write_bytes(np.arange(2 * n, dtype="<f4").tobytes())
    (root / "meta").mkdir()
    (root / "meta/episodes.jsonl").write_text("".join(json.dumps({"episode_index": e, "num_frames": m}) + "\n" for e, m in episodes))
    (root / "meta/info.json").write_text(json.dumps({"fps": 10, "state_dim": 7, "action_dim": 7, "dataset_type": "t", "task_description": "pick"}))
    for camera, letter in (("front", "i"), ("wrist", "w")):
        (root / "image" / camera).mkdir(parents=True)
        for i in range(n):
            (root / "image" / camera / f"{letter}{i}.png").write_bytes(PLAIN)
    return str(root)


def test_check(spark, tmp_path):
    root = dataset(spark, tmp_path / "a")
    assert cli.check_dataset(spark, root).collect() == []
    (tmp_path / "a/meta/episodes.jsonl").write_text('{"episode_index": 0, "num_frames": 4}\n{bad\n')
    (tmp_path / "a/image/front/i2.png").unlink()
    assert {r["rule"] for r in cli.check_dataset(spark, root).collect()} == {"episode log", "episode not in log", "image missing"}


def test_merge_export_validate_inspect_csv(spark, tmp_path, capsys):
    a, b = dataset(spark, tmp_path / "a"), dataset(spark, tmp_path / "b", ((0, 2),))
    (tmp_path / "a/meta/config.yaml").write_text("fps: 10\n")
    (tmp_path / "b/tactile/tactile_left/meta.jsonl").write_text(json.dumps({"zarr_index": 1, "sensor_id": "s1", "episode_index": 0, "frame_index": 1}) + "\n")
    totals = cli.merge_datasets(spark, [a, b], str(tmp_path / "m"))
    assert (totals["total_frames"], totals["total_episodes"]) == (9, 3)
    merged = str(tmp_path / "m")
    assert readers.read_json(spark, f"{merged}/meta/info.json")["merge_sources"][1]["from_index"] == 7
    with pytest.raises(FileExistsError):
        cli.merge_datasets(spark, [a, b], merged)
    assert cli.check_dataset(spark, merged).collect() == []
    assert sorted(p.name for p in (tmp_path / "m/data/episodes").glob("*.parquet")) == [f"episode_{i:06d}.parquet" for i in range(3)]
    assert (tmp_path / "m/image/wrist/episode_000002/frame_000001.png").read_bytes() == PLAIN and (tmp_path / "m/meta/config.yaml").exists()
    meta = readers.read_log_by(spark, f"{merged}/tactile/tactile_left/meta.jsonl", schemas.METADATA_LOG, "zarr_index").orderBy("zarr_index").collect()
    assert [(r["zarr_index"], r["episode_index"], r["frame_index"], r["sensor_id"]) for r in meta][-2:] == [(7, 2, 0, None), (8, 2, 1, "s1")]
    log = spark.read.schema(schemas.EPISODE_LOG).json(f"{merged}/meta/episodes.jsonl").orderBy("episode_index").collect()
    assert (log[2]["source_raw_root"], log[2]["source_episode_path"], log[2]["image_dir"]) == (b, "data/episodes/episode_000000.parquet", "image/front/episode_000002")
    assert readers.read_json(spark, f"{merged}/meta/merge_sources.json")["sources"][1]["raw_root"] == b
    assert cli.export_dataset(spark, merged, str(tmp_path / "me"))["total_frames"] == 9
    assert {r["level"] for r in cli.validate_dataset(spark, str(tmp_path / "me"), merged).collect()} == {"skipped"}
    out = cli.export_dataset(spark, a, str(tmp_path / "e"))
    assert out["total_frames"] == 7
    told = cli.validate_dataset(spark, str(tmp_path / "e"), a).collect()
    assert [r["level"] for r in told] == ["skipped", "skipped"]
    for side in ("left", "right"):
        (tmp_path / "a/tactile" / f"tactile_{side}/data.zarr/0.0").write_bytes(bytes(4 * 14))
    assert [r["rule"] for r in cli.validate_dataset(spark, str(tmp_path / "e"), a).collect() if r["level"] == "error"] == ["raw rows"]
    (tmp_path / "e/meta/tasks.parquet").rename(tmp_path / "tasks")
    assert [r["rule"] for r in cli.validate_dataset(spark, str(tmp_path / "e")).collect()] == ["required files"]
    (tmp_path / "tasks").rename(tmp_path / "e/meta/tasks.parquet")
    row = cli.inspect_row(spark, str(tmp_path / "e"), episode=1, frame=2).where("column = 'observation.tactile_left'").first()
    assert (row["index"], row["first"]) == (6, [12.0, 13.0])
    assert cli.raw_csv(spark, b, str(tmp_path / "c0"), "left") == {"left": 2}
    assert cli.raw_csv(spark, a, str(tmp_path / "c1"), "left", 2, 3) == {"left": 3}
    assert cli.export_csv(spark, str(tmp_path / "e"), str(tmp_path / "c2")) == {"left": 7, "right": 7}
