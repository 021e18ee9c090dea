from __future__ import annotations

import random

import numpy as np
import pytest

from tests.images import PLAIN, SIGNATURE, part, png
from tidegrid.functions.frames import image_difference, image_summary
from tidegrid.plans.check import check_images
from tidegrid.sources import images


def jpeg(width, height, parts=3, depth=8, filling=0):
    table = b"\xff\xdb" + (67).to_bytes(2, "big") + bytes(65)
    note = b"\xff\xfe" + (5002).to_bytes(2, "big") + bytes(5000)
    frame = b"\xff" * filling + b"\xff\xc2" + (8 + 3 * parts).to_bytes(2, "big") + bytes([depth]) + height.to_bytes(2, "big") + width.to_bytes(2, "big") + bytes([parts]) + bytes(3 * parts)
    return b"\xff\xd8" + b"\xff\xe0\x00\x10" + bytes(14) + note + table + frame + bytes(9000)


@pytest.mark.parametrize("filters", [(0,), (1,), (2,), (3,), (4,), (0, 1, 2), (4, 3, 2, 1, 0)])
def test_every_filter_and_colour_type(filters):
    rng = np.random.default_rng(3)
    for kind, size in ((0, 1), (2, 3), (4, 2), (6, 4)):
        for shape in ((1, 1), (1, 9), (9, 1), (7, 11), (12, 5)):
            a = rng.integers(0, 256, (*shape, size), dtype=np.uint8)
            want = np.repeat(a[:, :, :1], 3, axis=2) if size < 3 else a[:, :, :3]
            assert (images.decode_png(png(a, kind, filters, pieces=2)) == want).all()
    colours = rng.integers(0, 256, (5, 3))
    a = rng.integers(0, 5, (6, 4, 1), dtype=np.uint8)
    assert (images.decode_png(png(a, 3, filters, colours)) == colours[a[:, :, 0]]).all()


def test_damaged_and_unsupported_files_are_errors():
    a = np.zeros((2, 2, 3), dtype=np.uint8)
    broken = bytearray(PLAIN)
    broken[45] ^= 1
    short = SIGNATURE + part(b"IHDR", (2).to_bytes(4, "big") * 2 + bytes([8, 2, 0, 0, 0])) + part(b"IDAT", __import__("zlib").compress(bytes(5))) + part(b"IEND", b"")
    for raw in (b"", b"nothing", PLAIN[:40], PLAIN[:-12], bytes(broken), png(a, depth=16), png(a, interlaced=1), png(a[:, :, :1] + 3, 3, colours=[[0, 0, 0]]), short):
        with pytest.raises((ValueError, OSError)):
            images.decode_png(raw)


def files(tmp_path):
    made = {"a.png": PLAIN + bytes(100_000), "b.png": b"nothing", "c.png": png(np.zeros((3, 5, 4), np.uint8), 6), "d.jpg": jpeg(640, 480), "e.jpg": jpeg(7, 9, 1, filling=3), "f.jpg": b"\xff\xd8\xff\xe0", "g.png": b"x"}
    for name, raw in made.items():
        (tmp_path / name).write_bytes(raw)
    return tmp_path


def test_headers_are_read_by_ranges(spark, tmp_path):
    root = files(tmp_path)
    listed = images.list_images(spark, str(root))
    assert listed.count() == 7 and "content" not in listed._jdf.queryExecution().executedPlan().toString()
    got = {r["path"][-5:]: r for r in images.probe_images(listed.unionByName(spark.createDataFrame([("/no/where.png", 1), (None, 1)], "path string, length long"))).collect() if r["path"]}
    told = {n: (r["format"], r["width"], r["height"], r["rgb8"]) for n, r in got.items()}
    none = (None, None, None, None)
    assert told == {"a.png": ("png", 6, 4, True), "b.png": none, "c.png": ("png", 5, 3, False), "d.jpg": ("jpeg", 640, 480, True), "e.jpg": ("jpeg", 7, 9, False), "f.jpg": none, "g.png": none, "e.png": none}
    assert max(r["bytes_read"] for r in got.values()) <= 100  # of files of 100,000 and 14,000 bytes


def test_pixels_summaries_and_differences(spark, tmp_path):
    rng = np.random.default_rng(1)
    a = rng.integers(0, 200, (5, 4, 3), dtype=np.uint8)
    for name, pixels in (("a", a), ("b", a + 7), ("c", a[:, :, ::-1])):
        (tmp_path / f"{name}.png").write_bytes(png(pixels, filters=(4, 1)))
    (tmp_path / "d.png").write_bytes(b"x")
    rows = spark.createDataFrame([(str(tmp_path / f"{n}.png"),) for n in "abcd"] + [(None,)], "path string")
    read = {r["path"] and r["path"][-5:]: r for r in images.read_pixels(rows).withColumn("s", image_summary("rgb")).collect()}
    assert read["a.png"]["rgb"] == a.tobytes() and (read["a.png"]["height"], read["a.png"]["width"]) == (5, 4)
    assert (read["b.png"]["s"]["max"], read["b.png"]["s"]["mean"]) == (int(a.max()) + 7, float((a + 7).mean()))
    assert read["d.png"]["rgb"] is None and read["d.png"]["problem"] == "not a PNG" and read[None]["problem"]
    one = images.read_pixels(rows.limit(1)).selectExpr("rgb AS x").crossJoin(images.read_pixels(rows).selectExpr("path", "rgb AS y"))
    out = {r["path"] and r["path"][-5:]: r["d"] for r in one.withColumn("d", image_difference("x", "y")).collect()}
    assert out["a.png"]["mae"] == 0 and out["b.png"]["mae"] == 7 and out["c.png"]["swapped"] and not out["b.png"]["swapped"]


def test_samples_go_by_place_whatever_the_index_holds(spark, tmp_path):
    rng = random.Random(2)
    (tmp_path / "good.png").write_bytes(PLAIN)
    (tmp_path / "bad.png").write_bytes(PLAIN[:-20])
    for index in ([None] * 9, [5] * 9, [rng.randrange(10**6) for _ in range(9)]):
        for name, told in (("good", []), ("bad", ["image format", "image pixels", "image size"])):
            rows = [(i, str(tmp_path / f"{name}.png"), 4 if name == "good" else 5, 6) for i in index]
            master = spark.createDataFrame(rows, "index long, `image.path` string, `image.height` int, `image.width` int")
            from pyspark.sql import functions as F

            listed = images.list_images(spark, str(tmp_path)).withColumn("path", F.regexp_replace("path", "^file:/+", "/"))
            found = [r["rule"] for x in check_images(master, listed, "image", 3) for r in x.collect()]
            assert sorted(found) == [t for t in told if t != "image format"]
