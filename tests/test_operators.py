from __future__ import annotations

import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.functions import columns, frames, geometry, profiles
from tidegrid.operators import folds, lookups, sequences, statistics


def test_gaps_split_only_when_finite_and_larger(spark):
    nan = float("nan")
    df = spark.createDataFrame([("f", i, t) for i, t in enumerate([0.0, 1.0, 2.5, 2.0, nan, 9.0, 12.0])], "f string, i int, t double")
    out = sequences.gap_segments(df, ["f"], ["i"], "t", 1.5).orderBy("i").collect()
    assert [r["segment"] for r in out] == [0, 0, 0, 0, 0, 0, 1]


def test_reindex_and_ranges(spark):
    df = spark.createDataFrame([(s, e, f) for s in (1, 0) for e in range(3) for f in range(s + e + 1)], "s int, e int, f int")
    rows = sequences.reindex(df, ["s", "e"], ["f"]).orderBy("index").collect()
    assert [(r["s"], r["e"], r["f"]) for r in rows] == sorted((r["s"], r["e"], r["f"]) for r in rows)
    assert [r["index"] for r in rows] == list(range(len(rows)))
    assert rows[-1]["episode_index"] == 5 and rows[-1]["frame_index"] == 3


def test_systematic_samples():
    assert sequences.systematic(10, 1) == [0, 9] and sequences.systematic(10, 1, ends=False) == [0]
    assert sequences.systematic(10, 3) == [0, 4, 9] and sequences.systematic(0, 3) == []


def test_sampled_rows_are_those_at_the_places(spark):
    for n, parts in ((0, 2), (1, 3), (10, 4), (23, 5)):
        df = spark.range(n).repartition(parts)
        order = [r["id"] for r in df.collect()]
        for k in (1, 3, 5):
            for ends in (True, False):
                got = [r["id"] for r in sequences.sampled_rows(df, k, ends).collect()]
                assert got == [order[i] for i in sequences.systematic(n, k, ends)]


def test_ranges_join_alike_for_any_block(spark):
    """Uneven, overlapping, empty, reversed and null ranges, against a plain loop."""
    ranges = [(i, i * 10, i * 10 + 7) for i in range(12)] + [(20, 5, 95), (21, 40, 40), (22, 60, 50), (23, None, 9), (24, 3, None), (25, -30, 4), (26, 117, 118)]
    indices = [*range(-35, 130), None]
    want = sorted((x, e) for x in indices for e, a, z in ranges if x is not None and a is not None and z is not None and a <= x < z)
    r = spark.createDataFrame(ranges, "e long, a long, z long")
    rows = spark.createDataFrame([(i,) for i in indices], "i long")
    for block in (None, 1, 7, 16, 1000):
        got = lookups.within(rows, r, "i", "a", "z", block=block).select("i", "e").collect()
        assert sorted((x["i"], x["e"]) for x in got) == want


def test_exact_order_equals_sorting(spark):
    rng = np.random.default_rng(4)
    kinds = [rng.normal(size=3000), np.repeat([1.0, 2.0], [1500, 1500]), np.repeat([0.0, 5.0, 5.5], [2990, 5, 5]), rng.integers(0, 7, 3000) * 1.0, np.exp(rng.normal(size=3000) * 80), np.zeros(3000)]
    df = spark.createDataFrame([[None if i == 7 else float(k[i]) for k in kinds] for i in range(3000)], ", ".join(f"x{j} double" for j in range(len(kinds))))
    ordered = [np.sort(np.delete(k, 7)) for k in kinds]
    asks = [(F.col(f"x{j}"), r) for j in range(len(kinds)) for r in (0, 1, 1498, 1499, 1500, 2988, 2998)]
    want = [float(ordered[j][r]) for j in range(len(kinds)) for r in (0, 1, 1498, 1499, 1500, 2988, 2998)]
    for few, accuracy in ((10_000, 1000), (40, 50), (1, 20)):
        assert statistics.exact_order(df, asks, few, accuracy) == want


def test_distinct_indices_in_and_out_of_range(spark):
    values = [0.0, 0.0, 5.0, 5.5, 5.5, -1.0, 9.0, 32768.0, 32767.0, 40000.0, 1e15, 1e15, None]
    df = spark.createDataFrame([(v,) for v in values], "n double")
    for size in (0, 6, 32768, 10**16):
        assert statistics.distinct_indices(df, F.col("n"), F.lit(size)).first()[0] == 9
    for rows, good in (([], True), ([0, 1, 2], True), ([0, 1, 1], False), ([1, 2, 3], False), ([0, 2, None], False), (list(range(40_000)), True)):
        got = sequences.globally_contiguous(spark.createDataFrame([(r,) for r in rows], "i long"), "i").first()
        assert (got["rows"], got["indices"], got["contiguous"]) == (len(rows), len({r for r in rows if r is not None}), good)


def test_a_cursor_over_spans_equals_a_plain_loop(spark):
    rng = np.random.default_rng(2)
    lengths = {s: [None if x == 0 and s == "b" else int(x) for x in rng.integers(0, 9, 12)] for s in "ab"}
    segments = spark.createDataFrame([(s, i, n) for s, own in lengths.items() for i, n in enumerate(own)], "source string, part long, length long")
    rows = spark.createDataFrame([(s, i, f"{s}{i}", 1) for s in "abc" for i in range(-1, 60) if i % 7], "source string, ordinal long, name string, part long")
    want = []
    for s, own in lengths.items():
        at = 0
        for i, n in enumerate(own):
            want += [(s, i, n, k, f"{s}{at + k}") for k in range(n or 0) if (at + k) % 7 and at + k < 60]
            at += n or 0
    for span in (1, 4, 1 << 16):
        got = lookups.by_cursor(segments, rows, "source", "part", "length", "ordinal", span).select("source", "part", "length", "position", "name").collect()
        assert sorted(map(tuple, got)) == sorted(want)


def test_statistics_skip_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (-3.0,), (float("nan"),), (None,)], "`sync.dt` double")
    r = statistics.column_stats(df, ["sync.dt", "absent"]).collect()
    assert len(r) == 1 and (r[0]["n"], r[0]["mean"], r[0]["p50"], r[0]["max_abs"]) == (2, -1.0, -1.0, 3.0)
    assert statistics.column_stats(df, ["absent"]).count() == 0


def test_rotations(spark):
    quats = [[0, 0, 0, 1], [0, 0, 0, -1], [1, 0, 0, 0], [0.5, 0.5, 0.5, -0.5], [1e-9, 0, 0, 1], [0, 0, 0, 0], [float("nan"), 0, 0, 1]]
    df = spark.createDataFrame([(i, [float(v) for v in q]) for i, q in enumerate(quats)], "i int, q array<double>")
    out = [r["r"] for r in df.withColumn("u", geometry.normalized(F.col("q"))).withColumn("r", geometry.rotation_vector(F.col("u"))).orderBy("i").collect()]
    assert np.allclose(out[0], 0) and np.allclose(out[1], 0) and np.allclose(out[5], 0) and np.allclose(out[6], 0)
    assert math.isclose(np.linalg.norm(out[2]), math.pi) and math.isclose(np.linalg.norm(out[3]), 2 * math.pi / 3)
    back = df.withColumn("u", geometry.normalized(F.col("q"))).select(geometry.from_rotation_vector(geometry.rotation_vector(F.col("u"))).alias("b"), "u").collect()
    assert all(abs(abs(np.dot(r["b"], r["u"])) - 1) < 1e-9 for r in back)


def test_action_round_trip_and_axes(spark):
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(rng.normal(size=7).tolist(), rng.normal(size=7).tolist()) for _ in range(40)], "p array<double>, q array<double>")
    out = df.withColumn("a", geometry.relative_action7(F.col("p"), F.col("q"), F.lit(0.5))).select("p", "q", "a", geometry.apply_action7(F.col("a"), F.col("q")).alias("b")).collect()
    for r in out:
        p, b = np.array(r["p"]), np.array(r["b"])
        assert np.allclose(p[:3], b[:3], atol=1e-5)
        assert abs(abs(p[3:] @ b[3:]) / np.linalg.norm(p[3:]) - 1) < 1e-5
        assert r["a"][6] == 0.5
    m = spark.createDataFrame([([float(v) for v in (0, -1, 0, 4, 1, 0, 0, 5, 0, 0, 1, 6)],)], "m array<double>")
    assert np.allclose(m.select(geometry.matrix_pose(F.col("m"))).first()[0], [4, 5, 6, 0, 0, math.sqrt(0.5), math.sqrt(0.5)])
    pose = spark.createDataFrame([([1.0, 2.0, 3.0, 0.0, 0.0, 0.0, 1.0],)], "p array<double>")
    assert np.allclose(pose.select(geometry.change_axes(F.col("p"))).first()[0], [-3, -1, 2, 0, 0, 0, 1])
    assert np.allclose(pose.select(geometry.relative_to(F.col("p"), F.col("p"))).first()[0], [0, 0, 0, 0, 0, 0, 1])


def test_names_of_values():
    assert profiles.value_names(25)[:2] == ["cap_000", "cap_001"] and profiles.value_names(25)[-1] == "m_prox_000"
    assert profiles.value_names(234)[2:4] == ["force_raw_002", "distribution_raw_000"] and len(profiles.value_names(234)) == 234
    assert profiles.value_names(3) == ["value_000", "value_001", "value_002"]
    assert profiles.value_names(4, layout={"cap_len": 3}) == profiles.plain_names(4)
    assert profiles.value_names(5, "paxini_tactile", layout={"force_raw_start": 1, "force_raw_len": 2})[:3] == ["value_000", "force_raw_000", "force_raw_001"]


def test_scalars(spark):
    df = spark.createDataFrame([("s|fid=1|fid=7", '{"a":1}', ["1", "x"]), ("|fid=1", "3", ["1", "2"]), ("s|fid=-1", "{bad", None)], "f string, j string, v array<string>")
    got = df.select(columns.frame_id(F.col("f")).alias("f"), columns.parse_json(F.col("j")).alias("j"), columns.float_list(F.col("v"), 7).alias("v")).collect()
    assert [(r["f"]["serial"], r["f"]["frame"]) for r in got] == [("s|fid=1", 7), (None, None), (None, None)]
    assert [(r["j"]["kind"], r["j"]["text"]) for r in got] == [("object", '{"a":1}'), ("value", "3"), ("error", "{bad")]
    assert [r["v"] for r in got] == [None, [1.0, 2.0], None]
    v = spark.createDataFrame([([1.0, 2.0],), ([1.0],), (None,), ([1.0, float("inf")],)], "v array<double>")
    assert [r[0] for r in v.select(columns.vector_problem(F.col("v"), 2)).collect()] == [None, "size", "missing", "not_finite"]
    assert v.limit(1).select(columns.three(F.col("v"))).first()[0] == [1.0, 2.0, 0.0]


def test_frames(spark):
    raw = struct.pack(frames.HEADER_FORMAT, b"MAGIC\0\0\0", 1, frames.HEADER_BYTES, 2**63 + 5, 4, 9, 100, 201, 8)
    torn = struct.pack(frames.HEADER_FORMAT, b"MAGIC\0\0\0", 1, frames.HEADER_BYTES, 1, 5, 9, 100, 200, 8)
    df = spark.createDataFrame([(bytearray(raw),), (bytearray(torn),), (bytearray(b"x"),), (None,)], "raw binary")
    got = [r["h"] for r in df.select(frames.header_parser(b"MAGIC\0\0\0", 1, 8)("raw").alias("h")).collect()]
    assert (int(got[0]["session"]), got[0]["mid_ns"], got[0]["error"]) == (2**63 + 5, 150, None)
    assert [g["error"] for g in got[1:]] == ["torn", "short", "short"]
    image = spark.createDataFrame([("bgr8", 1, 2, 8, bytearray([1, 2, 3, 4, 5, 6, 0, 0])), ("mono8", 1, 2, 2, bytearray([7, 8])), ("yuv", 1, 1, 1, bytearray([1])), ("rgba8", 1, 1, 4, bytearray([1]))], "e string, h int, w int, s int, d binary")
    rgb = [r["x"] for r in image.select(frames.to_rgb8(*[F.col(n) for n in "ehwsd"]).alias("x")).collect()]
    assert bytes(rgb[0]["rgb"]) == bytes([3, 2, 1, 6, 5, 4]) and bytes(rgb[1]["rgb"]) == bytes([7, 7, 7, 8, 8, 8])
    assert [r["error"] for r in rgb[2:]] == ["encoding", "data"]
    rows = image.select(frames.image_rows(F.col("h"), F.col("w"), F.col("s"), 3, F.lit(False), F.col("d")).alias("x")).collect()
    assert bytes(rows[0]["x"]["data"]) == bytes([1, 2, 3, 4, 5, 6]) and rows[1]["x"]["error"] == "step"
    shapes = {"a": (1, 1, 1, 4), "b": (1, 2, 1, 1)}
    packed = spark.createDataFrame([(bytearray(np.float32(1.5).tobytes()), bytearray(b"xy"))], "a binary, b binary").select(frames.pack({"a": F.col("a"), "b": F.col("b")}, shapes).alias("p"))
    back = packed.select(frames.floats(frames.segment(F.col("p"), "a", shapes)).alias("a"), frames.segment(F.col("p"), "b", shapes).alias("b")).first()
    assert back["a"] == [1.5] and bytes(back["b"]) == b"xy"
    with pytest.raises(ValueError):
        frames.pack({"a": F.col("a")}, shapes)


def test_folds(spark):
    df = spark.createDataFrame([("e", i, float(g), 1.0) for i, g in enumerate([1, 1, 0, 0])], "e string, i int, goal double, dt double")
    assert [r["value"] for r in folds.ramp(df, "e", "i", "goal", "dt", 0.4, 0.2, 0.1, 0.9).orderBy("i").collect()] == pytest.approx([0.6, 0.9, 0.5, 0.1])
    sent = folds.rate_limit(df.withColumn("t", F.col("i") * 1.0), "e", "i", "t", 2.0).orderBy("i").collect()
    assert [r["sent"] for r in sent] == [True, False, True, False]
    width = folds.stick_width(df, "e", "i", "goal", "dt", 0.03, 0.04, 0.0, 0.08, 0.5).orderBy("i").collect()
    assert [round(r["width"], 3) for r in width] == [0.07, 0.08, 0.08, 0.08] and [r["changed"] for r in width] == [True, True, False, False]
    turn = [0.0, 0.0, math.sin(0.5), math.cos(0.5)]
    poses = spark.createDataFrame([("e", 0, [0.0] * 6 + [1.0], 1.0, 1.0, True), ("e", 1, [1.0, 0.0, 0.0, *turn], 1.0, 1.0, True), ("e", 2, [9.0, 0.0, 0.0, *turn], 1.0, 1.0, True)], "e string, i int, p array<double>, dt double, s double, on boolean")
    smooth = folds.low_pass(poses, "e", "i", "p", 0.5).orderBy("i").collect()
    assert np.allclose(smooth[1]["smooth"], [0.5, 0, 0, 0, 0, math.sin(0.25), math.cos(0.25)])
    command = folds.integrate(poses, "e", "i", "p", "dt", "s", "on", [0.0] * 6 + [1.0], folds.Integration(high=(2.0, 2.0, 2.0))).orderBy("i").collect()
    assert command[0]["command"] is None and np.allclose(command[1]["command"][:3], [1, 0, 0]) and command[2]["command"][0] == 2.0
