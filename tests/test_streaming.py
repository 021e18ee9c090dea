from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import functions as F

from tests import state
from tidegrid.streaming.stateful import Assembler, AssemblerProcessor, EpisodeCommitter, Ticks, TicksProcessor, assemble_stream, nearest_stream, stale

PARTS = ("a", "b", "c")


def test_assembler_rules():
    work = Assembler(PARTS, most=2)
    assert work.add(5, "a", "1") is None and work.add(5, "a", "2") is None and work.add(5, "b", "x") is None
    assert work.add(5, "c", "y") == (5, {"a": "2", "b": "x", "c": "y"})
    assert work.add(5, "a", "z") is None and not work.waiting  # too late
    for s in (9, 8, 7):
        work.add(s, "a", "1")
    assert sorted(work.waiting) == [8, 9]  # the smallest went


def test_ticks_choose_first_arrived_of_equally_near():
    work = Ticks(0.0, 1.0, 1.0, 3)
    out = [x for t, v in ((0.0, "p"), (1.5, "q"), (0.5, "r"), (3.2, "s")) for x in work.add(t, v)]
    assert [(i, v) for i, _, _, v in out] == [(0, "p"), (1, "q"), (2, "q")]
    assert work.finish()[0][3] == "s"


def _run(spark, tmp_path, df, build, name, schema, batches=3):
    source = tmp_path / "in"
    for i in range(batches):
        df.where(F.floor(F.col("seq") / (1 + 999 // batches)) == i).coalesce(1).write.mode("append").parquet(str(source))
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(str(source))
    query = build(stream).writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.table(name).collect()


def test_assembly_stream_equals_replay(spark, tmp_path):
    rng = random.Random(1)
    rows = [("left", rng.randrange(40), rng.choice(PARTS), f"v{i}", i) for i in range(1000)]
    schema = "side string, stamp long, part string, value string, seq long"
    df = spark.createDataFrame(rows, schema)
    work, expected = Assembler(PARTS), []
    for _, stamp, part, value, _ in rows:
        if found := work.add(stamp, part, value):
            expected.append((found[0], *(found[1][p] for p in PARTS)))
    got = _run(spark, tmp_path, df, lambda s: assemble_stream(s, PARTS), "assembled", schema)
    assert sorted(tuple(r)[1:] for r in got) == sorted(expected) and expected


def test_tick_stream_equals_replay(spark, tmp_path):
    rng = random.Random(2)
    rows = [("k", i / 10 + rng.random(), f"v{i}", i) for i in range(300)]
    schema = "key string, t double, value string, seq long"
    df = spark.createDataFrame(rows, schema)
    work = Ticks(rows[0][1], 0.5, 2.0, 32)
    expected = [x for _, t, v, _ in rows for x in work.add(t, v)]
    got = _run(spark, tmp_path, df, lambda s: nearest_stream(s, 0.5, 2.0, 32), "ticked", schema, batches=1)
    assert sorted((r["candidate_index"], r["value"]) for r in got) == [(x[0], x[3]) for x in expected]


def test_commits_are_idempotent(spark, tmp_path):
    commit = EpisodeCommitter(str(tmp_path))
    schema = "episode_index long, frame_index long, event string, x double"
    first = spark.createDataFrame([(0, 0, None, 1.0), (0, 1, None, 2.0), (1, 0, None, 3.0)], schema)
    second = spark.createDataFrame([(0, 2, None, 4.0), (0, None, "save", None), (1, None, "discard", None)], schema)
    for batch, n in ((first, 0), (second, 1), (second, 1)):
        commit(batch, n)
    assert sorted((r["episode_index"], r["frame_index"]) for r in spark.read.parquet(commit.committed).collect()) == [(0, 0), (0, 1), (0, 2)]


def test_a_discarded_recording_is_never_committed(spark, tmp_path):
    commit = EpisodeCommitter(str(tmp_path))
    schema = "episode_index long, frame_index long, event string, x double, seq long"
    batches = [
        [(0, 0, None, 3.0, 0), (0, 1, None, 4.0, 1), (2, 0, None, 1.0, 2)],
        [(0, None, "discard", None, 0), (0, 0, None, 8.0, 1), (0, 0, None, 9.0, 2)],
        [(0, None, "save", None, 1), (0, 5, None, 7.0, 2), (1, 0, None, 5.0, 3), (1, None, "save", None, 4)],
        [(2, None, "save", None, 0), (1, 0, None, 6.0, 1), (1, None, "discard", None, 2)],
    ]
    for n in (0, 1, 1, 2, 2, 3, 3):
        commit(spark.createDataFrame(batches[n], schema), n)
    rows = spark.read.parquet(commit.committed).collect()
    assert sorted((r["episode_index"], r["frame_index"], r["x"]) for r in rows) == [(0, 0, 9.0), (1, 0, 5.0), (2, 0, 1.0)]
    assert not (tmp_path / "staged/batch=0/episode=0").exists() and (tmp_path / "staged/batch=2/episode=0").exists()


def test_streams_end_by_a_mark_by_length_and_by_idleness(spark, tmp_path):
    schema = "key string, t double, value string, seq long"
    rows = [("marked", i / 2, f"v{i}", i) for i in range(10)] + [("marked", 4.5, None, 10)] + [("long", i / 2, f"w{i}", 20 + i) for i in range(12)]
    df = spark.createDataFrame(rows, schema)
    got = _run(spark, tmp_path, df, lambda s: nearest_stream(s, 0.5, 2.0, 32, longest=3.0), "ended", schema, batches=1)
    by_key = {k: sorted((r["candidate_index"], r["value"]) for r in got if r["key"] == k) for k in ("marked", "long")}
    assert by_key["marked"] == [(i, f"v{i}") for i in range(6)] and by_key["long"] == [(i, f"w{i}") for i in range(6)]


def test_idle_keys_end():
    work, handle = TicksProcessor(1.0, 10.0, 32, None, 50), state.Handle()
    work.init(handle)
    rows = pd.DataFrame({"t": [0.0, 1.0, 2.0], "value": ["a", "b", "c"], "seq": [0, 1, 2]})
    assert len(next(work.handleInputRows(("k",), iter([rows]), state.Now(1)))) == 0 and handle.timers == [1050]
    out = next(work.handleExpiredTimer(("k",), state.Now(1), None))
    assert out["value"].tolist() == ["a", "b", "c"] and not work.grid.exists() and not work.items.held


def test_batches_write_what_comes_and_goes():
    work = TicksProcessor(1.0, 1e6, 4096, None, None)
    work.init(state.Handle())
    frame = lambda lo, hi: iter([pd.DataFrame({"t": [float(i) for i in range(lo, hi)], "value": [f"v{i}" for i in range(lo, hi)], "seq": list(range(lo, hi))})])
    list(work.handleInputRows(("k",), frame(0, 5000), state.Now(0)))
    assert len(work.items.held) == 4096 and work.items.writes == 4096
    work.items.writes = 0
    list(work.handleInputRows(("k",), frame(5000, 5003), state.Now(0)))
    assert work.items.writes == 6 and len(work.items.held) == 4096 and min(work.items.held) == (907,)

    parts = AssemblerProcessor(PARTS, 8)
    parts.init(state.Handle())
    rows = lambda *r: iter([pd.DataFrame(r, columns=["stamp", "part", "value", "seq"])])
    list(parts.handleInputRows(("left",), rows(*[(s, "a", "x", s) for s in range(8)]), state.Now(0)))
    parts.waiting.writes = 0
    list(parts.handleInputRows(("left",), rows((3, "b", "y", 9)), state.Now(0)))
    assert parts.waiting.writes == 1
    done = next(parts.handleInputRows(("left",), rows((3, "c", "z", 10)), state.Now(0)))
    assert done.to_dict("records") == [{"side": "left", "stamp": 3, "a": "x", "b": "y", "c": "z"}] and min(parts.waiting.held)[0] == 4


def test_stale_keys(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 9.0)], "k string, t double")
    assert [r["k"] for r in stale(df, ["k"], "t", 10.0, 5.0).collect()] == ["a"]
