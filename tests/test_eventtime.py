from __future__ import annotations

import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests import state
from tidegrid.operators.nearest import nearest_bundle
from tidegrid.operators.sequences import grid
from tidegrid.streaming import eventtime

SCHEMA = "key string, stream string, t double, value string, seq long"


def folder(spark, path, batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(path))
        time.sleep(0.02)  # files are read in the order of their times
    return path


def run(spark, source, kept, build, name):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(source))
    out = str(kept) + "-out"
    query = build(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", str(kept)).trigger(availableNow=True).start()
    query.awaitTermination()
    dropped = sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
    return spark.read.parquet(out), dropped


def recording(seed, streams, keys=("a", "b"), seconds=8.0):
    """Rows of several streams of several keys, which arrive up to a second late."""
    rng, rows = random.Random(seed), []
    for k, key in enumerate(keys):
        begin = 100.0 + k
        rows += [(begin, key, eventtime.START, begin, ""), (begin + seconds, key, eventtime.END, begin + seconds, "")]
        for stream in streams:
            t = begin - 0.5
            while t < begin + seconds + 0.5:
                t += rng.choice([0.03, 0.1, 0.125, 0.25])
                rows.append((t + rng.random() * 0.9, key, stream, t, f"{stream}{t:.3f}"))
    rows.sort(key=lambda r: r[0])
    rows.append((10**6, "flush", eventtime.START, 10_000.0, ""))
    return [(key, stream, t, value, i) for i, (_, key, stream, t, value) in enumerate(rows)]


def test_ticks_over_ten_streams_equal_the_nearest_join(spark, tmp_path):
    streams = [f"s{i}" for i in range(10)]
    rows = recording(1, streams)
    n = -(-len(rows) // 5)
    source = folder(spark, tmp_path / "in", [rows[i : i + n] for i in range(0, len(rows), n)])
    got, dropped = run(spark, source, tmp_path / "state", lambda s: eventtime.bundle_stream(s, streams, 0.25, 0.1, "2 seconds"), "ticks")
    df = spark.createDataFrame(rows, SCHEMA)
    spans = spark.createDataFrame([("a", 100.0, 108.0), ("b", 101.0, 109.0)], "key string, start double, end double")
    ticks = grid(spans, "start", "end", 0.25).select("key", "candidate_index", "t")
    sides = {f"{s}_": (df.where(F.col("stream") == s).select("key", "t", "value", "seq"), ["value"]) for s in streams}
    whole = nearest_bundle(ticks, sides, ["key"], "t", "seq").collect()
    want = {}
    for r in whole:
        values = [(round(r[f"{s}_dt"], 9), r[f"{s}_value"]) if r[f"{s}_dt"] is not None and abs(r[f"{s}_dt"]) <= 0.1 else None for s in streams]
        want[r["key"], r["candidate_index"]] = values
    found = {(r["key"], r["candidate_index"]): [(round(r[f"{s}_dt"], 9), r[f"{s}_value"]) if r[f"{s}_value"] is not None else None for s in streams] for r in got.collect()}
    assert len(found) == got.count() == 64 and found == want and dropped == 0
    assert {r["late"] for r in got.select("late").collect()} == {0}


def test_a_restart_from_a_checkpoint_gives_the_same_rows(spark, tmp_path):
    streams = ["x", "y"]
    rows = recording(2, streams, seconds=4.0)
    cut = [0, len(rows) // 3, 2 * len(rows) // 3, len(rows)]
    parts = [rows[a:b] for a, b in zip(cut, cut[1:], strict=False)]
    build = lambda s: eventtime.bundle_stream(s, streams, 0.25, 0.1, "2 seconds")
    whole, _ = run(spark, folder(spark, tmp_path / "one", parts), tmp_path / "state1", build, "whole")
    for part in parts:  # a query of its own each time, from the last one's checkpoint
        folder(spark, tmp_path / "two", [part])
        pieces, _ = run(spark, tmp_path / "two", tmp_path / "state2", build, "pieces")
    plain = lambda df: sorted(map(repr, map(tuple, df.collect())))
    assert plain(pieces) == plain(whole) and whole.count() == 32


def test_late_rows_are_dropped_or_counted(spark, tmp_path):
    row = lambda stream, t, value, seq, key="k": (key, stream, t, value, seq)
    batches = [
        [row(eventtime.START, 10.0, "", 0), row("x", 10.0, "a", 1), row("x", 11.0, "b", 2)],
        [row("x", 20.0, "c", 3)],
        [row("x", 20.1, "f", 9)],
        [row("x", 12.0, "gone", 4), row("x", 13.05, "d", 5), row("x", 20.5, "e", 6)],
        [row(eventtime.END, 14.0, "", 7), row(eventtime.START, 10_000.0, "", 8, "flush")],
    ]
    got, dropped = run(spark, folder(spark, tmp_path / "in", batches), tmp_path / "state", lambda s: eventtime.bundle_stream(s, ["x"], 1.0, 0.2, "7 seconds"), "late")
    told = [(r["candidate_index"], r["x_value"]) for r in got.where("key = 'k'").orderBy("candidate_index").collect()]
    assert told == [(0, "a"), (1, "b"), (2, None), (3, "d")] and dropped == 1


def test_nearest_of_equally_near_is_the_first():
    items = [(1.0, 5, "b"), (3.0, 4, "a"), (9.0, 1, "c")]
    assert eventtime.nearest(items, 2.0, 1.0) == (-1.0, "a") and eventtime.nearest(items, 2.0, 0.5) is None and eventtime.nearest([], 1.0, 9.0) is None


def test_a_silent_key_is_told_by_a_timer(spark, tmp_path):
    row = lambda key, t, seq: (key, "s", t, "v", seq)
    batches = [[row("a", 1.0, 0), row("b", 1.0, 1)], [row("b", 4.0, 2)], [row("b", 9.0, 3)], [row("a", 12.0, 4), row("b", 12.0, 5)], [row("b", 13.0, 6)]]
    got, _ = run(spark, folder(spark, tmp_path / "in", batches), tmp_path / "state", lambda s: eventtime.watchdog(s, 5.5), "dog")
    assert sorted(map(tuple, got.where("key = 'a'").collect())) == [("a", "back", 12.0), ("a", "stale", 1.0)]
    assert got.where("key = 'b'").count() == 0


def test_a_batch_writes_what_is_new_not_what_is_kept():
    """Of a thousand items that wait, a batch with one more writes one."""

    work = eventtime.TickProcessor(["x"], 1.0, 0.5, 30.0)
    work.init(state.Handle())
    frame = lambda rows: iter([pd.DataFrame(rows, columns=["stream", "t", "value", "seq"])])
    list(work.handleInputRows(("k",), frame([(eventtime.START, 0.0, "", 0)] + [("x", i / 100, "v", i + 1) for i in range(1000)]), state.Now(0)))
    work.items.writes = 0
    list(work.handleInputRows(("k",), frame([("x", 10.0, "w", 2000)]), state.Now(0)))
    assert work.items.writes == 1 and len(work.items.held) == 1001
    out = next(work.handleExpiredTimer(("k",), state.Now(4.6), None))
    assert out["candidate_index"].tolist() == [0, 1, 2, 3, 4] and min(k[1] for k in work.items.held) == 4.5
    out = next(work.handleExpiredTimer(("k",), state.Now(99.0), None))  # idle
    assert out["candidate_index"].tolist() == [5, 6, 7, 8, 9, 10] and not work.items.held and not work.grid.exists()


def test_unknown_delay_is_an_error(spark, tmp_path):
    source = folder(spark, tmp_path / "in", [[("a", "s", 1.0, "v", 0)]])
    with pytest.raises(Exception):  # noqa: B017
        run(spark, source, tmp_path / "state", lambda s: eventtime.bundle_stream(s, ["s"], 1.0, 0.1, "soon"), "bad")
