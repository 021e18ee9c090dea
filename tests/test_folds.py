from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidegrid.operators import folds
from tidegrid.operators.folds import Pieces


def some_map(rng):
    edges = [rng.uniform(-3, 3) for _ in range(rng.randint(0, 4))]
    kinds = {}
    return Pieces.cut(edges, lambda x: kinds.setdefault(x, (rng.random() < 0.5, rng.uniform(-2, 2))))


def test_maps_one_after_the_other():
    rng = random.Random(1)
    for _ in range(300):
        f, g, h = (some_map(rng) for _ in range(3))
        both = f.then(g).then(h)
        assert both.left == sorted(set(both.left)) and both.left[0] == float("-inf")
        for _ in range(20):
            x = rng.uniform(-5, 5)
            assert both.at(x) == pytest.approx(h.at(g.at(f.at(x))), abs=1e-9)
    assert Pieces([float("-inf")], [False], [2.0]).constant() == 2.0


def rows(seed, n):
    """Uneven keys, one of which holds most rows; nulls; goals at the bounds."""
    rng = random.Random(seed)
    out, t = [], 0.0
    for i in range(n):
        t += rng.choice([0.0, 0.1, 0.25, 1.0])
        key = rng.choice(["hot"] * 8 + ["a", "b"])
        out.append((key, i, rng.choice([0.1, 1.0, None, rng.uniform(-0.5, 1.5), rng.uniform(0, 1)]), rng.choice([0.5, 0.0, 0.01, None]), None if rng.random() < 0.05 else t, rng.choice([None, 0.0, 0.1, -1.0, 1.0, rng.uniform(-1, 1), 1e-5])))
    return out


def plain(data, start, step):
    state, out = {}, {}
    for key, i, *values in data:
        state[key], *told = step(state.get(key, start), *values)
        out[i] = tuple(told)
    return out


@pytest.mark.parametrize("stretches", [1, 3, 17])
def test_folds_over_stretches_equal_plain_loops(spark, stretches):
    data = rows(stretches, 400)
    df = spark.createDataFrame(data, "k string, i long, goal double, dt double, t double, stick double").orderBy(F.rand(1))
    clip = lambda x, a, b: min(max(x, a), b)

    def ramp(v, goal, dt, t, stick):
        if goal is not None:
            m = 0.4 * max(dt or 0, 1e-3)
            v = clip(v + clip(goal - v, -m, m), 0.1, 1.0)
        return v, v

    def limit(last, goal, dt, t, stick):
        sent = t is not None and t - last >= 0.7
        return (t if sent else last), sent

    def width(w, goal, dt, t, stick):
        new = w if stick is None or abs(stick) < 0.05 else clip(w + stick * 0.05 * (dt or 0), 0.0, 0.08)
        changed = abs(new - w) >= 1e-6
        w = new if changed else w
        return w, w, changed

    got = folds.ramp(df, "k", "i", "goal", "dt", 0.4, 0.5, 0.1, 1.0, stretches)
    want = plain(data, 0.5, ramp)
    assert got.count() == len(data) and all(r["value"] == pytest.approx(want[r["i"]][0], abs=1e-9) for r in got.collect())
    assert {r["i"]: (r["sent"],) for r in folds.rate_limit(df, "k", "i", "t", 0.7, stretches).collect()} == plain(data, float("-inf"), limit)
    want = plain(data, 0.04, width)
    for r in folds.stick_width(df, "k", "i", "stick", "dt", 0.05, 0.04, 0.0, 0.08, 0.05, stretches=stretches).collect():
        assert r["width"] == pytest.approx(want[r["i"]][0], abs=1e-9) and r["changed"] == want[r["i"]][1]


def test_one_key_spreads_over_tasks(spark):
    df = spark.range(20_000).select(F.lit("one").alias("k"), F.col("id").alias("i"), (F.col("id") % 3 / 2).alias("goal"), F.lit(0.1).alias("dt"))
    out = folds.ramp(df, "k", "i", "goal", "dt", 0.4, 0.5, 0.1, 1.0, 8).withColumn("task", F.spark_partition_id())
    each = [r["count"] for r in out.groupBy("task").count().collect()]
    assert len(each) > 2 and max(each) < 15_000
    state, want = 0.5, []
    for i in range(20_000):
        state = min(max(state + min(max(i % 3 / 2 - state, -0.04), 0.04), 0.1), 1.0)
        want.append(state)
    assert [r["value"] for r in out.orderBy("i").collect()] == pytest.approx(want, abs=1e-9)


def test_poses_stream_past_in_batches(spark):
    """State is carried over batches of a few rows; keys may share a task."""
    data = [(i % 3, i, [float(i % 5), 0.0, 1.0, 0.0, 0.0, (i % 4) / 10, 1.0]) for i in range(60)]
    df = spark.createDataFrame(data, "e long, i long, p array<double>").orderBy(F.rand(2))
    whole = [tuple(map(repr, r)) for r in folds.low_pass(df, "e", "i", "p", 0.3).orderBy("i").collect()]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        assert [tuple(map(repr, r)) for r in folds.low_pass(df, "e", "i", "p", 0.3).orderBy("i").collect()] == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_tables(spark):
    df = spark.createDataFrame([], "k string, i long, goal double, dt double")
    assert folds.ramp(df, "k", "i", "goal", "dt", 0.4, 0.5, 0.1, 1.0, 2).collect() == []
    assert folds.rate_limit(df, "k", "i", "goal", 1.0).collect() == []
