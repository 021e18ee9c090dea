from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidegrid.operators.nearest import gate, nearest_join, staleness, staleness_text


def brute(items, t):
    """Nearest item; of equally near ones the first that arrived."""
    return min(sorted(items, key=lambda i: i[1]), key=lambda i: abs(i[0] - t)) if items else None


@pytest.mark.parametrize("bucket", [None, 8.0])
@pytest.mark.parametrize("tolerance", [None, 3.0])
def test_equals_brute_force_with_ties_and_duplicates(spark, tolerance, bucket):
    if bucket and tolerance is None:
        with pytest.raises(ValueError):
            nearest_join(spark.range(1), spark.range(1), [], "id", "id", [], bucket=bucket)
        return
    rng = random.Random(3)
    items = {k: [(float(rng.randrange(0, 60)), s, f"{k}{s}") for s in rng.sample(range(100), 25)] for k in ("a", "b")}
    probes = [(k, x / 2, i) for k in ("a", "b", "c") for i, x in enumerate(range(-6, 130, 3))]
    left = spark.createDataFrame(probes, "k string, t double, n int")
    right = spark.createDataFrame([(k, *x) for k, v in items.items() for x in v], "k string, t double, seq long, value string")
    found = nearest_join(left, right, ["k"], "t", "seq", ["value"], "x_", tolerance=tolerance, bucket=bucket).collect()
    assert len(found) == len(probes)
    for r in found:
        best = brute(items.get(r["k"], []), r["t"])
        if best is None or tolerance is not None and abs(best[0] - r["t"]) > tolerance:
            assert r["x_value"] is None and r["x_dt"] is None
        else:
            assert (r["x_value"], r["x_dt"]) == (best[2], r["t"] - best[0])


def test_boundary_is_inside_and_reasons(spark):
    df = spark.createDataFrame([(0.1,), (0.10001,), (None,), (-0.1,)], "dt double")
    kinds = [r[0] for r in df.select(staleness("image", F.col("dt"), 0.1)).collect()]
    assert kinds == ["ok", "stale_image", "missing_image", "ok"]
    assert df.select(staleness_text("image", F.lit(0.25), 0.1)).first()[0] == "stale_image_dt_0.250"


def test_only_items_that_had_arrived(spark):
    left = spark.createDataFrame([("a", 10.0, 10.5)], "k string, t double, decided double")
    right = spark.createDataFrame([("a", 7.0, 0), ("a", 11.0, 1)], "k string, t double, seq long")
    assert nearest_join(left, right, ["k"], "t", "seq", [], arrived_by="decided").first()["dt"] == 3.0
    assert nearest_join(left, right, ["k"], "t", "seq", []).first()["dt"] == -1.0


def test_gate_names_the_first_failure(spark):
    df = spark.createDataFrame([(True, True), (None, False), (True, None)], "a boolean, b boolean")
    assert [r[0] for r in df.select(gate(("no a", F.col("a")), ("no b", F.col("b")))).collect()] == ["ok", "no a", "no b"]
