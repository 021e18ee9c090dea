"""Nearest-in-time join of probes with a stream of items, and gates on its result.

Both sides are united, shuffled once by key and sorted in each direction; running windows carry the last item
before and the first item after each probe.  No pair of rows is ever formed, so the cost is
that of two sorts, whatever the density of the streams.  With a tolerance the work can be cut
into time buckets, so that a single busy key spreads over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def nearest_join(probes: DataFrame, items: DataFrame, by: list[str], time: str, seq: str, payload: list[str], prefix: str = "", tolerance: float | int | None = None, bucket: float | int | None = None, arrived_by: str | None = None) -> DataFrame:
    """``probes`` with the nearest item of the same key: ``<prefix>t``, ``<prefix>dt`` (probe minus item) and payload.

    Both sides have the columns ``by`` and ``time``; ``items`` also has ``seq``, its arrival order.
    Of items at the same time the one that arrived first counts; so it does when two are equally
    near.  Probes without an item, or with none within ``tolerance`` (inclusive), keep nulls.
    ``bucket``, at least the tolerance, is the width of time buckets.  ``arrived_by`` names a column of the
    probes: only items up to that time then count, as if decided then.
    """
    return nearest_bundle(probes, {prefix: (items, payload)}, by, time, seq, tolerance, bucket, arrived_by)


def nearest_bundle(probes: DataFrame, streams: dict[str, tuple[DataFrame, list[str]]], by: list[str], time: str, seq: str, tolerance: float | int | None = None, bucket: float | int | None = None, arrived_by: str | None = None) -> DataFrame:
    """``nearest_join`` with many streams, by prefix: all are united, and shuffled and sorted as one."""
    if bucket is not None and (tolerance is None or bucket < tolerance):
        raise ValueError("buckets need a tolerance no wider than them")
    key = [*by, "bucket__"] if bucket is not None else list(by)
    number = F.floor(F.col(time) / F.lit(bucket)).cast("long") if bucket is not None else None
    left = probes.select(*by, F.col(time).alias("t__"), F.lit(1).alias("side__"), F.lit(None).cast("long").alias("seq__"), F.struct(*[F.col(f"`{n}`") for n in probes.columns]).alias("probe"), *([number.alias("bucket__")] if bucket is not None else []))
    sides = []
    for i, (items, payload) in enumerate(streams.values()):
        kept = F.struct(F.col(time).alias("t"), F.col(seq).alias("seq"), *[F.col(p).alias(f"p{j}") for j, p in enumerate(payload)])
        near = [F.explode(F.array(number - 1, number, number + 1)).alias("bucket__")] if bucket is not None else []
        sides.append(items.where(F.col(time).isNotNull()).select(*by, F.col(time).alias("t__"), F.lit(0).alias("side__"), F.col(seq).alias("seq__"), kept.alias(f"item{i}"), *near))
    both = left
    for side in sides:
        both = both.unionByName(side, allowMissingColumns=True)
    # of items at one time the first to arrive comes last, whichever way the rows run
    late = F.desc_nulls_last("seq__")
    forward = W.partitionBy(*key).orderBy("t__", "side__", late).rowsBetween(W.unboundedPreceding, 0)
    backward = W.partitionBy(*key).orderBy(F.desc("t__"), F.desc("side__"), late).rowsBetween(W.unboundedPreceding, 0)
    many = range(len(sides))
    both = both.select(*both.columns, *[F.last(f"item{i}", True).over(forward).alias(f"a{i}") for i in many])
    both = both.select(*both.columns, *[F.last(f"item{i}", True).over(backward).alias(f"b{i}") for i in many]).where("probe is not null")
    t, found = F.col("t__"), []
    for i in many:
        a, b = F.col(f"a{i}"), F.col(f"b{i}")
        if arrived_by is not None:
            b = F.when(b["t"] <= F.col(f"probe.`{arrived_by}`"), b)
        before, after = t - a["t"], b["t"] - t
        first = b.isNull() | (before < after) | ((before == after) & (a["seq"] <= b["seq"]))
        nearest = F.when(a.isNotNull() & first, a).otherwise(b)
        found.append((F.when(F.abs(t - nearest["t"]) <= tolerance, nearest) if tolerance is not None else nearest).alias(f"n{i}"))
    chosen = both.select("t__", "probe", *found)
    out = [F.col(f"probe.`{n}`").alias(n) for n in probes.columns]
    for i, (prefix, (_, payload)) in enumerate(streams.items()):
        n = F.col(f"n{i}")
        out += [n["t"].alias(f"{prefix}t"), (t - n["t"]).alias(f"{prefix}dt"), *[n[f"p{j}"].alias(f"{prefix}{p}") for j, p in enumerate(payload)]]
    return chosen.select(*out)


def staleness(name: str, dt: Column, most: Column | float | int) -> Column:
    """``ok``, ``missing_<name>`` or ``stale_<name>``; a distance of exactly ``most`` is ok."""
    most = most if isinstance(most, Column) else F.lit(most)
    return F.when(dt.isNull(), F.lit(f"missing_{name}")).when(F.abs(dt) > most, F.lit(f"stale_{name}")).otherwise(F.lit("ok"))


def staleness_text(name: str, dt: Column, most: float) -> Column:
    """The reason with the distance, for people."""
    kind = staleness(name, dt, most)
    return F.when(kind.startswith("stale"), F.concat(kind, F.lit("_dt_"), F.format_string("%.3f", F.abs(dt).cast("double")))).otherwise(kind)


def gate(*steps: tuple[str, Column]) -> Column:
    """The name of the first step whose condition fails (null counts as failing), else ``ok``."""
    out = F.lit("ok")
    for reason, holds in reversed(steps):
        out = F.when(F.coalesce(holds, F.lit(False)), out).otherwise(F.lit(reason))
    return out
