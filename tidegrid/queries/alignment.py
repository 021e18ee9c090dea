"""Nearest joins of event streams, gates and their statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.nearest import gate, nearest_bundle, nearest_join, staleness
from ..operators.statistics import column_stats
from .tables import events

HOUR = 3_600_000_000
_ITEM = ["event_id", "value"]


def _stream(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    return events(spark, sf_dir).where(F.col("event_type") == kind).select("user_id", "t", "event_id", "value")


def _nearest(spark, sf_dir, items: str = "purchase", **how) -> DataFrame:
    probes = _stream(spark, sf_dir, "click").withColumn("probe_id", F.col("event_id")).drop("event_id", "value")
    return nearest_join(probes, _stream(spark, sf_dir, items), ["user_id"], "t", "event_id", _ITEM, f"{items}_", **how)


def asof_nearest_tol(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _nearest(spark, sf_dir, tolerance=6 * HOUR, bucket=24 * HOUR)
    return out.select("probe_id", "user_id", F.col("purchase_dt").alias("dt"), F.col("purchase_event_id").alias("item_id"), F.col("purchase_value").alias("value"), staleness("purchase", F.col("purchase_dt"), 6 * HOUR).alias("reason"))


def asof_nearest_unbounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _nearest(spark, sf_dir)
    return out.select("probe_id", F.col("purchase_dt").alias("dt"), F.col("purchase_event_id").alias("item_id"), staleness("purchase", F.col("purchase_dt"), 6 * HOUR).alias("reason"))


def asof_as_arrived(spark: SparkSession, sf_dir: str) -> DataFrame:
    probes = _stream(spark, sf_dir, "click").select("user_id", "t", F.col("event_id").alias("probe_id"), (F.col("t") + HOUR).alias("decided"))
    out = nearest_join(probes, _stream(spark, sf_dir, "purchase"), ["user_id"], "t", "event_id", ["event_id"], "purchase_", tolerance=6 * HOUR, arrived_by="decided")
    return out.select("probe_id", F.col("purchase_dt").alias("dt"), F.col("purchase_event_id").alias("item_id"))


_GATED = {"purchase": 12, "view": 12, "signup": 24, "error": 24}


def _bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks = _stream(spark, sf_dir, "click").select("user_id", "t", F.col("event_id").alias("probe_id"))
    return nearest_bundle(clicks, {f"{k}_": (_stream(spark, sf_dir, k), ["value"]) for k in _GATED}, ["user_id"], "t", "event_id")


def _gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = [(f"bad_{k}", staleness(k, F.col(f"{k}_dt"), h * HOUR) == "ok") for k, h in _GATED.items()]
    steps.append(("values_apart", F.abs(F.col("purchase_value") - F.col("view_value")) <= 20))
    return _bundle(spark, sf_dir).withColumn("reason", gate(*steps))


def gate_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gated(spark, sf_dir).groupBy("reason").agg(F.count("*").alias("n"), F.count_if(F.col("reason") == "ok").alias("accepted"))


def sync_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [f"{k}_dt" for k in _GATED]
    stats = column_stats(_bundle(spark, sf_dir).select(*[(F.col(n) / 1e6).alias(n) for n in names]), names)
    return stats.select("column", "n", *[F.round(x, 4).alias(x) for x in ("mean", "p50", "p95_abs", "max_abs")])


def tolerance_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = asof_nearest_tol(spark, sf_dir)
    return out.groupBy("reason").agg(F.count("*").alias("n"), F.round(F.avg(F.abs("dt")) / 1e6, 4).alias("mean_s"), F.max(F.abs("dt")).alias("max_us"))


_CLICKS = "SELECT event_id AS probe_id, user_id, epoch_us(ts) AS t FROM events WHERE event_type = 'click'"
_BUY = "SELECT event_id AS item_id, user_id, epoch_us(ts) AS t, value FROM events WHERE event_type = 'purchase'"


def _best(extra: str) -> str:
    return f"""
        c AS ({_CLICKS}), p AS ({_BUY}),
        m AS (
            SELECT probe_id, c.user_id, c.t - p.t AS dt, item_id, value,
                   row_number() OVER (PARTITION BY probe_id ORDER BY abs(c.t - p.t), item_id) AS r
            FROM c LEFT JOIN p ON p.user_id = c.user_id {extra}
        )"""


_SIX = 6 * HOUR
_TOL = f"WITH {_best(f'AND abs(c.t - p.t) <= {_SIX}')} SELECT probe_id, user_id, dt, item_id, value, CASE WHEN dt IS NULL THEN 'missing_purchase' ELSE 'ok' END AS reason FROM m WHERE r = 1"

_MULTI = f"""
    WITH c AS ({_CLICKS}), i AS (
        SELECT event_id, user_id, event_type, epoch_us(ts) AS t, value FROM events WHERE event_type <> 'click'
    ), m AS (
        SELECT probe_id, event_type, c.t - i.t AS dt, value,
               row_number() OVER (PARTITION BY probe_id, event_type ORDER BY abs(c.t - i.t), event_id) AS r
        FROM c JOIN i USING (user_id)
    ), w AS (
        SELECT c.probe_id, {", ".join(f"max(dt) FILTER (WHERE event_type = '{k}') AS {k}_dt, max(value) FILTER (WHERE event_type = '{k}') AS {k}_value" for k in _GATED)}
        FROM c LEFT JOIN (SELECT * FROM m WHERE r = 1) m USING (probe_id) GROUP BY c.probe_id
    )"""

QUERIES = {
    "asof_nearest_tol": (asof_nearest_tol, _TOL),
    "asof_nearest_unbounded": (
        asof_nearest_unbounded,
        f"WITH {_best('')} SELECT probe_id, dt, item_id, CASE WHEN dt IS NULL THEN 'missing_purchase' WHEN abs(dt) > {_SIX} THEN 'stale_purchase' ELSE 'ok' END AS reason FROM m WHERE r = 1",
    ),
    "asof_as_arrived": (asof_as_arrived, f"WITH {_best(f'AND abs(c.t - p.t) <= {_SIX} AND p.t <= c.t + {HOUR}')} SELECT probe_id, dt, item_id FROM m WHERE r = 1"),
    "gate_reasons": (
        gate_reasons,
        f"""{_MULTI}, g AS (
            SELECT CASE {" ".join(f"WHEN {k}_dt IS NULL OR abs({k}_dt) > {h * HOUR} THEN 'bad_{k}'" for k, h in _GATED.items())}
                        WHEN abs(purchase_value - view_value) <= 20 THEN 'ok' ELSE 'values_apart' END AS reason FROM w
        ) SELECT reason, count(*) AS n, count(*) FILTER (WHERE reason = 'ok') AS accepted FROM g GROUP BY reason""",
    ),
    "sync_stats": (
        sync_stats,
        f"""{_MULTI}, l AS ({" UNION ALL ".join(f"SELECT '{k}_dt' AS col, {k}_dt / 1e6 AS v FROM w WHERE {k}_dt IS NOT NULL" for k in _GATED)})
        SELECT col AS "column", count(*) AS n, round(avg(v), 4) AS mean, round(quantile_cont(v, 0.5), 4) AS p50,
               round(quantile_cont(abs(v), 0.95), 4) AS p95_abs, round(max(abs(v)), 4) AS max_abs FROM l GROUP BY col""",
    ),
    "tolerance_stats": (tolerance_stats, f"SELECT reason, count(*) AS n, round(avg(abs(dt)) / 1e6, 4) AS mean_s, max(abs(dt)) AS max_us FROM ({_TOL}) GROUP BY reason"),
}
