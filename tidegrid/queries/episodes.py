"""Episodes, segments, indices and running state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import lookups, sequences
from .alignment import HOUR
from .tables import events, table


def _frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.length("text").cast("long").alias("chars"))


def gap_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sequences.gap_segments(events(spark, sf_dir), ["user_id"], ["t", "event_id"], "t", 12 * HOUR)
    return out.groupBy("user_id", "segment").agg(F.count("*").alias("rows"), F.min("event_id").alias("first_id"), (F.max("t") - F.min("t")).alias("span"))


def contiguity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = sequences.contiguity(_frames(spark, sf_dir), ["conv_id"], "turn").select(F.lit("conversations").alias("part"), F.col("conv_id").alias("episode"), "rows", "contiguous")
    lines = table(spark, sf_dir, "lineitem").withColumn("frame", F.col("l_linenumber") - 1)
    return one.unionByName(sequences.contiguity(lines, ["l_orderkey"], "frame").select(F.lit("lineitem").alias("part"), F.col("l_orderkey").alias("episode"), "rows", "contiguous"))


def ordered_contiguity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.contiguity(table(spark, sf_dir, "lineitem").withColumn("frame", F.col("l_linenumber") - 1), ["l_orderkey"], "frame", ["l_shipdate", "l_linenumber", "l_partkey"])


def global_contiguity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.globally_contiguous(table(spark, sf_dir, "events"), "event_id")


def reindex_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.reindex(_frames(spark, sf_dir), ["role", "conv_id"], ["turn"]).select("conv_id", "turn", "role", "index", "episode_index", "frame_index")


def retime_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sequences.retime(sequences.reindex(_frames(spark, sf_dir), ["conv_id"], ["turn"]), "frame_index", 10.0)
    return out.select("conv_id", "turn", F.round(F.col("timestamp").cast("double"), 4).alias("timestamp"))


def _ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.episode_ranges(sequences.reindex(_frames(spark, sf_dir), ["conv_id"], ["turn"]), "episode_index", "index", 10.0)


def episode_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranges(spark, sf_dir)


def range_join_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("row_index"), "value")
    joined = lookups.within(rows, _ranges(spark, sf_dir), "row_index", "from_index", "to_index")
    return joined.groupBy("episode_index").agg(F.count("*").alias("rows"), F.round(F.sum("value"), 4).alias("total"))


def raw_cursor_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = table(spark, sf_dir, "lineitem").groupBy((F.col("l_suppkey") % 50 + 1).alias("source"), F.col("l_linenumber").alias("part")).agg(F.count("*").alias("length"))
    rows = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 50 + 1).alias("source"), "o_orderkey")
    placed = rows.withColumn("ordinal", F.expr("row_number() OVER (PARTITION BY source ORDER BY o_orderkey) - 1"))
    return lookups.by_cursor(segments, placed, "source", "part", "length", "ordinal").select("source", "part", "position", "o_orderkey")


def running_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_linenumber").agg(F.count("*").alias("length"))
    return sequences.running_offset(lines, ["l_suppkey"], ["l_linenumber"], "length")


def edge_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sequences.rising_edge(events(spark, sf_dir), ["user_id"], ["t", "event_id"], F.col("value") > 20)
    return out.where("edge").select("event_id", "user_id")


def hysteresis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.hysteresis(events(spark, sf_dir), ["user_id"], ["t", "event_id"], "value", 5.0, 20.0).select("event_id", "on")


def hold_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = {k: F.when(F.col("event_type") == k, F.col("event_id")) for k in ("click", "purchase", "view")}
    return sequences.hold_last(events(spark, sf_dir), ["user_id"], ["t", "event_id"], held).select("event_id", *held)


def monotone_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.monotone(table(spark, sf_dir, "lineitem"), ["l_orderkey"], ["l_shipdate", "l_partkey", "l_linenumber"], "l_linenumber")


def grid_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event of each user at every six-hour tick, by the union of ticks and events."""
    e = events(spark, sf_dir)
    spans = e.groupBy("user_id").agg(F.min("t").alias("start"), (F.max("t") + 1).alias("end"))
    ticks = sequences.grid(spans, "start", "end", 6 * HOUR).select("user_id", "candidate_index", "t")
    both = e.select("user_id", "t", F.lit(0).alias("side"), "event_id", F.lit(None).cast("long").alias("candidate_index"))
    both = both.unionByName(ticks.select("user_id", "t", F.lit(1).alias("side"), F.lit(None).cast("long").alias("event_id"), "candidate_index"))
    return sequences.hold_last(both, ["user_id"], ["t", "side", "event_id"], {"last_id": F.col("event_id")}).where("side = 1").select("user_id", "candidate_index", "t", "last_id")


def accepted_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    ok = events(spark, sf_dir).withColumn("ok", F.coalesce(F.col("value") > 8, F.lit(False)))
    return sequences.accepted_index(ok, ["user_id"], ["t", "event_id"], "ok").select("event_id", "ok", "frame_index")


def systematic_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "event_type")
    n = e.count()
    return e.where(F.col("event_id").isin(sequences.systematic(n, 7)))


def slice_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return lookups.row_slice(e, "event_id", 40, 25, e.count())


def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frame 3 of episode 5, by the episode's range."""
    rows = sequences.reindex(_frames(spark, sf_dir), ["conv_id"], ["turn"])
    found = _ranges(spark, sf_dir).where("episode_index = 5").select((F.col("from_index") + 3).alias("wanted"))
    return rows.join(F.broadcast(found), F.col("index") == F.col("wanted")).select("conv_id", "turn", "index")  # one row


_F = "SELECT conv_id, turn, role FROM conversations"
_SEG = "SELECT *, sum(CASE WHEN gap > 43200000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t, event_id) AS segment FROM (SELECT user_id, event_id, epoch_us(ts) AS t, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events)"
_RNG = "SELECT row_number() OVER (ORDER BY conv_id) - 1 AS episode_index, n AS length, sum(n) OVER (ORDER BY conv_id) - n AS from_index, sum(n) OVER (ORDER BY conv_id) AS to_index FROM (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id)"
_LEN = "SELECT l_suppkey, l_linenumber, count(*) AS length FROM lineitem GROUP BY ALL"

QUERIES = {
    "gap_segments": (gap_segments, f"SELECT user_id, segment::BIGINT AS segment, count(*) AS rows, min(event_id) AS first_id, max(t) - min(t) AS span FROM ({_SEG}) GROUP BY user_id, segment"),
    "contiguity_report": (
        contiguity_report,
        "SELECT 'conversations' AS part, conv_id AS episode, count(*) AS rows, min(turn) = 0 AND max(turn) = count(*) - 1 AND count(DISTINCT turn) = count(*) AS contiguous FROM conversations GROUP BY conv_id "
        "UNION ALL SELECT 'lineitem', l_orderkey, count(*), min(l_linenumber) = 1 AND max(l_linenumber) = count(*) AND count(DISTINCT l_linenumber) = count(*) FROM lineitem GROUP BY l_orderkey",
    ),
    "ordered_contiguity": (
        ordered_contiguity,
        "SELECT l_orderkey, count(*) AS rows, bool_and(p = l_linenumber) AS contiguous FROM (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey) AS p FROM lineitem) GROUP BY l_orderkey",
    ),
    "global_contiguity": (global_contiguity, 'SELECT count(*) AS rows, min(event_id) AS first, max(event_id) AS last, count(DISTINCT event_id) AS indices, min(event_id) = 0 AND max(event_id) = count(*) - 1 AND count(DISTINCT event_id) = count(*) AS contiguous FROM events'),
    "reindex_episodes": (
        reindex_episodes,
        f'SELECT conv_id, turn, role, row_number() OVER (ORDER BY role, conv_id, turn) - 1 AS "index", dense_rank() OVER (ORDER BY role, conv_id) - 1 AS episode_index, row_number() OVER (PARTITION BY role, conv_id ORDER BY turn) - 1 AS frame_index FROM ({_F})',
    ),
    "retime_episodes": (retime_episodes, f"SELECT conv_id, turn, round(((row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) / 10.0)::FLOAT::DOUBLE, 4) AS timestamp FROM ({_F})"),
    "episode_ranges": (episode_ranges, f"SELECT episode_index, length, from_index::BIGINT AS from_index, to_index::BIGINT AS to_index, from_index / 10.0 AS from_timestamp, to_index / 10.0 AS to_timestamp FROM ({_RNG})"),
    "range_join_episodes": (range_join_episodes, f"SELECT episode_index, count(*) AS rows, round(sum(value), 4) AS total FROM events JOIN ({_RNG}) ON event_id >= from_index AND event_id < to_index GROUP BY episode_index"),
    "raw_cursor_alignment": (
        raw_cursor_alignment,
        """WITH s AS (
            SELECT source, part, length, sum(length) OVER (PARTITION BY source ORDER BY part) - length AS first
            FROM (SELECT l_suppkey % 50 + 1 AS source, l_linenumber AS part, count(*) AS length FROM lineitem GROUP BY ALL)
        ), r AS (
            SELECT o_custkey % 50 + 1 AS source, o_orderkey, row_number() OVER (PARTITION BY o_custkey % 50 ORDER BY o_orderkey) - 1 AS ordinal FROM orders
        ) SELECT s.source, part, (ordinal - first)::INTEGER AS position, o_orderkey FROM s JOIN r ON r.source = s.source AND ordinal >= first AND ordinal < first + length""",
    ),
    "running_offset": (running_offset, f'SELECT l_suppkey, l_linenumber, length, (sum(length) OVER (PARTITION BY l_suppkey ORDER BY l_linenumber) - length)::BIGINT AS "offset" FROM ({_LEN})'),
    "edge_detect": (edge_detect, "SELECT event_id, user_id FROM (SELECT event_id, user_id, coalesce(value > 20, false) AS now, lag(coalesce(value > 20, false), 1, false) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events) WHERE now AND NOT before"),
    "hysteresis": (
        hysteresis,
        'SELECT event_id, coalesce(last_value(CASE WHEN value > 20 THEN true WHEN value < 5 THEN false END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), false) AS "on" FROM events',
    ),
    "hold_last": (
        hold_last,
        "SELECT event_id, " + ", ".join(f"last_value(CASE WHEN event_type = '{k}' THEN event_id END IGNORE NULLS) OVER w AS {k}" for k in ("click", "purchase", "view")) + " FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
    ),
    "monotone_check": (
        monotone_check,
        "SELECT l_orderkey, count(*) AS rows, count(*) FILTER (WHERE l_linenumber <= before) AS backward FROM (SELECT l_orderkey, l_linenumber, lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey, l_linenumber) AS before FROM lineitem) GROUP BY l_orderkey",
    ),
    "grid_resample": (
        grid_resample,
        """WITH e AS (SELECT user_id, event_id, epoch_us(ts) AS t FROM events), s AS (SELECT user_id, min(t) AS a, max(t) + 1 AS z FROM e GROUP BY user_id),
        k AS (SELECT user_id, a, unnest(range(0, CAST(ceil((z - a) / 21600000000.0) AS BIGINT))) AS candidate_index FROM s),
        g AS (SELECT user_id, candidate_index, a + candidate_index * 21600000000 AS t FROM k)
        SELECT g.user_id, candidate_index, g.t, arg_max(event_id, (e.t, event_id)) AS last_id FROM g LEFT JOIN e ON e.user_id = g.user_id AND e.t <= g.t GROUP BY ALL""",
    ),
    "accepted_frames": (accepted_frames, "SELECT event_id, ok, CASE WHEN ok THEN sum(ok::INTEGER) OVER (PARTITION BY user_id ORDER BY ts, event_id)::BIGINT - 1 END AS frame_index FROM (SELECT *, coalesce(value > 8, false) AS ok FROM events)"),
    "systematic_sample": (systematic_sample, "WITH n AS (SELECT count(*) - 1 AS last FROM events) SELECT event_id, event_type FROM events WHERE event_id IN (SELECT CAST(floor(i * last / 6.0) AS BIGINT) FROM n, range(7) r(i))"),
    "slice_limit": (slice_limit, "SELECT event_id, user_id, event_type FROM events WHERE event_id >= 40 AND event_id < 65"),
    "point_lookup": (point_lookup, f'SELECT conv_id, turn, "index" FROM (SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS "index" FROM ({_F})) WHERE "index" = (SELECT from_index + 3 FROM ({_RNG}) WHERE episode_index = 5)'),
}
