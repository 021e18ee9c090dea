"""Recording replayed from logs: streams to aligned, gated rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry
from ..functions.columns import c
from ..operators.nearest import gate, nearest_bundle, staleness
from ..operators.sequences import accepted_index, grid

# fixed values: streams that gate a frame, in this order, and seconds within which they must lie
GATING = {"image": 0.10, "wrist_image": 0.10, "action": 0.08, "state": 0.08, "tactile_left": 0.10, "tactile_right": 0.10}
RECORDED = {"vr": 0.10}


@dataclass(frozen=True)
class Recording:
    fps: float = 10.0
    tolerance: dict[str, float] = field(default_factory=lambda: GATING | RECORDED)
    wait_for_enable: bool = True
    #: Seconds after the end in which late items still count.
    drain: bool = True

    @property
    def lateness(self) -> float:
        return max(2 / self.fps, *self.tolerance.values()) if self.drain else 0.0


def parse_commands(log: DataFrame) -> DataFrame:
    """Timed command events: sent time, else publication; rows without any time are dropped."""
    t = F.coalesce("http.t_send_start", "t_event", "wall_time")
    return log.withColumn("t", t).where("t is not null")


def parse_states(log: DataFrame) -> DataFrame:
    """Timed robot states: middle of the query, else publication; key fallbacks by presence."""
    keys = F.from_json("state", "map<string,string>")
    pick = lambda *names: _first(keys, names)
    pose = F.from_json(pick("pose", "ee_pose", "pos"), "array<float>")
    width = pick("gripper_pos", "gripper", "gripper_width")
    width = F.coalesce(width.try_cast("double"), F.get(F.from_json(width, "array<double>"), F.lit(0)))
    return log.withColumns({"t": F.coalesce("t_query_mid", "wall_time"), "pose": F.slice(pose, 1, 7), "width": width}).where("t is not null")


def _first(keys: Column, names: tuple[str, ...]) -> Column:
    from ..functions.columns import first_present

    return first_present(keys, *names)


def bundle(episodes: DataFrame, streams: dict[str, tuple[DataFrame, list[str]]], how: Recording) -> DataFrame:
    """Every tick of every episode with the nearest item of each stream.

    ``episodes``: episode_index, start, end.  A stream has episode_index, t, seq and its payload; its
    columns come out as ``<stream>_<column>``, with ``<stream>_t`` and ``<stream>_dt``.  Streams that
    gate are cut off at their tolerance by the gate, not here, so that reasons tell how far they were.
    """
    ticks = grid(episodes, "start", "end", 1 / how.fps).select("episode_index", "candidate_index", "t", "start")
    return nearest_bundle(ticks, {f"{n}_": stream for n, stream in streams.items()}, ["episode_index"], "t", "seq")


def gated(rows: DataFrame, how: Recording) -> DataFrame:
    """Adds ``reason`` and ``ok``, and numbers the accepted rows of each episode.

    Needs ``enabled_enabled``, ``tactile_*_data_len``, ``action_action8``, ``state_pose`` and ``state_width``.
    """
    steps = [("enabled false or missing", F.coalesce(F.col("enabled_enabled"), F.lit(False)))] if how.wait_for_enable else []
    steps += [(f"{n} not in time", staleness(n, F.col(f"{n}_dt"), how.tolerance[n]) == "ok") for n in GATING]
    steps += [
        ("left and right lengths differ", F.col("tactile_left_data_len") == F.col("tactile_right_data_len")),
        ("no action", F.col("action_action8").isNotNull()),
        ("action has another size", F.size("action_action8") == 8),
        ("no pose or width", F.col("state_pose").isNotNull() & F.col("state_width").isNotNull()),
        ("pose has another size", F.size("state_pose") == 7),
    ]
    judged = rows.withColumn("reason", gate(*steps)).withColumn("ok", F.col("reason") == "ok")
    return accepted_index(judged, ["episode_index"], ["candidate_index"], "ok")


def derived(rows: DataFrame) -> DataFrame:
    """Accepted rows with state and relative action."""
    target = F.slice("action_action8", 1, 7)
    stated = [F.col(n) for n in ("action_target_gripper_width", "action_target_gripper") if n in rows.columns]
    width = F.coalesce(*stated, F.element_at("action_action8", 8))
    quaternion = geometry.as_float(geometry.normalized(geometry.as_float(F.slice("action_action8", 4, 4))))
    sent = F.concat(geometry.as_float(F.slice("action_action8", 1, 3)), quaternion, geometry.as_float(F.slice("action_action8", 8, 1)))
    out = rows.where("ok").withColumns({"timestamp": (F.col("t") - F.col("start")).cast("float"), "observation.state": geometry.state7(F.col("state_pose"), F.col("state_width")), "action": geometry.relative_action7(target, F.col("state_pose"), width)})
    return out.withColumns({"action.sent_action8": sent, "sync.valid": F.lit(True)})


def record(episodes: DataFrame, streams: dict[str, tuple[DataFrame, list[str]]], how: Recording | None = None) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and the rejected ones with their reason."""
    how = how or Recording()
    judged = gated(bundle(episodes, streams, how), how)
    return derived(judged), judged.where("not ok").select("episode_index", "candidate_index", "t", "reason")


def warm(items: DataFrame, needed: list[str]) -> DataFrame:
    """Per episode the time from which every needed stream has been seen."""
    first = items.where(F.col("stream").isin(needed)).groupBy("episode_index", "stream").agg(F.min("t").alias("first"))
    ready = first.groupBy("episode_index").agg(F.count("*").alias("n"), F.max("first").alias("ready"))
    return ready.where(F.col("n") == len(needed)).select("episode_index", "ready")


def named(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rows with their columns under the names of the recorded table."""
    return rows.select(*[c(old).alias(new) for old, new in names.items()])
