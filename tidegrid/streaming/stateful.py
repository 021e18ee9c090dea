"""Streams: assembly of parts by stamp, nearest items at ticks, and committed episodes.

Each processor has a plain class that holds the logic and can be fed by hand, and a stateful
wrapper that keeps the class's state between micro-batches.  A replay through either gives the same rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..sinks.writers import remove

#: Stamps that wait for their parts, at most.
PENDING = 8


@dataclass
class Assembler:
    """Parts that share a stamp, complete or never.

    Stamps up to the last completed one come too late.  A repeated part replaces the first.  Of more
    than ``most`` waiting stamps the smallest is dropped; completing one drops all before it.
    """

    parts: tuple[str, ...]
    most: int = PENDING
    last: int = -1
    waiting: dict[int, dict[str, str]] = field(default_factory=dict)

    def add(self, stamp: int, part: str, value: str) -> tuple[int, dict[str, str]] | None:
        if stamp <= self.last or part not in self.parts:
            return None
        self.waiting.setdefault(stamp, {})[part] = value
        while len(self.waiting) > self.most:
            del self.waiting[min(self.waiting)]
        whole = self.waiting.get(stamp, {})
        if len(whole) < len(self.parts):
            return None
        self.last = stamp
        self.waiting = {s: p for s, p in self.waiting.items() if s > stamp}
        return stamp, whole


@dataclass
class Ticks:
    """The nearest item at each tick, from the items kept so far.

    A tick is decided once an item's time passes it by ``lateness``; ticks are never skipped.  Only the
    last ``most`` items that arrived are kept.  Ticks end ``longest`` after the first, if it is given.
    """

    start: float
    step: float
    lateness: float
    most: int
    longest: float | None = None
    next: int = 0
    items: list[tuple[float, str]] = field(default_factory=list)
    seen: float = float("-inf")

    def add(self, t: float, value: str) -> list[tuple[int, float, float, str]]:
        self.items = [*self.items, (t, value)][-self.most :]
        self.seen = max(self.seen, t)
        return self._due(self.seen - self.lateness)

    def finish(self) -> list[tuple[int, float, float, str]]:
        """The ticks that the items seen reach, without waiting for later ones."""
        return self._due(self.seen)

    @property
    def over(self) -> bool:
        """Whether the longest span is decided."""
        return self.longest is not None and self.seen - self.lateness >= self.start + self.longest

    def _due(self, until: float) -> list[tuple[int, float, float, str]]:
        out = []
        until = until if self.longest is None else min(until, np.nextafter(self.start + self.longest, -np.inf))
        while self.items and (tick := self.start + self.next * self.step) <= until:
            t, value = min(self.items, key=lambda item: abs(item[0] - tick))
            out.append((self.next, tick, tick - t, value))
            self.next += 1
        return out


def _fields(**kinds) -> StructType:
    return StructType([StructField(n, k) for n, k in kinds.items()])


def _rows(batches: Iterable[pd.DataFrame], order: str) -> Iterator[dict]:
    whole = pd.concat(list(batches), ignore_index=True)
    yield from whole.sort_values(order, kind="stable").to_dict("records")


class AssemblerProcessor(StatefulProcessor):
    """An assembler for each side.  Waiting parts are kept one by one: a batch writes those that come and go."""

    def __init__(self, parts: tuple[str, ...], most: int) -> None:
        self.parts, self.most = parts, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", _fields(last=LongType()))
        self.waiting = handle.getMapState("waiting", _fields(stamp=LongType(), part=StringType()), _fields(value=StringType()))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        before = {k: v[0] for k, v in self.waiting.iterator()}
        work = Assembler(self.parts, self.most, self.last.get()[0] if self.last.exists() else -1)
        for (stamp, part), value in before.items():
            work.waiting.setdefault(stamp, {})[part] = value
        done = [found for r in _rows(rows, "seq") if (found := work.add(int(r["stamp"]), r["part"], r["value"]))]
        self.last.update((work.last,))
        after = {(s, p): v for s, parts in work.waiting.items() for p, v in parts.items()}
        for k in before.keys() - after.keys():
            self.waiting.removeKey(k)
        for k, v in after.items():
            if before.get(k, after) != v:
                self.waiting.updateValue(k, (v,))
        yield pd.DataFrame({"side": [key[0]] * len(done), "stamp": [s for s, _ in done], **{p: [whole[p] for _, whole in done] for p in self.parts}}).astype({"side": object, **dict.fromkeys(self.parts, object)})

    def close(self) -> None:
        pass


def assemble_stream(stream: DataFrame, parts: tuple[str, ...], most: int = PENDING) -> DataFrame:
    """``stream``: side, stamp, part, value and seq, its arrival order.  One row for each complete stamp."""
    schema = ", ".join(["side string", "stamp long", *[f"`{p}` string" for p in parts]])
    return stream.groupBy("side").transformWithStateInPandas(AssemblerProcessor(parts, most), outputStructType=_struct(schema), outputMode="append", timeMode="none")


class TicksProcessor(StatefulProcessor):
    """A key's ticks.  A row without value ends its key: what is left is decided and the state goes.

    So does a key of which nothing came for ``idle`` milliseconds, and one whose longest span is decided; a
    later row then starts the key anew.  Items are kept by their number, so that a batch writes those that come
    and removes those that go, however many stay.
    """

    def __init__(self, step: float, lateness: float, most: int, longest: float | None, idle: int | None) -> None:
        self.step, self.lateness, self.most, self.longest, self.idle = step, lateness, most, longest, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.grid = handle.getValueState("grid", _fields(start=DoubleType(), next=LongType(), seen=DoubleType(), count=LongType()))
        self.items = handle.getMapState("items", _fields(number=LongType()), _fields(t=DoubleType(), value=StringType()))

    def _load(self) -> tuple[Ticks | None, dict[int, tuple[float, str]], int]:
        if not self.grid.exists():
            return None, {}, 0
        start, number, seen, count = self.grid.get()
        held = {k[0]: tuple(v) for k, v in self.items.iterator()}
        return Ticks(start, self.step, self.lateness, self.most, self.longest, number, [held[n] for n in sorted(held)], seen), held, count

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        work, held, count = self._load()
        out = []
        for r in _rows(rows, "seq"):
            if r["value"] is None:
                out += work.finish() if work else []
                work = None
                continue
            work = work or Ticks(float(r["t"]), self.step, self.lateness, self.most, self.longest)
            out += work.add(float(r["t"]), r["value"])
            count += 1
            work = None if work.over else work
        self._keep(work, held, count, timerValues)
        yield self._table(key, out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        work, _, _ = self._load()
        out = work.finish() if work else []
        self.grid.clear()
        self.items.clear()
        yield self._table(key, out)

    def _keep(self, work: Ticks | None, held: dict[int, tuple[float, str]], count: int, timerValues) -> None:
        if self.idle is not None:
            for old in list(self.handle.listTimers()):
                self.handle.deleteTimer(old)
            if work is not None:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle)
        if work is None:
            self.grid.clear()
            self.items.clear()
            return
        self.grid.update((work.start, work.next, work.seen, count))
        now = dict(enumerate(work.items, count - len(work.items)))
        for n in held.keys() - now.keys():
            self.items.removeKey((n,))
        for n in now.keys() - held.keys():
            self.items.updateValue((n,), now[n])

    def close(self) -> None:
        pass

    @staticmethod
    def _table(key, out: list[tuple]) -> pd.DataFrame:
        columns = {"key": [key[0]] * len(out), "candidate_index": [x[0] for x in out], "tick": [x[1] for x in out], "dt": [x[2] for x in out], "value": [x[3] for x in out]}
        return pd.DataFrame(columns).astype({"key": object, "value": object})


def nearest_stream(stream: DataFrame, step: float, lateness: float, most: int, longest: float | None = None, idle: int | None = None) -> DataFrame:
    """``stream``: key, t, value and seq.  One row for each tick from a key's first item on.

    A null value ends its key; see ``TicksProcessor`` for ``longest`` and ``idle``.
    """
    schema = _struct("key string, candidate_index long, tick double, dt double, value string")
    work = TicksProcessor(step, lateness, most, longest, idle)
    return stream.groupBy("key").transformWithStateInPandas(work, outputStructType=schema, outputMode="append", timeMode="none" if idle is None else "processingTime")


def _struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


class EpisodeCommitter:
    """For ``foreachBatch``: finished episodes are committed once, discarded recordings never.

    Rows have episode_index, frame_index and ``event``: null for a frame, else save or discard; and ``seq``, their
    order within the batch, unless that is the order they come in.  All rows wait in a staging folder,
    one for each batch, so that a batch that runs again replaces what it wrote.  A save commits the frames since
    its episode's last save or discard, of a repeated frame the last, by writing the episode's own
    partition, again replacing it.  Batches before the one that closed an episode no longer keep its rows.
    """

    def __init__(self, root: str) -> None:
        self.staged, self.committed = f"{root}/staged", f"{root}/episodes"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        names = [n for n in batch.columns if n not in ("event", "seq")]
        placed = batch if "seq" in batch.columns else batch.withColumn("seq", F.monotonically_increasing_id())
        placed = placed.select(*names, "event", F.col("seq").cast("long").alias("seq"), F.col("episode_index").alias("episode"))
        placed.write.mode("overwrite").partitionBy("episode").parquet(f"{self.staged}/batch={batch_id}")
        own = spark.read.schema(placed.schema).parquet(f"{self.staged}/batch={batch_id}")
        # as many as a batch saves
        saved = [r[0] for r in own.where("event = 'save'").select("episode").distinct().collect()]
        waiting = spark.read.schema(placed.schema.add("batch", "long")).parquet(self.staged)
        if saved:
            self._commit(waiting.where(F.col("episode").isin(saved) & (F.col("batch") <= batch_id)), batch_id, names)
        # the batches before this one are done for good
        closed = waiting.where((F.col("batch") < batch_id) & F.col("event").isNotNull()).groupBy("episode").agg(F.max("batch")).collect()
        folders = {(r["batch"], r["episode"]) for r in waiting.where(F.col("batch") < batch_id).select("batch", "episode").distinct().collect()} if closed else set()
        for episode, last in closed:
            for number in sorted(b for b, e in folders if e == episode and b < last):
                remove(spark, f"{self.staged}/batch={number}/episode={episode}")

    def _commit(self, rows: DataFrame, batch_id: int, names: list[str]) -> None:
        at = F.struct("batch", "seq")
        saves = rows.where((F.col("event") == "save") & (F.col("batch") == batch_id)).groupBy("episode").agg(F.max(at).alias("save"))
        events = rows.where("event is not null").select("episode", at.alias("at")).join(saves, "episode").where("at < save")
        since = events.groupBy("episode").agg(F.max("at").alias("since"))
        frames = rows.where("event is null").withColumn("at", at).join(saves.join(since, "episode", "left"), "episode")
        frames = frames.where("at < save and (since is null or at > since)")
        last = frames.groupBy("episode", "frame_index").agg(F.max_by(F.struct(*names), "at").alias("r")).select("r.*")
        last = last.repartition("episode_index").sortWithinPartitions("frame_index")
        last.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("episode_index").parquet(self.committed)


def stale(stream: DataFrame, by: list[str], time: str, now: float, most: float) -> DataFrame:
    """Keys whose last item is older than ``most`` at ``now``."""
    last = stream.groupBy(*by).agg(F.max(time).alias("last"))
    return last.where(F.lit(now) - F.col("last") > most)
