"""Event-time streams: ticks over many streams at once, and a watchdog whose timers fire.

Rows of all streams come as one: key, stream, t (seconds), ts (its timestamp, with a watermark), value and seq.  What happens depends on
event time only, so that a replay gives the rows of the recording, and a restart from a checkpoint goes on
where it was.  State is kept element by element, so that a batch writes what is new and what goes, not what stays.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

#: Streams that say when a key's ticks begin and end.
START, END = "*start", "*end"


_TYPES = {"string": StringType(), "double": DoubleType(), "long": LongType(), "boolean": BooleanType()}


def _struct(fields: str) -> StructType:
    """``name type, ...``, for workers too, which have no session to ask."""
    return StructType([StructField(n, _TYPES[t]) for n, t in (f.rsplit(" ", 1) for f in fields.split(", "))])


def _millis(t: float) -> int:
    return math.ceil(t * 1000)


def _sorted(rows) -> pd.DataFrame:
    return pd.concat(list(rows), ignore_index=True).sort_values("seq", kind="stable")


def nearest(items: list[tuple[float, int, str]], tick: float, most: float) -> tuple[float, str] | None:
    """Of (t, seq, value) the one nearest to a tick, ``most`` away at most; of equally near ones that of least seq."""
    near = min(((abs(t - tick), seq, t, value) for t, seq, value in items), default=None)
    return None if near is None or near[0] > most else (tick - near[2], near[3])


class TickProcessor(StatefulProcessor):
    """A key's ticks from its start row on, to before its end row, each with the nearest item of every stream.

    Both marks come at about their time, as items do, since every row moves the watermark.

    A tick is decided when the watermark has passed it by the tolerance, as by then all that may be nearest has come; what
    comes later is counted as late.  Items that no tick will need go at once.  An item that comes before the
    start row waits for it.  A key of which nothing comes for ``idle`` seconds of event time ends; its state goes.
    """

    def __init__(self, streams: list[str], step: float, tolerance: float, idle: float | None) -> None:
        self.streams, self.step, self.tolerance, self.idle = streams, step, tolerance, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.items = handle.getMapState("items", _struct("stream string, t double, seq long"), _struct("value string"))
        self.grid = handle.getValueState("grid", _struct("start double, stop double, next long, seen double, late long"))

    def _load(self) -> list:
        if not self.grid.exists():
            return [None, None, 0, -math.inf, 0]
        return list(self.grid.get())

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        start, stop, number, seen, late = self._load()
        for r in _sorted(rows).to_dict("records"):
            t = float(r["t"])
            seen = max(seen, t)
            if r["stream"] == START:
                start = t if start is None else start
            elif r["stream"] == END:
                stop = t if stop is None else max(stop, t)
            elif r["stream"] in self.streams and r["value"] is not None:
                if start is not None and number and t < start + (number - 1) * self.step + self.tolerance:
                    late += 1  # a tick that it might have been nearest to is decided
                if start is None or t >= start + number * self.step - self.tolerance:
                    self.items.updateValue((r["stream"], t, int(r["seq"])), (r["value"],))
        self.grid.update((start, stop, number, seen, late))
        self._wait(start, stop, number, seen, timerValues)
        return iter([self._table(key, [])])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        start, stop, number, seen, late = self._load()
        now = timerValues.getCurrentWatermarkInMs() / 1000
        over = stop is not None and start is not None and now >= stop + self.tolerance or self.idle is not None and now >= seen + self.idle
        last = stop if stop is not None else math.inf if not over else math.nextafter(seen, math.inf)
        held: dict[str, list[tuple[float, int, str]]] = {s: [] for s in self.streams}
        for (stream, t, seq), (value,) in self.items.iterator():
            held[stream].append((t, seq, value))
        out = []
        while start is not None and (tick := start + number * self.step) < last and (over or tick + self.tolerance <= now):
            out.append((number, tick, late, [nearest(held[s], tick, self.tolerance) for s in self.streams]))
            number += 1
        if over:
            self.items.clear()
            self.grid.clear()
        else:
            bound = -math.inf if start is None else start + number * self.step - self.tolerance
            for stream, own in held.items():
                for t, seq, _ in own:
                    if t < bound:
                        self.items.removeKey((stream, t, seq))
            self.grid.update((start, stop, number, seen, late))
            self._wait(start, stop, number, seen, timerValues)
        return iter([self._table(key, out)])

    def _wait(self, start: float | None, stop: float | None, number: int, seen: float, timerValues) -> None:
        """One timer: when the next tick may be decided, or the key ends."""
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        times = []
        if start is not None:
            tick = start + number * self.step
            times.append((tick if stop is None or tick < stop else stop) + self.tolerance)
        if self.idle is not None:
            times.append(seen + self.idle)
        if times:
            # a timer in the past would fire no more
            self.handle.registerTimer(max(_millis(min(times)), timerValues.getCurrentWatermarkInMs() + 1))

    def _table(self, key, out: list[tuple]) -> pd.DataFrame:
        columns = {"key": [key[0]] * len(out), "candidate_index": [x[0] for x in out], "t": [x[1] for x in out], "late": [x[2] for x in out]}
        kinds = {"key": object, "candidate_index": "int64", "t": "float64", "late": "int64"}
        for i, s in enumerate(self.streams):
            columns |= {f"{s}_dt": [x[3][i] and x[3][i][0] for x in out], f"{s}_value": [x[3][i] and x[3][i][1] for x in out]}
            kinds |= {f"{s}_dt": "float64", f"{s}_value": object}
        return pd.DataFrame(columns).astype(kinds)

    def close(self) -> None:
        pass


def bundle_stream(rows: DataFrame, streams: list[str], step: float, tolerance: float, delay: str = "1 second", idle: float | None = None) -> DataFrame:
    """One row for each tick of a key: candidate_index, t, and ``<stream>_dt`` and ``<stream>_value`` of the nearest items.

    ``rows`` has key, stream, t, value and seq, all streams united.  ``delay`` is how long a row may be late by event time; any
    key's rows move the watermark.  ``late`` tells how many of the key's items had come too late by then.
    """
    timed = rows.withColumn("ts", F.timestamp_micros((F.col("t") * 1_000_000).cast("long"))).withWatermark("ts", delay)
    schema = ", ".join(["key string, candidate_index long, t double, late long", *[f"{s}_dt double, {s}_value string" for s in streams]])
    work = TickProcessor(streams, step, tolerance, idle)
    return timed.groupBy("key").transformWithStateInPandas(work, outputStructType=_struct(schema), outputMode="append", timeMode="eventTime")


class WatchdogProcessor(StatefulProcessor):
    """Tells when a key has been silent for so long, and when it is back; a timer tells, no row need come."""

    def __init__(self, most: float, by_clock: bool) -> None:
        self.most, self.by_clock = most, by_clock

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", _struct("t double, due long, silent boolean"))

    def _now(self, timerValues) -> int:
        return timerValues.getCurrentProcessingTimeInMs() if self.by_clock else timerValues.getCurrentWatermarkInMs()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        times = [float(t) for part in rows for t in part["t"]]
        t, due, silent = self.last.get() if self.last.exists() else (-math.inf, None, False)
        told = []
        if max(times) > t:
            if due is not None and self._now(timerValues) >= due:
                # the time was up before these rows, in this very batch
                told.append(("stale", t))
                silent = True
            if silent:
                told.append(("back", max(times)))
            t = max(times)
            if due is not None:
                self.handle.deleteTimer(due)
            # by the clock from now on; by event time from the row on
            due = self._now(timerValues) + _millis(self.most) if self.by_clock else max(_millis(t + self.most), self._now(timerValues) + 1)
            self.handle.registerTimer(due)
            self.last.update((t, due, False))
        return iter([self._table(key, told)])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        t, _, _ = self.last.get()
        self.last.update((t, None, True))
        return iter([self._table(key, [("stale", t)])])

    @staticmethod
    def _table(key, told: list[tuple[str, float]]) -> pd.DataFrame:
        return pd.DataFrame({"key": [key[0]] * len(told), "event": [e for e, _ in told], "last": [t for _, t in told]}).astype({"key": object, "event": object, "last": "float64"})

    def close(self) -> None:
        pass


def watchdog(rows: DataFrame, most: float, delay: str = "0 seconds", by_clock: bool = False) -> DataFrame:
    """``rows``: key and t.  A row ``stale`` when nothing of a key has come for ``most`` seconds, and ``back`` when it does again.

    Time is that of the rows, which any key's rows move on, or the machine's clock if ``by_clock``.
    """
    timed = rows.withColumn("ts", F.timestamp_micros((F.col("t") * 1_000_000).cast("long")))
    timed = timed if by_clock else timed.withWatermark("ts", delay)
    return timed.groupBy("key").transformWithStateInPandas(WatchdogProcessor(most, by_clock), outputStructType=_struct("key string, event string, last double"), outputMode="append", timeMode="processingTime" if by_clock else "eventTime")


__all__ = ["END", "START", "TickProcessor", "WatchdogProcessor", "bundle_stream", "nearest", "watchdog"]
