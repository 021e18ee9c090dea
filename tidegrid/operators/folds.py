"""Sequential folds over the rows of an episode, where each step needs the last result.

Poses are folded row by row as they stream past in order, so that an episode need not fit in memory; episodes are
independent.  Folds of one number go further: a step is a map of numbers that is, piece by piece, a shift or a constant,
and so are steps one after the other.  An endless episode is therefore cut into stretches that are summed up
at the same time, each by the map from the state before it to the state after it; with the states at
their beginnings known, the stretches are folded at the same time as well.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.durable import saved

_INF = float("inf")


def _conj(q: np.ndarray) -> np.ndarray:
    return q * np.array([-1.0, -1.0, -1.0, 1.0])


def _mul(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    v = p[3] * q[:3] + q[3] * p[:3] + np.cross(p[:3], q[:3])
    return np.append(v, p[3] * q[3] - p[:3] @ q[:3])


def _unit(q: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(q)
    return q / n if np.isfinite(n) and n > 1e-8 else np.array([0.0, 0.0, 0.0, 1.0])


def _log(q: np.ndarray) -> np.ndarray:
    q = q if q[3] >= 0 else -q
    half = np.linalg.norm(q[:3])
    angle = 2 * np.arctan2(half, q[3])
    return q[:3] * (2 + angle**2 / 12 if angle < 1e-3 else angle / np.sin(angle / 2))


def _exp(r: np.ndarray) -> np.ndarray:
    angle = np.linalg.norm(r)
    scale = 0.5 - angle**2 / 48 if angle < 1e-3 else np.sin(angle / 2) / angle
    return np.append(r * scale, np.cos(angle / 2))


def _turn(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    return _mul(_mul(q, np.append(v, 0.0)), _conj(q))[:3]


def _types(df: DataFrame, *names: str) -> str:
    return ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names)


def _stream(df: DataFrame, by: str, order: str, columns: list[str], result: dict[str, str], fresh: Callable[[], Callable[..., tuple]]) -> DataFrame:
    """Rows of each key in order through a step of its own; the step gives the values of ``result``."""
    given = df.select(by, order, *columns).repartition(by).sortWithinPartitions(by, order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, step = object(), None
        for batch in batches:
            rows = []
            for k, *values in zip(batch.column(0).to_pylist(), *(batch.column(i).to_pylist() for i in range(2, batch.num_columns)), strict=True):
                if k != key or step is None:
                    key, step = k, fresh()
                rows.append(step(*values))
            told = [pa.array([r[i] for r in rows], type=_ARROW[t]) for i, t in enumerate(result.values())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *told], names=[by, order, *result])

    return given.mapInArrow(run, ", ".join([_types(df, by, order), *[f"{n} {t}" for n, t in result.items()]]))


_ARROW = {"double": pa.float64(), "boolean": pa.bool_(), "array<double>": pa.list_(pa.float64())}


class Pieces:
    """A map of numbers: from each of ``left`` on, up to the next, x + shift where ``moves``, else the constant ``shift``."""

    def __init__(self, left: list[float], moves: list[bool], shift: list[float]) -> None:
        self.left, self.moves, self.shift = left, moves, shift

    @staticmethod
    def cut(edges: list[float], of: Callable[[float], tuple[bool, float]]) -> Pieces:
        """The map that is ``of(x)``, whether it moves and by how much, and changes at ``edges`` only."""
        edges = sorted({e for e in edges if math.isfinite(e)})
        middles = [edges[0] - 1, *[(a + b) / 2 for a, b in zip(edges, edges[1:], strict=False)], edges[-1] + 1] if edges else [0.0]
        return Pieces([-_INF, *edges], *map(list, zip(*map(of, middles), strict=True)))

    def at(self, x: float) -> float:
        i = bisect_right(self.left, x) - 1
        return x + self.shift[i] if self.moves[i] else self.shift[i]

    def constant(self) -> float | None:
        return self.shift[0] if len(self.left) == 1 and not self.moves[0] else None

    def then(self, after: Pieces) -> Pieces:
        """This map, and ``after`` of its result."""
        left, moves, shift = [], [], []

        def add(at: float, move: bool, by: float) -> None:
            if not left or (moves[-1], shift[-1]) != (move, by):
                left.append(at)
                moves.append(move)
                shift.append(by)

        for i, (at, move, by) in enumerate(zip(self.left, self.moves, self.shift, strict=True)):
            if not move:
                add(at, False, after.at(by))
                continue
            end = self.left[i + 1] if i + 1 < len(self.left) else _INF
            j = bisect_right(after.left, at + by) - 1
            while True:
                add(at, after.moves[j], after.shift[j] + by if after.moves[j] else after.shift[j])
                j += 1
                if j == len(after.left) or after.left[j] - by >= end:
                    break
                at = max(at, after.left[j] - by)
        return Pieces(left, moves, shift)


_SUMMED = pa.schema([("part", pa.int32()), ("whole", pa.bool_()), ("left", pa.list_(pa.float64())), ("moves", pa.list_(pa.bool_())), ("shift", pa.list_(pa.float64())), ("end", pa.float64())])
_SUMMED_SQL = "part int, whole boolean, left array<double>, moves array<boolean>, shift array<double>, end double"


def _scan(df: DataFrame, by: str, order: str, columns: list[str], result: dict[str, str], start: float, step: Callable[..., tuple], pieces: Callable[..., Pieces], stretches: int | None) -> DataFrame:
    """A fold of one number: ``step(state, *values)`` gives the next state and the row's results, ``pieces(*values)`` the map of states.

    Rows are cut into stretches by key and order, wherever a key may have to be cut for that.
    """
    spark = df.sparkSession
    stretches = stretches or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = df.select(by, order, *columns).repartitionByRange(stretches, by, order).withColumn("part__", F.spark_partition_id())
    dealt = saved(cut, "stretches").repartition(stretches, "part__").sortWithinPartitions("part__", by, order)
    key = df.schema[by].dataType

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, last, whole, state, image, kind = None, None, None, True, start, None, None

        def told() -> pa.RecordBatch:
            rest = (image.left, image.moves, image.shift) if whole else ([], [], [])
            ends = [pa.array([x], type=kind) for x in (first, last)]
            return pa.RecordBatch.from_arrays([*[pa.array([x], type=f.type) for x, f in zip((part, whole, *rest, state), _SUMMED, strict=True)], *ends], names=[*_SUMMED.names, "first", "last"])

        for batch in batches:
            kind = batch.schema.field(0).type
            for k, *values, p in zip(batch.column(0).to_pylist(), *(batch.column(i).to_pylist() for i in range(2, batch.num_columns)), strict=True):
                if p != part:
                    if part is not None:
                        yield told()
                    part, first, last, whole, state, image = p, k, k, True, start, Pieces([-_INF], [True], [0.0])
                elif k != last:
                    last, whole, state = k, False, start
                if not whole:
                    state = step(state, *values)[0]
                elif (known := image.constant()) is not None:
                    # whatever the state was before, it is the same by now
                    image = Pieces([-_INF], [False], [step(known, *values)[0]])
                else:
                    image = image.then(pieces(*values))
        if part is not None:
            yield told()

    rows = dealt.mapInArrow(summed, f"{_SUMMED_SQL}, first {key.simpleString()}, last {key.simpleString()}").collect()  # one for each stretch
    begins, state, last = {}, start, None
    for i, r in enumerate(sorted(rows, key=lambda r: r["part"])):
        begins[r["part"]] = state if i and r["first"] == last else start
        state = Pieces(r["left"], r["moves"], r["shift"]).at(begins[r["part"]]) if r["whole"] else r["end"]
        last = r["last"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, state = None, None, start
        for batch in batches:
            out = []
            for k, *values, p in zip(batch.column(0).to_pylist(), *(batch.column(i).to_pylist() for i in range(2, batch.num_columns)), strict=True):
                if p != part:
                    part, last, state = p, k, begins[p]
                elif k != last:
                    last, state = k, start
                state, *told = step(state, *values)
                out.append(told)
            told = [pa.array([r[i] for r in out], type=_ARROW[t]) for i, t in enumerate(result.values())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *told], names=[by, order, *result])

    return dealt.mapInArrow(run, ", ".join([_types(df, by, order), *[f"{n} {t}" for n, t in result.items()]]))


def low_pass(df: DataFrame, by: str, order: str, pose: str, alpha: float) -> DataFrame:
    """Poses smoothed by a first-order filter: positions linearly, rotations along the shortest arc."""
    alpha = float(np.clip(alpha, 0.0, 1.0))

    def fresh() -> Callable[..., tuple]:
        last = None

        def step(raw) -> tuple:
            nonlocal last
            now = np.asarray(raw, dtype=float)
            now = np.append(now[:3], _unit(now[3:]))
            if last is not None:
                turn = _mul(last[3:], _exp(alpha * _log(_mul(_conj(last[3:]), now[3:]))))
                now = np.append((1 - alpha) * last[:3] + alpha * now[:3], _unit(turn))
            last = now
            return (now.tolist(),)

        return step

    return _stream(df, by, order, [pose], {"smooth": "array<double>"}, fresh)


@dataclass(frozen=True)
class Integration:
    """Gains, dead zones and bounds of incremental control."""

    gain_xy: float = 1.0
    gain_z: float = 1.0
    angular_gain: float = 1.0
    translation_dead_zone: float = 0.0
    rotation_dead_zone: float = 0.0
    low: tuple[float, float, float] = (-1e9, -1e9, -1e9)
    high: tuple[float, float, float] = (1e9, 1e9, 1e9)
    mapping: tuple = field(default=((1.0, 0.0, 0.0), (0.0, 1.0, 0.0), (0.0, 0.0, 1.0)))
    rotate: bool = True
    least_dt: float = 1e-4


def integrate(df: DataFrame, by: str, order: str, pose: str, dt: str, scale: str, enabled: str, start: list[float], how: Integration | None = None) -> DataFrame:
    """Commanded poses from the steps between input poses, bounded after each step.

    The first enabled pose only sets the origin; a row that is not enabled, or too short
    after the last, repeats the command and gives null.
    """
    how = how or Integration()
    mapping = np.array(how.mapping)

    def fresh() -> Callable[..., tuple]:
        last, at, turn = None, np.array(start[:3], dtype=float), _unit(np.array(start[3:], dtype=float))

        def step(raw, seconds, speed, on) -> tuple:
            nonlocal last, at, turn
            if not on or raw is None or seconds is None or not seconds >= how.least_dt:
                last = None if not on else last
                return (None,)
            now = np.asarray(raw, dtype=float)
            now = np.append(now[:3], _unit(now[3:]))
            if last is None:
                last = now
                return (None,)
            back = _conj(last[3:])
            moved, turned = _turn(back, now[:3] - last[:3]), _log(_mul(back, now[3:]))
            last = now
            moved = moved * (np.linalg.norm(moved) >= how.translation_dead_zone)
            turned = turned * (np.linalg.norm(turned) >= how.rotation_dead_zone)
            at = np.clip(at + mapping @ (moved * [how.gain_xy, how.gain_xy, how.gain_z] * speed), how.low, how.high)
            if how.rotate:
                turn = _unit(_mul(turn, _exp(mapping @ (how.angular_gain * turned * speed))))
            return (np.append(at, turn).tolist(),)

        return step

    return _stream(df, by, order, [pose, dt, scale, enabled], {"command": "array<double>"}, fresh)


def _clip(x: float, low: float, high: float) -> float:
    return min(max(x, low), high)


_SAME = Pieces([-_INF], [True], [0.0])


def ramp(df: DataFrame, by: str, order: str, target: str, dt: str, rate: float, start: float, low: float, high: float, stretches: int | None = None) -> DataFrame:
    """A value that follows its target by ``rate`` a second at most, within bounds; without a target it stays."""
    low, high = min(low, high), max(low, high)
    most = lambda seconds: rate * max(seconds or 0.0, 1e-3)

    def step(value: float, goal, seconds) -> tuple:
        if goal is None:
            return value, value
        m = most(seconds)
        value = _clip(value + _clip(goal - value, -m, m), low, high)
        return value, value

    def pieces(goal, seconds) -> Pieces:
        if goal is None:
            return _SAME
        m = most(seconds)

        def of(x: float) -> tuple[bool, float]:
            by = m if x < goal - m else -m if x > goal + m else None
            if by is None:
                return False, _clip(goal, low, high)
            return (True, by) if low < x + by < high else (False, _clip(x + by, low, high))

        return Pieces.cut([goal - m, goal + m, low - m, low + m, high - m, high + m], of)

    return _scan(df, by, order, [target, dt], {"value": "double"}, start, step, pieces, stretches)


def rate_limit(df: DataFrame, by: str, order: str, time: str, period: float, stretches: int | None = None) -> DataFrame:
    """Whether a row is sent: not sooner than ``period`` after the last one sent; a row without a time is not."""

    def step(last: float, t) -> tuple:
        sent = t is not None and t - last >= period
        return (t if sent else last), sent

    def pieces(t) -> Pieces:
        # the last time that still lies a period back, and what comes after it
        return _SAME if t is None else Pieces([-_INF, math.nextafter(t - period, _INF)], [False, True], [float(t), 0.0])

    return _scan(df, by, order, [time], {"sent": "boolean"}, -_INF, step, pieces, stretches)


def stick_width(df: DataFrame, by: str, order: str, stick: str, dt: str, rate: float, start: float, low: float, high: float, dead_zone: float = 0.0, invert: bool = False, stretches: int | None = None) -> DataFrame:
    """Gripper width moved by a stick, and whether it changed by 1e-6 or more; without a stick it stays."""
    sign, least = -1.0 if invert else 1.0, 1e-6
    still = lambda push: push is None or abs(push) < dead_zone
    moved = lambda push, seconds: sign * push * rate * max(seconds or 0.0, 0.0)

    def step(width: float, push, seconds) -> tuple:
        new = width if still(push) else _clip(width + moved(push, seconds), low, high)
        changed = abs(new - width) >= least
        width = new if changed else width
        return width, width, changed

    def pieces(push, seconds) -> Pieces:
        if still(push):
            return _SAME
        s = moved(push, seconds)

        def of(x: float) -> tuple[bool, float]:
            new = _clip(x + s, low, high)
            if abs(new - x) < least:
                return True, 0.0
            return (True, s) if low < x + s < high else (False, new)

        return Pieces.cut([low - s, high - s, low - least, low + least, high - least, high + least], of)

    return _scan(df, by, order, [stick, dt], {"width": "double", "changed": "boolean"}, start, step, pieces, stretches)
