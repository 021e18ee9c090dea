"""Sequential folds, whose SQL recurs row by row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import folds
from .tables import events, table


def _spread(df: DataFrame, array: str, names: str, digits: int) -> DataFrame:
    """An array's elements as rounded columns ``<array>_<name>``."""
    return df.select("episode", "frame", *[F.round(F.get(array, F.lit(i)), digits).alias(f"{array}_{n}") for i, n in enumerate(names.split())])


def _poses(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("label").cast("long").alias("episode"), F.col("vec_id").alias("frame"), F.slice("embedding", 1, 7).cast("array<double>").alias("pose"), F.lit(0.1).alias("dt"), F.lit(0.5).alias("scale"), (F.col("vec_id") % 9 != 0).alias("enabled"))


_POSE = "px py pz qx qy qz qw"


def lowpass_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spread(folds.low_pass(_poses(spark, sf_dir), "episode", "frame", "pose", 0.3), "smooth", _POSE, 4)


def integrate_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    how = folds.Integration(gain_xy=0.8, gain_z=0.6, angular_gain=0.5, low=(-1.0, -1.0, -1.0), high=(1.0, 1.0, 1.0))
    return _spread(folds.integrate(_poses(spark, sf_dir), "episode", "frame", "pose", "dt", "scale", "enabled", [0.0] * 6 + [1.0], how), "command", _POSE, 4)


def _steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    return e.select("user_id", "event_id", (F.col("t") / 1e6).alias("s"), (F.col("value") / 20).alias("goal"), F.lit(0.5).alias("dt"), F.sin("value").alias("stick"))


def ramp_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = folds.ramp(_steps(spark, sf_dir), "user_id", "event_id", "goal", "dt", 0.4, 0.5, 0.1, 1.0)
    return out.withColumn("value", F.round("value", 6))


def rate_limit_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return folds.rate_limit(_steps(spark, sf_dir), "user_id", "event_id", "s", 43_200.0)


def width_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = folds.stick_width(_steps(spark, sf_dir), "user_id", "event_id", "stick", "dt", 0.05, 0.04, 0.0, 0.08, 0.2)
    return out.withColumn("width", F.round("width", 6))


def _clip(x: str, low: str, high: str) -> str:
    return f"least(greatest({x}, {low}), {high})"


def _scan(columns: str, source: str, start: str, step: str, result: str) -> str:
    """SQL that folds each key's rows, numbered ``i``: state after the first row, and after each next one."""
    return f"""WITH RECURSIVE e AS ({source}), f AS (
        SELECT k, o, i, {start} FROM e WHERE i = 1
        UNION ALL SELECT k, o, i, {columns} FROM ({step})
    ) {result}"""


def _next(columns: str, extra: str = "") -> str:
    """The next row of each key beside the state ``f`` before it."""
    return f"SELECT e.*, {columns}{extra} FROM f JOIN e ON e.k = f.k AND e.i = f.i + 1"


_EVENTS = "SELECT user_id AS k, event_id AS o, value / 20 AS goal, sin(value) AS stick, epoch_us(ts) / 1e6 AS s, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events"
_RAMP = lambda before: _clip(f"{before} + {_clip(f'goal - {before}', '-0.2', '0.2')}", "0.1", "1.0")
_WIDE = lambda before: f"CASE WHEN abs(stick) < 0.2 THEN {before} ELSE {_clip(f'{before} + stick * 0.025', '0.0', '0.08')} END"

_AXES = "xyz"


def _times(p: str, q: str) -> dict[str, str]:
    """Product of the quaternions in columns p?, q?."""
    return {
        "x": f"{p}w * {q}x + {q}w * {p}x + {p}y * {q}z - {p}z * {q}y",
        "y": f"{p}w * {q}y + {q}w * {p}y + {p}z * {q}x - {p}x * {q}z",
        "z": f"{p}w * {q}z + {q}w * {p}z + {p}x * {q}y - {p}y * {q}x",
        "w": f"{p}w * {q}w - {p}x * {q}x - {p}y * {q}y - {p}z * {q}z",
    }


def _named(parts: dict[str, str], name: str) -> str:
    return ", ".join(f"{x} AS {name}{k}" for k, x in parts.items())


def _unit(q: str, name: str, layer: str) -> str:
    """``layer`` with a unit quaternion ``name``; none is near zero here."""
    size = f"sqrt({' + '.join(f'{q}{k} * {q}{k}' for k in 'xyzw')})"
    return f"SELECT *, {', '.join(f'{q}{k} / {size} AS {name}{k}' for k in 'xyzw')} FROM ({layer})"


def _scaled(q: str, share: str, name: str, layer: str) -> str:
    """``layer`` with quaternion ``name``, the turn of unit quaternion q taken ``share`` times."""
    half = f"SELECT *, sqrt({q}x * {q}x + {q}y * {q}y + {q}z * {q}z) AS {name}h FROM ({layer})"
    angle = f"SELECT *, 2 * atan2({name}h, abs({q}w)) AS {name}a FROM ({half})"
    log = f"SELECT *, CASE WHEN {q}w < 0 THEN -1 ELSE 1 END * {share} * CASE WHEN {name}a < 1e-3 THEN 2 + {name}a * {name}a / 12 ELSE {name}a / sin({name}a / 2) END AS {name}k FROM ({angle})"
    turn = f"SELECT *, abs({name}k) * {name}h AS {name}t FROM ({log})"
    scale = f"SELECT *, {name}k * CASE WHEN {name}t < 1e-3 THEN 0.5 - {name}t * {name}t / 48 ELSE sin({name}t / 2) / {name}t END AS {name}s FROM ({turn})"
    return f"SELECT *, {', '.join(f'{q}{k} * {name}s AS {name}{k}' for k in _AXES)}, cos({name}t / 2) AS {name}w FROM ({scale})"


_RAW = "SELECT label AS k, vec_id AS o, vec_id % 9 <> 0 AS enabled, " + ", ".join(f"embedding[{i + 1}]::DOUBLE AS {n}" for i, n in enumerate("ax ay az gx gy gz gw".split())) + ", row_number() OVER (PARTITION BY label ORDER BY vec_id) AS i FROM embeddings"
_STATE = [f"p{k}" for k in _AXES] + [f"q{k}" for k in "xyzw"]


def _low_pass() -> str:
    before = _next(", ".join(f"f.{c} AS {'l' if c[0] == 'p' else 'j'}{c[1]}" for c in _STATE), ", " + ", ".join(f"{'-' if k != 'w' else ''}f.q{k} AS c{k}" for k in "xyzw"))
    turned = f"SELECT *, {_named(_times('c', 'u'), 'r')} FROM ({before})"
    moved = f"SELECT *, {_named(_times('j', 't'), 'm')} FROM ({_scaled('r', '0.3', 't', turned)})"
    step = _unit("m", "n", moved)
    columns = ", ".join([*[f"0.7 * l{k} + 0.3 * a{k}" for k in _AXES], *[f"n{k}" for k in "xyzw"]])
    start = ", ".join([*[f"a{k} AS p{k}" for k in _AXES], *[f"u{k} AS q{k}" for k in "xyzw"]])
    result = "SELECT k AS episode, o AS frame, " + ", ".join(f"round({c}, 4) AS smooth_{c}" for c in _STATE) + " FROM f"
    return _scan(columns, _unit("g", "u", _RAW), start, step, result)


def _integrated() -> str:
    # the step between enabled neighbours, in the earlier one's axes, does not recur
    last = ", ".join(f"lag({c}) OVER w AS l{c}" for c in ("ax", "ay", "az", "ux", "uy", "uz", "uw"))
    pairs = f"SELECT *, {last}, enabled AND coalesce(lag(enabled) OVER w, false) AS moves FROM ({_unit('g', 'u', _RAW)}) WINDOW w AS (PARTITION BY k ORDER BY i)"
    apart = f"SELECT *, ax - lax AS vx, ay - lay AS vy, az - laz AS vz, 0.0 AS vw, {', '.join(f'-lu{k} AS c{k}' for k in _AXES)}, luw AS cw FROM ({pairs})"
    half = f"SELECT *, {_named(_times('c', 'v'), 'h')}, {_named(_times('c', 'u'), 'r')} FROM ({apart})"
    whole = f"SELECT *, {_named(_times('h', 'lu'), 'd')} FROM ({half})"
    source = _scaled("r", "0.25", "t", whole)
    before = _next(", ".join(f"f.{c} AS {'j' if c[0] == 'p' else 'y'}{c[1]}" for c in _STATE))
    turned = f"SELECT *, {_named(_times('y', 't'), 'm')} FROM ({before})"
    step = _unit("m", "n", turned)
    gains = {"x": "0.4", "y": "0.4", "z": "0.3"}
    columns = ", ".join([*[f"CASE WHEN moves THEN {_clip(f'j{k} + d{k} * {g}', '-1.0', '1.0')} ELSE j{k} END" for k, g in gains.items()], *[f"CASE WHEN moves THEN n{k} ELSE y{k} END" for k in "xyzw"], "moves"])
    start = ", ".join([*[f"0.0::DOUBLE AS p{k}" for k in _AXES], *[f"{v}::DOUBLE AS q{k}" for k, v in zip("xyzw", ("0", "0", "0", "1"), strict=True)], "false AS told"])
    result = "SELECT k AS episode, o AS frame, " + ", ".join(f"CASE WHEN told THEN round({c}, 4) END AS command_{c}" for c in _STATE) + " FROM f"
    return _scan(columns, source, start, step, result)


QUERIES = {
    "lowpass_fold": (lowpass_fold, _low_pass()),
    "integrate_fold": (integrate_fold, _integrated()),
    "ramp_fold": (ramp_fold, _scan(_RAMP("before"), _EVENTS, f"{_RAMP('0.5')} AS value", _next("f.value AS before"), "SELECT k AS user_id, o AS event_id, round(value, 6) AS value FROM f")),
    "rate_limit_fold": (
        rate_limit_fold,
        _scan("CASE WHEN s - before >= 43200 THEN s ELSE before END, s - before >= 43200", _EVENTS, "s AS last, true AS sent", _next("f.last AS before"), "SELECT k AS user_id, o AS event_id, sent FROM f"),
    ),
    "width_fold": (
        width_fold,
        _scan(
            "CASE WHEN abs(wide - before) >= 1e-6 THEN wide ELSE before END, abs(wide - before) >= 1e-6",
            _EVENTS,
            f"CASE WHEN abs({_WIDE('0.04')} - 0.04) >= 1e-6 THEN {_WIDE('0.04')} ELSE 0.04 END AS width, abs({_WIDE('0.04')} - 0.04) >= 1e-6 AS changed",
            f"SELECT *, {_WIDE('before')} AS wide FROM ({_next('f.width AS before')})",
            "SELECT k AS user_id, o AS event_id, round(width, 6) AS width, changed FROM f",
        ),
    ),
}
