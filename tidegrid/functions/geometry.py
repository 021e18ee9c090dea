"""Poses and rotations as Column expressions over arrays.

Quaternions are [x, y, z, w].  A pose is a position and a quaternion (7 values); a state
or relative action is a position, a rotation vector and a gripper width (7 values).
Expressions repeat their arguments, so give them columns rather than long expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import is_finite

# fixed value: headset axes (y up, z back) to world axes (z up, x forward)
HEADSET_AXES = ((0.0, 0.0, -1.0), (-1.0, 0.0, 0.0), (0.0, 1.0, 0.0))


def _at(x: Column, *index: int) -> list[Column]:
    return [F.get(x, F.lit(i)).cast("double") for i in index]


def _let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.transform(F.array(value), body)[0]


def vector(*parts: Column) -> Column:
    return F.array(*[p.cast("double") for p in parts])


def as_float(x: Column) -> Column:
    return x.cast("array<float>")


def norm(x: Column) -> Column:
    return F.sqrt(F.aggregate(x, F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double")))


def normalized(q: Column, least: float = 1e-8, strict: bool = False) -> Column:
    """Unit quaternion; the identity where it is not finite or its norm is below ``least``.

    With ``strict`` a norm equal to ``least`` is too small as well.
    """
    size = norm(q)
    good = is_finite(size) & ((size > least) if strict else (size >= least))
    return F.when(good, F.transform(q, lambda v: v.cast("double") / size)).otherwise(vector(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)))


def normalized_pose(pose: Column) -> Column:
    """The pose with a unit quaternion; norms up to 1e-8 make the identity."""
    return F.concat(F.slice(pose, 1, 3).cast("array<double>"), normalized(F.slice(pose, 4, 4), strict=True))


def conjugate(q: Column) -> Column:
    x, y, z, w = _at(q, 0, 1, 2, 3)
    return vector(-x, -y, -z, w)


def product(p: Column, q: Column) -> Column:
    """Rotation q, then p."""
    return _let(F.struct(p.alias("p"), q.alias("q")), lambda s: _product(s["p"], s["q"]))


def _product(p: Column, q: Column) -> Column:
    a, b, c, d = _at(p, 0, 1, 2, 3)
    x, y, z, w = _at(q, 0, 1, 2, 3)
    return vector(d * x + a * w + b * z - c * y, d * y - a * z + b * w + c * x, d * z + a * y - b * x + c * w, d * w - a * x - b * y - c * z)


def rotate(q: Column, v: Column) -> Column:
    """Vector v turned by unit quaternion q."""
    turned = product(product(q, vector(*_at(v, 0, 1, 2), F.lit(0.0))), conjugate(q))
    return F.slice(turned, 1, 3)


def rotation_vector(q: Column) -> Column:
    """Axis times angle of a unit quaternion, the angle at most half a turn."""

    def of(q: Column) -> Column:
        x, y, z, w = _at(q, 0, 1, 2, 3)
        sign = F.when(w < 0, -1.0).otherwise(1.0)
        half = F.sqrt(x * x + y * y + z * z)
        angle = 2 * F.atan2(half, F.abs(w))
        series = 2 + angle * angle / 12 + 7 * F.pow(angle, F.lit(4)) / 2880
        scale = sign * F.when(angle <= 1e-3, series).otherwise(angle / F.sin(angle / 2))
        return vector(x * scale, y * scale, z * scale)

    return _let(q, of)


def from_rotation_vector(r: Column) -> Column:
    """Unit quaternion of a rotation vector."""

    def of(r: Column) -> Column:
        x, y, z = _at(r, 0, 1, 2)
        angle = F.sqrt(x * x + y * y + z * z)
        series = 0.5 - angle * angle / 48 + F.pow(angle, F.lit(4)) / 3840
        scale = F.when(angle <= 1e-3, series).otherwise(F.sin(angle / 2) / angle)
        return vector(x * scale, y * scale, z * scale, F.cos(angle / 2))

    return _let(r, of)


def _plus(a: Column, b: Column, sign: int = 1) -> Column:
    return F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x + sign * y)


def state7(pose: Column, width: Column) -> Column:
    """Position, rotation vector and gripper width of a pose, as float32."""
    unit = as_float(normalized(as_float(F.slice(pose, 4, 4))))
    return as_float(F.concat(as_float(F.slice(pose, 1, 3)).cast("array<double>"), rotation_vector(unit), vector(width)))


def relative_action7(target: Column, current: Column, width: Column) -> Column:
    """Step from one pose to another in world axes, with the absolute gripper width, as float32."""
    t, u = (as_float(normalized(as_float(F.slice(p, 4, 4)))) for p in (target, current))
    step = _plus(as_float(F.slice(target, 1, 3)), as_float(F.slice(current, 1, 3)), -1)
    return as_float(F.concat(step, rotation_vector(normalized(product(t, conjugate(u)))), vector(width)))


def apply_action7(action: Column, current: Column) -> Column:
    """The target pose of a relative action: the inverse of ``relative_action7``, as float32."""
    turn = product(from_rotation_vector(F.slice(action, 4, 3)), normalized(as_float(F.slice(current, 4, 4))))
    return as_float(F.concat(_plus(F.slice(current, 1, 3), F.slice(action, 1, 3)), normalized(turn)))


def local_delta(before: Column, now: Column) -> Column:
    """Step between poses in the earlier one's axes: position and rotation vector."""
    back = conjugate(normalized(F.slice(before, 4, 4)))
    moved = rotate(back, _plus(F.slice(now, 1, 3), F.slice(before, 1, 3), -1))
    return F.concat(moved, rotation_vector(normalized(product(back, normalized(F.slice(now, 4, 4))))))


def matrix_times(m: tuple[tuple[float, ...], ...], v: Column) -> Column:
    parts = _at(v, *range(len(m[0])))
    rows = []
    for row in m:
        total = F.lit(0.0)
        for k, x in zip(row, parts, strict=True):
            total = total + F.lit(k) * x
        rows.append(total)
    return vector(*rows)


def quaternion_of(m: list[Column]) -> Column:
    """Unit quaternion of a rotation matrix given by rows."""
    a, b, c, d, e, f, g, h, i = m
    trace = a + e + i
    options = [
        vector(h - f, c - g, d - b, trace + 1),
        vector(a - e - i + 1, b + d, c + g, h - f),
        vector(b + d, e - a - i + 1, f + h, c - g),
        vector(c + g, f + h, i - a - e + 1, d - b),
    ]
    pick = F.when(trace > 0, options[0]).when((a >= e) & (a >= i), options[1]).when(e >= i, options[2]).otherwise(options[3])
    return normalized(pick)


def matrix_pose(m: Column) -> Column:
    """Pose of a 3 by 4 matrix, given as 12 values by rows."""
    x = _at(m, *range(12))
    rotation = [x[r * 4 + k] for r in range(3) for k in range(3)]
    return F.concat(vector(x[3], x[7], x[11]), quaternion_of(rotation))


def change_axes(pose: Column, axes: tuple[tuple[float, ...], ...] = HEADSET_AXES) -> Column:
    """The pose in other axes."""
    turn = quaternion_of([F.lit(v) for row in axes for v in row])
    unit = normalized(F.slice(pose, 4, 4))
    return F.concat(matrix_times(axes, F.slice(pose, 1, 3)), product(product(turn, unit), conjugate(turn)))


def relative_to(pose: Column, base: Column, axes: tuple[tuple[float, ...], ...] = HEADSET_AXES) -> Column:
    """A pose as seen from another one, in other axes."""
    back = conjugate(normalized(F.slice(base, 4, 4)))
    moved = rotate(back, _plus(F.slice(pose, 1, 3), F.slice(base, 1, 3), -1))
    return change_axes(F.concat(moved, product(back, normalized(F.slice(pose, 4, 4)))), axes)


def dead_zone(v: Column, least: float) -> Column:
    """Zeros for a vector shorter than ``least``."""
    return F.when(norm(v) < least, F.transform(v, lambda _: F.lit(0.0))).otherwise(v.cast("array<double>"))


def at_boundary(v: Column, low: list[float], high: list[float], slack: float = 1e-8) -> Column:
    """Whether any coordinate lies on or beyond its bounds."""
    out = F.lit(False)
    for i, (a, b) in enumerate(zip(low, high, strict=True)):
        x = F.get(v, F.lit(i))
        out = out | (x <= a + slack) | (x >= b - slack)
    return out


def trigger(analog: Column, pressed: Column, least: float = 1e-3) -> Column:
    """The analog value, or the button as 0 or 1 where it is idle."""
    return F.when(F.abs(analog) > least, analog.cast("double")).otherwise(pressed.cast("int").cast("double"))
