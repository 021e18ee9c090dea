"""Scalar building blocks as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAN = float("nan")


def c(name: str) -> Column:
    """A column by its literal name, which may hold dots or slashes."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_finite(x: Column) -> Column:
    """Neither null, NaN nor infinite."""
    x = x.cast("double")
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def to_number(x: Column) -> Column:
    """Double, null where the value is not a number."""
    return x.try_cast("double")


def usable(x: Column) -> Column:
    """The number, with NaN made null, as statistics leave both out."""
    return F.nanvl(to_number(x), F.lit(None).cast("double"))


def truth(x: Column) -> Column:
    """0.0 or 1.0: null counts as false, NaN as true."""
    return F.coalesce(x.cast("boolean").cast("int"), F.lit(0))


def float_list(x: Column, longest: int | None = None) -> Column:
    """Array of float32, cut to a length; null if any element is not a number."""
    kept = F.slice(x, 1, longest) if longest is not None else x
    cast = F.transform(kept, lambda v: v.try_cast("float"))
    return F.when(F.forall(F.arrays_zip(kept.alias("a"), cast.alias("b")), lambda p: p["b"].isNotNull()), cast)


def vector_problem(x: Column, dim: int) -> Column:
    """Null for a vector of ``dim`` finite numbers, else what is wrong: missing, size or not_finite."""
    return F.when(x.isNull(), "missing").when(F.size(x) != dim, "size").when(~F.forall(x, is_finite), "not_finite")


def parse_json(s: Column) -> Column:
    """A struct: kind (object, value or error), and the text of the object or of the value.

    Anything but an object is a value; text that does not parse is an error and is kept raw.
    """
    parsed = F.try_parse_json(s)
    shape = F.schema_of_variant(parsed)
    kind = F.when(parsed.isNull(), "error").when(shape.startswith("OBJECT"), "object").otherwise("value")
    return F.struct(kind.alias("kind"), F.when(parsed.isNull(), s).otherwise(F.to_json(parsed)).alias("text"))


def first_present(m: Column, *keys: str) -> Column:
    """Value of the first key that a map has; a present null ends the search."""
    out = F.lit(None)
    for key in reversed(keys):
        out = F.when(F.map_contains_key(m, key), F.element_at(m, key)).otherwise(out)
    return out


def nested(s: Column, path: str, kind: str, default=None) -> Column:
    """A value in JSON text by path, cast; the default where it is missing."""
    found = F.try_variant_get(F.try_parse_json(s), path, kind)
    return found if default is None else F.coalesce(found, F.lit(default))


def stamp_seconds(seconds: Column, nanos: Column) -> Column:
    return seconds.cast("double") + nanos.cast("double") * 1e-9


def stamp_nanos(seconds: Column, nanos: Column) -> Column:
    return seconds.cast("long") * 1_000_000_000 + nanos.cast("long")


def split_nanos(nanos: Column) -> Column:
    """Seconds and nanoseconds of an integer stamp."""
    n = nanos.cast("long")
    seconds = F.floor(n / F.lit(1_000_000_000).cast("decimal(20,0)")).cast("long")
    return F.struct(seconds.alias("sec"), (n - seconds * 1_000_000_000).alias("nanosec"))


def frame_path(episode: Column, frame: Column, root: str = "") -> Column:
    return F.format_string(root + "episode_%06d/frame_%06d.png", episode, frame)


def episode_path(episode: Column, root: str = "") -> Column:
    return F.format_string(root + "episode_%06d.parquet", episode)


def resolve_path(path: Column, root: str) -> Column:
    """Absolute paths stay; others are under the root."""
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))


def frame_id(s: Column) -> Column:
    """Serial and frame number of ``serial|fid=N``; both null where the text is not that."""
    pattern = r"^([\s\S]+)\|fid=(\d+)$"
    ok = s.rlike(pattern)
    return F.struct(F.when(ok, F.regexp_extract(s, pattern, 1)).alias("serial"), F.when(ok, F.regexp_extract(s, pattern, 2).cast("long")).alias("frame"))


def sorted_json(m: Column) -> Column:
    """JSON of a map, by key; an empty object for null."""
    return F.coalesce(F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m)))), F.lit("{}"))


def three(x: Column) -> Column:
    """The first three elements, zeros where there are fewer."""
    return F.slice(F.concat(F.coalesce(x, F.array().cast("array<double>")), F.array(*[F.lit(0.0)] * 3)), 1, 3)


def clip(x: Column, low: Column | float, high: Column | float) -> Column:
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.least(F.greatest(x, lit(low)), lit(high))


def midpoint(a: Column, b: Column) -> Column:
    return (a + b) / 2


def wide(x: Column, names: list[str]) -> list[Column]:
    """One column for each element, by name."""
    return [F.get(x, F.lit(i)).alias(n) for i, n in enumerate(names)]
