"""Equi, ordinal, range and multi-way joins of episode tables with their stores and logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

def keep_last(df: DataFrame, by: list[str], order: str) -> DataFrame:
    """One row for each key, the last in order."""
    row = F.struct(*[F.col(f"`{n}`") for n in df.columns])
    return df.groupBy(*by).agg(F.max_by(row, F.col(order)).alias("r")).select("r.*")


def fetch(rows: DataFrame, store: DataFrame, index: str, store_index: str = "store_index") -> DataFrame:
    """Each row with its store entry; rows without one are dropped (see ``unmatched``)."""
    return rows.join(store, rows[f"`{index}`"] == store[store_index]).drop(store[store_index])


def unmatched(rows: DataFrame, store: DataFrame, index: str, store_index: str = "store_index") -> DataFrame:
    """Rows whose index the store does not have."""
    return rows.join(store.select(store_index), rows[f"`{index}`"] == store[store_index], "left_anti")


def with_metadata(rows: DataFrame, metadata: DataFrame, on: Column, names: list[str], default: str | None = None) -> DataFrame:
    """Left join; ``default`` stands where metadata is missing."""
    joined = rows.join(metadata, on, "left")
    return joined.withColumns({n: F.coalesce(F.col(n).cast("string"), F.lit(default)) for n in names}) if default is not None else joined


def reconcile(sides: dict[str, DataFrame], key: str, value: str) -> DataFrame:
    """Full outer comparison of one value across tables: a column for each, and whether all agree.

    A key that any table lacks does not agree.
    """
    long = reduce(DataFrame.unionByName, [d.select(F.col(key), F.lit(n).alias("side__"), F.col(value).alias("v__")) for n, d in sides.items()])
    out = long.groupBy(key).agg(*[F.max(F.when(F.col("side__") == n, F.col("v__"))).alias(n) for n in sides])
    names = list(sides)
    same = reduce(lambda a, b: a & b, [F.coalesce(F.col(names[0]) == F.col(n), F.lit(False)) for n in names])
    return out.withColumn("agrees", same)


def within(rows: DataFrame, ranges: DataFrame, index: str, start: str, end: str, block: int | None = None) -> DataFrame:
    """Rows with the range that holds their index, ends excluded.

    Ranges are listed under each block of indices that they touch, and join rows by block.  A
    block is as wide as the mean range, unless it is given, so that the list is about three times as long as
    the ranges are many, however uneven their lengths.
    """
    ranges = ranges.where(F.col(start) < F.col(end))
    if block is None:
        block = max(1, int(ranges.agg(F.avg(F.col(end) - F.col(start))).first()[0] or 1))
    number = lambda x: F.floor(x / block).cast("long")
    blocks = ranges.withColumn("block__", F.explode(F.sequence(number(F.col(start)), number(F.col(end) - 1))))
    inside = (F.col(index) >= F.col(start)) & (F.col(index) < F.col(end))
    return rows.withColumn("block__", number(F.col(index))).join(blocks, "block__").where(inside).drop("block__")


def by_position(left: DataFrame, right: DataFrame, by: list[str], order_left: list, order_right: list) -> DataFrame:
    """Joins the n-th row of a key on each side; ``position`` counts from 0.  Outer on both sides."""
    place = lambda d, o: d.withColumn("position", F.row_number().over(W.partitionBy(*by).orderBy(*o)).cast("long") - 1)
    return place(left, order_left).join(place(right, order_right), [*by, "position"], "full")


#: Ordinals that one task merges.
SPAN = 1 << 16


def by_cursor(segments: DataFrame, rows: DataFrame, source: str, order: str, length: str, ordinal: str, span: int = SPAN) -> DataFrame:
    """Rows of a source in the segments that use it up one after the other, with their ``position`` in it.

    ``segments`` has the source, an order and a length; ``rows`` the source and an ordinal from 0.  Segments are intervals
    of ordinals, so both sides are merged in order: the latest segment that has begun is a row's, if it has not
    ended.  They meet in spans of ordinals, so that a source with many rows spreads over tasks, and a segment
    is listed once for each span that it touches.  Segments of no or null length hold nothing.
    """
    before = W.partitionBy(source).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    held = F.greatest(F.coalesce(F.col(length), F.lit(0)), F.lit(0)).cast("long")
    begun = segments.withColumns({"held__": held}).withColumn("first__", F.coalesce(F.sum("held__").over(before), F.lit(0))).where("held__ > 0")
    number = lambda x: F.floor(x / span).cast("long")
    listed = begun.withColumn("span__", F.explode(F.sequence(number(F.col("first__")), number(F.col("first__") + F.col("held__") - 1))))
    own = F.struct(F.col("first__").alias("first"), F.col("held__").alias("held"), F.struct(*[F.col(f"`{n}`") for n in segments.columns]).alias("s")).alias("segment__")
    left = listed.select(F.col(source).alias("source__"), "span__", F.greatest(F.col("first__"), F.col("span__") * span).alias("at__"), own, F.lit(None).cast("boolean").alias("none__"))
    others = [n for n in rows.columns if n != source]
    right = rows.where(F.col(ordinal) >= 0).select(F.col(source).alias("source__"), number(F.col(ordinal)).alias("span__"), F.col(ordinal).cast("long").alias("at__"), F.struct(*[F.col(f"`{n}`") for n in others]).alias("row__"))
    both = left.drop("none__").unionByName(right, allowMissingColumns=True)
    latest = F.last("segment__", True).over(W.partitionBy("source__", "span__").orderBy("at__", F.col("row__").isNotNull()).rowsBetween(W.unboundedPreceding, 0))
    met = both.withColumn("segment__", latest).where(F.col("row__").isNotNull() & (F.col("at__") < F.col("segment__.first") + F.col("segment__.held")))
    position = (F.col("at__") - F.col("segment__.first")).cast("int").alias("position")
    return met.select(*[F.col(f"segment__.s.`{n}`").alias(n) for n in segments.columns], position, *[F.col(f"row__.`{n}`").alias(n) for n in others if n not in segments.columns])


def assemble(df: DataFrame, by: list[str], part: str, parts: list[str], value: str, order: str) -> DataFrame:
    """One row for each key that has every part; the last of a repeated part counts."""
    columns = [F.max_by(F.when(F.col(part) == p, F.struct(value)), F.when(F.col(part) == p, F.col(order))).alias(f"`{p}`".strip("`")) for p in parts]
    out = df.where(F.col(part).isin(parts)).groupBy(*by).agg(*columns)
    complete = reduce(lambda a, b: a & b, [F.col(f"`{p}`").isNotNull() for p in parts])
    return out.where(complete).select(*by, *[F.col(f"`{p}`.{value}").alias(p) for p in parts])


def compatible(metadata: DataFrame, source: str, fields: list[str]) -> DataFrame:
    """Per source and field: its value, the first source's, and whether they are the same."""
    long = metadata.select(source, F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])).alias("s")).select(source, "s.field", "s.value")
    first = long.groupBy("field").agg(F.min_by(F.struct("value"), source).alias("f"))
    joined = long.join(F.broadcast(first), "field")  # a row for each field
    return joined.select(source, "field", "value", F.col("f.value").alias("expected"), F.col("value").eqNullSafe(F.col("f.value")).alias("same"))


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [n for n in required if n not in df.columns]


def require_columns(df: DataFrame, required: list[str], where: str) -> DataFrame:
    """``df`` itself; an error if it lacks a column."""
    absent = missing_columns(df, required)
    if absent:
        raise ValueError(f"{where}: missing columns {absent}")
    return df


def row_slice(df: DataFrame, index: str, start: int, limit: int | None, rows: int) -> DataFrame:
    """Rows start .. start + limit; a start outside the table is an error, a negative limit takes none."""
    if start < 0 or start > rows:
        raise ValueError(f"start {start} is not within 0..{rows}")
    end = rows if limit is None else min(rows, start + max(limit, 0))
    return df.where((F.col(index) >= start) & (F.col(index) < end))
