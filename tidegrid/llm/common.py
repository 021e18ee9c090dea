"""What the corpus operators share: durable intermediate tables and checked broadcasts."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.durable import fresh_path, saved, shared_dir

#: Rows of a side that may be broadcast, at most, and their bytes; beyond it the join shuffles.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20


#: Options of tables of large values: compressed hard, over pages that are long enough to repeat themselves.
DENSE = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9", "parquet.page.size": str(16 << 20), "parquet.enable.dictionary": "false"}


def _size(column: Column, kind: T.DataType) -> Column:
    """Bytes of a value, about."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 8
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType)):
            return F.coalesce(F.aggregate(column, F.lit(0).cast("long"), lambda a, x: a + _size(x, kind.elementType)), F.lit(0)) + 8
        return 8 * F.greatest(F.size(column), F.lit(0)) + 8
    if isinstance(kind, T.StructType):
        return sum((_size(column[f.name], f.dataType) for f in kind.fields), F.lit(8))
    return F.lit(8)


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if a count shows few rows, of few bytes; else as it is."""
    each = sum((_size(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields), F.lit(8))
    rows, size = df.select(each.cast("long").alias("size")).limit(limit + 1).agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    return F.broadcast(df) if rows <= limit and size <= BROADCAST_BYTES else df


def fold(spark: SparkSession) -> int:
    """Partitions for a shuffle whose rows Python then reads."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(column: str):
    """The text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b"").cast("binary"))


#: Bytes of rows that a task's Python looks at together, about.
TOGETHER = 4 << 20


def small_batches(batches: Iterator, size: int = TOGETHER) -> Iterator:
    """The batches cut into parts of about ``size`` bytes, so that copies of long rows stay small."""
    for batch in batches:
        parts = max(1, min(batch.num_rows, -(-batch.nbytes // size)))
        step = max(1, -(-batch.num_rows // parts))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


#: What a worker keeps between tasks, by the modules whose tasks use it: functions that drop it.
_kept: list[tuple[frozenset[str], Callable[[], None]]] = []


def keeps(*modules: str) -> Callable[[Callable[[], None]], Callable[[], None]]:
    """Registers a function that drops what tasks of these modules of the package keep in their worker."""

    def register(drop: Callable[[], None]) -> Callable[[], None]:
        _kept.append((frozenset(f"{__package__}.{m}" for m in modules), drop))
        return drop

    return register


def tidy_after(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run``, a function for ``mapInArrow``, that gives freed memory back when its task ends.

    Workers wait for their next task beside the executor, which needs the room meanwhile.  What tasks of
    other operators have left in the worker goes first.
    """

    @functools.wraps(run)
    def tidied(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for modules, drop in _kept:
            if run.__module__ not in modules:
                drop()
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library, which has no such call
                pass

    return tidied


__all__ = ["BROADCAST_BYTES", "BROADCAST_ROWS", "DENSE", "fold", "fresh_path", "keeps", "saved", "shared_dir", "small_batches", "small_side", "text_bytes", "tidy_after"]
