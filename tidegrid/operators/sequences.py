"""Episodes, segments and running state: operators over ordered rows of a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import is_finite
from ..sources.durable import saved
from .statistics import distinct_indices


def _running(by: list[str], order: list) -> W:
    return W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)


def gap_segments(df: DataFrame, by: list[str], order: list, time: str, most: float | int, name: str = "segment") -> DataFrame:
    """Numbers stretches from 0: a new one starts where a finite gap exceeds ``most``.

    Gaps that are negative, NaN or exactly ``most`` do not split.
    """
    gap = F.col(time) - F.lag(time).over(W.partitionBy(*by).orderBy(*order))
    return df.withColumn(name, F.sum((is_finite(gap) & (gap > most)).cast("long")).over(_running(by, order)))


def contiguity(df: DataFrame, by: list[str], index: str, order: list | None = None) -> DataFrame:
    """Per key: rows, and whether ``index`` runs from 0 without gap, in row order if one is given.

    Rows with a null key are left out.
    """
    for k in by:
        df = df.where(F.col(k).isNotNull())
    if order is None:
        n = F.count("*")
        good = (F.min(index) == 0) & (F.max(index) == n - 1) & (F.count_distinct(index) == n)
        return df.groupBy(*by).agg(n.alias("rows"), F.coalesce(good, F.lit(False)).alias("contiguous"))
    place = F.row_number().over(W.partitionBy(*by).orderBy(*order)) - 1
    placed = df.withColumn("place__", place)
    return placed.groupBy(*by).agg(F.count("*").alias("rows"), F.bool_and(F.coalesce(F.col("place__") == F.col(index), F.lit(False))).alias("contiguous"))


def globally_contiguous(df: DataFrame, index: str) -> DataFrame:
    """One row: rows, least, greatest and distinct indices, and whether they are 0 .. rows-1."""
    told = df.agg(F.count("*").alias("rows"), F.min(index).alias("first"), F.max(index).alias("last"))
    sized = df.select(F.col(index).alias("n")).crossJoin(F.broadcast(told.select(F.col("rows").alias("size"))))  # by one row
    both = told.crossJoin(distinct_indices(sized, F.col("n"), F.col("size")).withColumnRenamed("distinct", "indices"))  # one row by one row
    good = F.when(F.col("rows") == 0, True).otherwise((F.col("first") == 0) & (F.col("last") == F.col("rows") - 1) & (F.col("indices") == F.col("rows")))
    return both.select("rows", "first", "last", "indices", good.alias("contiguous"))


def reindex(df: DataFrame, groups: list[str], order: list, names: tuple[str, str, str] = ("index", "episode_index", "frame_index")) -> DataFrame:
    """Numbers rows, groups and rows within groups from 0, in the order of the group columns.

    Rows are only sorted within their group.  The groups' offsets come from their counts; that table has a
    row for each group, and joins by group.
    """
    index, episode, frame = names
    counts = df.groupBy(*groups).agg(F.count("*").alias("n__"))
    offsets = numbered(counts, groups, "n__", episode, "start__")
    placed = df.withColumn(frame, F.row_number().over(W.partitionBy(*groups).orderBy(*order)).cast("long") - 1)
    joined = placed.join(offsets, groups)
    return joined.withColumn(index, F.col("start__") + F.col(frame)).drop("n__", "start__")


def numbered(counts: DataFrame, order: list[str], size: str, number: str, start: str, buckets: int | None = None) -> DataFrame:
    """``counts`` with each row's number and the sum of earlier sizes, in order.

    The rows are range-partitioned, and written, so that all who read them see one partitioning; partitions' totals,
    one row each, give the offsets.
    """
    buckets = buckets or int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = saved(counts.repartitionByRange(buckets, *order).withColumn("part__", F.spark_partition_id()), "numbered")
    run = W.partitionBy("part__").orderBy(*order)
    before = run.rowsBetween(W.unboundedPreceding, -1)
    local = part.withColumns({"i__": F.row_number().over(run).cast("long") - 1, "s__": F.coalesce(F.sum(size).over(before), F.lit(0))})
    totals = part.groupBy("part__").agg(F.count("*").alias("rows__"), F.sum(size).alias("sum__"))
    earlier = W.orderBy("part__").rowsBetween(W.unboundedPreceding, -1)
    # a row for each of the partitions
    totals = totals.withColumns({"i0__": F.coalesce(F.sum("rows__").over(earlier), F.lit(0)), "s0__": F.coalesce(F.sum("sum__").over(earlier), F.lit(0))}).drop("rows__", "sum__")
    joined = local.join(F.broadcast(totals), "part__")
    return joined.withColumns({number: F.col("i0__") + F.col("i__"), start: F.col("s0__") + F.col("s__")}).drop("part__", "i__", "s__", "i0__", "s0__")


def episode_ranges(df: DataFrame, episode: str, index: str, fps: float) -> DataFrame:
    """Half-open index range of each episode, its length, and the range in seconds."""
    out = df.groupBy(episode).agg(F.count("*").alias("length"), F.min(index).alias("from_index"), (F.max(index) + 1).alias("to_index"))
    return out.withColumns({"from_timestamp": F.col("from_index") / F.lit(float(fps)), "to_timestamp": F.col("to_index") / F.lit(float(fps))})


def retime(df: DataFrame, frame: str, fps: float, name: str = "timestamp") -> DataFrame:
    """Timestamps on the grid of the frame rate, as float32; recorded gaps close."""
    return df.withColumn(name, (F.col(frame) / F.lit(float(fps))).cast("float"))


def running_offset(df: DataFrame, by: list[str], order: list, size: str, name: str = "offset") -> DataFrame:
    """Sum of the sizes of earlier rows of the key."""
    before = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return df.withColumn(name, F.coalesce(F.sum(size).over(before), F.lit(0)))


def rising_edge(df: DataFrame, by: list[str], order: list, state: Column, name: str = "edge") -> DataFrame:
    """Whether a state turns true; it counts as false before the first row."""
    now = F.coalesce(state, F.lit(False))
    return df.withColumn("now__", now).withColumn(name, F.col("now__") & ~F.lag("now__", 1, False).over(W.partitionBy(*by).orderBy(*order))).drop("now__")


def hysteresis(df: DataFrame, by: list[str], order: list, value: str, low: float, high: float, name: str = "on") -> DataFrame:
    """On above ``high``, off below ``low``, else as before; off at first."""
    turn = F.when(F.col(value) > high, True).when(F.col(value) < low, False)
    return df.withColumn(name, F.coalesce(F.last(turn, True).over(_running(by, order)), F.lit(False)))


def hold_last(df: DataFrame, by: list[str], order: list, columns: dict[str, Column]) -> DataFrame:
    """Adds the latest value that is not null of each expression."""
    return df.withColumns({n: F.last(e, True).over(_running(by, order)) for n, e in columns.items()})


def monotone(df: DataFrame, by: list[str], order: list, index: str) -> DataFrame:
    """Per key: rows, and how many do not exceed the one before."""
    step = F.col(index) - F.lag(index).over(W.partitionBy(*by).orderBy(*order))
    return df.withColumn("step__", step).groupBy(*by).agg(F.count("*").alias("rows"), F.count_if(F.col("step__") <= 0).alias("backward"))


def grid(spans: DataFrame, start: str, end: str, step: float | int, name: str = "t") -> DataFrame:
    """A row for each tick from start to before end, with its number ``candidate_index``."""
    n = F.greatest(F.ceil((F.col(end) - F.col(start)) / F.lit(step)), F.lit(0)).cast("int")
    ticks = spans.where(n > 0).withColumn("candidate_index", F.explode(F.sequence(F.lit(0), n - 1)))
    return ticks.withColumn("candidate_index", F.col("candidate_index").cast("long")).withColumn(name, F.col(start) + F.col("candidate_index") * F.lit(step))


def accepted_index(df: DataFrame, by: list[str], order: list, ok: str, name: str = "frame_index") -> DataFrame:
    """Numbers accepted rows from 0; null for the others."""
    count = F.sum(F.col(ok).cast("long")).over(_running(by, order))
    return df.withColumn(name, F.when(F.col(ok), count - 1))


def systematic(n: int, k: int, ends: bool = True) -> list[int]:
    """Row numbers of an even sample: ``k`` places spread over 0 .. n-1, cut to whole numbers.

    With ``ends`` the first and last row are always in it; without, a sample of one is row 0.
    """
    if n <= 0 or k <= 0 and not ends:
        return []
    spread = {int(i * (n - 1) / (k - 1)) for i in range(k)} if k > 1 else {0} if k == 1 else set()
    return sorted(spread | ({0, n - 1} if ends else set()))


def sampled_rows(df: DataFrame, k: int, ends: bool = True) -> DataFrame:
    """The rows of ``df`` at the places of an even sample, in the order in which it is read.

    A first pass counts each partition's rows, a second one keeps the chosen; nothing is shuffled.
    """
    counts = dict(df.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n")).collect())  # a row for each partition
    wanted, ids, before = systematic(sum(counts.values()), k, ends), [], 0
    for part in sorted(counts):
        ids += [(part << 33) + i - before for i in wanted if before <= i < before + counts[part]]
        before += counts[part]
    return df.where(F.monotonically_increasing_id().isin(ids))
