"""Aggregates over scalar and vector columns."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import c, is_finite, to_number, truth, usable
from ..sources.durable import saved


#: Values of which one task makes an exact choice, and parts of a sketch's ranks.
FEW, ACCURACY = 10_000, 1000


def exact_order(df: DataFrame, asks: list[tuple[Column, int]], few: int = FEW, accuracy: int = ACCURACY) -> list[float]:
    """The ``rank``-th least value, from 0, of each asked column of numbers; nulls do not count.

    Selection by narrowing: a mergeable sketch of bounded size gives two values between which the rank lies, exact
    counts of what is below and between them confirm it, and the same goes on between the two.  A pass keeps about
    one value in accuracy / 4, so few passes do however large the table is; no task gathers more than ``few`` values of a column.
    """
    inf = float("inf")
    known = [(-inf, inf, 0, 0)] * len(asks)  # least and greatest value that it may be, how many are below and between
    trial = [(-inf, inf)] * len(asks)
    found: list[float | None] = [None] * len(asks)
    within = lambda x, s: (x >= F.lit(s[0])) & (x <= F.lit(s[1]))

    def run(exprs: dict) -> dict:
        return df.agg(*[e.alias(n) for n, e in exprs.items()]).first().asDict() if exprs else {}

    while None in found:
        left = [i for i, x in enumerate(found) if x is None]
        counts = run({f"{k}{i}": F.count_if(e) for i in left for k, e in (("below", asks[i][0] < F.lit(trial[i][0])), ("inside", within(asks[i][0], trial[i])))})
        for i in left:
            (low, high), rank, (least, most, under, held) = trial[i], asks[i][1], known[i]
            below, inside = counts[f"below{i}"], counts[f"inside{i}"]
            if below <= rank < below + inside:
                known[i] = (low, high, below, inside)
            elif rank < below:
                known[i] = (least, math.nextafter(low, -inf), under, below - under)
            else:
                known[i] = (math.nextafter(high, inf), most, below + inside, under + held - below - inside)
            if known[i][0] == known[i][1]:
                found[i] = known[i][0]
        left = [i for i in left if found[i] is None]
        small = [i for i in left if known[i][3] <= few]
        values = run({f"v{i}": F.array_sort(F.collect_list(F.when(within(asks[i][0], known[i]), asks[i][0]))) for i in small})
        for i in small:
            found[i] = values[f"v{i}"][asks[i][1] - known[i][2]]
        sketches = {}
        for i in set(left) - set(small):
            at, step = (asks[i][1] - known[i][2] + 0.5) / known[i][3], 2 / accuracy
            places = F.array(*[F.lit(min(1.0, max(0.0, x))) for x in (at - step, at, at + step)])
            sketches[f"s{i}"] = F.percentile_approx(F.when(within(asks[i][0], known[i]), asks[i][0]), places, F.lit(accuracy))
        for name, (low, middle, high) in run(sketches).items():
            i = int(name[1:])
            # few values that are many times there: one of them alone
            trial[i] = (middle, middle) if (low, high) == known[i][:2] or trial[i] == (low, high) else (low, high)
    return found


def column_stats(df: DataFrame, columns: list[str], accuracy: int | None = None) -> DataFrame:
    """Per column that exists and has numbers: count, mean, median, 95th percentile and greatest of the magnitudes.

    Percentiles are exact, interpolated between the two nearest values, whatever the number of rows (``exact_order``); the
    columns are written once, as they are read several times.  With ``accuracy`` percentiles come
    from mergeable sketches of bounded size, off by one part in that many ranks.
    """
    present = [n for n in columns if n in df.columns]
    schema = "column string, n long, mean double, p50 double, p95_abs double, max_abs double"
    if not present:
        return df.sparkSession.createDataFrame([], schema)
    if accuracy:
        long = df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("column"), usable(c(n)).alias("v")) for n in present])).alias("s")).select("s.column", "s.v").where("v is not null")
        sketch = lambda x, q: F.percentile_approx(x, F.lit(q), F.lit(accuracy))
        return long.groupBy("column").agg(F.count("*").alias("n"), F.avg("v").alias("mean"), sketch(F.col("v"), 0.5).alias("p50"), sketch(F.abs("v"), 0.95).alias("p95_abs"), F.max(F.abs("v")).alias("max_abs"))
    plain = saved(df.select(*[usable(c(n)).cast("double").alias(f"v{i}") for i, n in enumerate(present)]), "columns")
    totals = plain.agg(*[e.alias(f"{k}{i}") for i in range(len(present)) for k, e in (("n", F.count(f"v{i}")), ("mean", F.avg(f"v{i}")), ("max", F.max(F.abs(f"v{i}"))))]).first()
    asks, places = [], []
    for i in range(len(present)):
        for x, q in ((F.col(f"v{i}"), 0.5), (F.abs(f"v{i}"), 0.95)):
            if totals[f"n{i}"]:
                at = (totals[f"n{i}"] - 1) * q
                asks += [(x, int(at)), (x, min(int(at) + 1, totals[f"n{i}"] - 1))]
                places.append((i, q, at - int(at)))
    values = exact_order(plain, asks)
    found = {(i, q): values[2 * k] + share * (values[2 * k + 1] - values[2 * k]) if share else values[2 * k] for k, (i, q, share) in enumerate(places)}
    rows = [(n, totals[f"n{i}"], totals[f"mean{i}"], found[i, 0.5], found[i, 0.95], totals[f"max{i}"]) for i, n in enumerate(present) if totals[f"n{i}"]]
    return df.sparkSession.createDataFrame(rows, schema)


def rates(df: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """One row: the share of rows for which each flag is true; null counts as false."""
    return df.agg(*[F.avg(truth(e)).alias(n) for n, e in flags.items()])


def vector_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column and dimension: mean, population deviation, least, greatest and count."""
    sides = [df.select(F.lit(n).alias("column"), F.posexplode(c(n)).alias("dim", "v")) for n in columns]
    long = sides[0]
    for more in sides[1:]:
        long = long.unionByName(more)
    v = F.col("v").cast("double")
    return long.groupBy("column", "dim").agg(F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"), F.count("*").alias("count"))


def vector_summary(x: Column, shown: int = 8) -> Column:
    """Size, least, greatest, mean and first values of an array."""
    wide = x.cast("array<double>")
    total = F.aggregate(wide, F.lit(0.0), lambda a, v: a + v)
    return F.struct(F.size(x).alias("size"), F.array_min(wide).alias("min"), F.array_max(wide).alias("max"), F.when(F.size(x) > 0, total / F.size(x)).alias("mean"), F.slice(wide, 1, shown).alias("first"))


def constant_values(df: DataFrame, columns: list[str], shown: int = 100) -> DataFrame:
    """Per column its first distinct values as sorted text, ``shown`` at most, and whether there is one at most."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("column"), c(n).cast("string").alias("v")) for n in columns])).alias("s")).select("s.column", "s.v")
    # every task keeps its first values only, so that no cell grows with the table
    place = F.row_number().over(W.partitionBy("column").orderBy(F.asc_nulls_last("v")))
    first = long.distinct().withColumn("place", place).where(F.col("place") <= shown + 1)
    values = F.array_sort(F.collect_list("v"))
    return first.groupBy("column").agg(F.slice(values, 1, shown).alias("values"), (F.count("v") <= 1).alias("constant"))


def distinct_indices(df: DataFrame, index: Column, size: Column) -> DataFrame:
    """One row, ``distinct``: how many different numbers there are, most of which are expected to be whole ones of 0 .. size-1.

    Those are marked in bitmaps, one for 32,768 numbers, so that bits are shuffled instead of values; only others are
    compared by value.
    """
    n = df.select(index.cast("double").alias("n"), size.alias("size")).where("n is not null")
    inside = (F.col("n") >= 0) & (F.col("n") < F.col("size")) & (F.col("n") == F.floor("n"))
    number = F.col("n").cast("long") + 1
    bits = n.where(inside).groupBy(F.bitmap_bucket_number(number).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))
    marked = bits.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("marked"))
    others = n.where(~F.coalesce(inside, F.lit(False))).agg(F.count_distinct("n").alias("others"))
    return marked.crossJoin(others).select((F.col("marked") + F.col("others")).alias("distinct"))  # one row by one row


def index_health(df: DataFrame, index: str, size: Column | int) -> DataFrame:
    """One row: rows, missing or non-numeric, out of range and repeated indices into a store."""
    n, size = to_number(c(index)), size if isinstance(size, Column) else F.lit(size)
    outside = F.count_if((n < 0) | (n >= size))
    told = df.agg(F.count("*").alias("rows"), F.count_if(n.isNull()).alias("missing"), outside.alias("outside"), F.count(n).alias("known__"))
    both = told.crossJoin(distinct_indices(df, n, size))  # one row by one row
    return both.select("rows", "missing", "outside", (F.col("known__") - F.col("distinct")).alias("repeated"))


def greatest_difference(df: DataFrame, key: str, left: str, right: str) -> DataFrame:
    """One row: the greatest difference of two vectors' elements, and where it is (first key and dimension on ties)."""
    pair = df.select(c(key).alias("key"), F.posexplode(F.arrays_zip(c(left).alias("a"), c(right).alias("b"))).alias("dim", "p"))
    d = F.abs(F.col("p.a").cast("double") - F.col("p.b").cast("double"))
    pair = pair.select("key", "dim", d.alias("d"))
    return pair.agg(F.max(F.struct("d", (-F.col("key")).alias("k"), (-F.col("dim")).alias("i"))).alias("m")).select(F.col("m.d").alias("max_diff"), (-F.col("m.k")).alias("key"), (-F.col("m.i")).alias("dim"))


def all_close(a: Column, b: Column, tolerance: float) -> Column:
    """Aggregate: whether all pairs differ by the tolerance at most; not if any is missing or NaN."""
    return F.bool_and(F.coalesce(is_finite(a - b) & (F.abs(a - b) <= tolerance), F.lit(False)))


def mean_absolute_error(a: Column, b: Column) -> Column:
    """Of two arrays of equal length."""
    total = F.aggregate(F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: F.abs(x - y)), F.lit(0.0), lambda s, v: s + v)
    return total / F.size(a)


def actual_rate(df: DataFrame, by: list[str], time: str, least: float) -> DataFrame:
    """Frames and frame rate in tumbling spans of at least ``least`` seconds of logged times."""
    span = F.floor(F.col(time) / F.lit(least)).cast("long")
    out = df.groupBy(*by, span.alias("span")).agg(F.count("*").alias("frames"), (F.max(time) - F.min(time)).alias("elapsed"))
    return out.withColumn("fps", F.when(F.col("elapsed") > 0, (F.col("frames") - 1) / F.col("elapsed")))


def counters(df: DataFrame, by: list[str], ok: str, reason: str) -> DataFrame:
    """Per key: candidates, accepted and rejected rows, and rejected rows by reason."""
    one = df.groupBy(*by, reason).agg(F.count("*").alias("n"), F.count_if(F.col(ok)).alias("saved__"))
    return one.groupBy(*by).agg(
        F.sum("n").alias("candidates"), F.sum("saved__").alias("saved"), (F.sum("n") - F.sum("saved__")).alias("skipped"), F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("saved__") == 0, F.struct(reason, "n"))))).alias("reasons")
    )


def first_known(df: DataFrame, by: list[str], value: str, order: str) -> DataFrame:
    """Per key the first value, in order, that is not null."""
    return df.where(F.col(value).isNotNull()).groupBy(*by).agg(F.min_by(value, order).alias(value))
