"""Quality rules with fences for each language and source.

Counts are taken over every whole text.  Rates derived from them go into mergeable quantile
sketches, one for each rate, language and source: a sketch counts values by
bucket, a bucket being a value without its low bits, so that its error stays under one part in
``2**(PRECISION-1)``.  Sketches merge by adding counts, give the same result in any order of
merging, and stay small whatever the input; a group's sketches also merge into those
of its language and of everything, which stand in where a group has few documents.  A rate's
fences lie a multiple of the group's spread beyond the quartiles: of the interquartile range or, where the quartiles are
one value, as in rates that are mostly 0, of the mean distance from it.  There are no fixed cutoffs: what is
rejected in one group may be usual in another.  They are joined to the documents to filter them.  A rate above its fence fails a
text only if it comes of ``EVENTS`` or more events, as one mark in a short text makes a high rate by chance.

Only DataFrame and SQL functions are used.  Null text has no words, and so fails the
base rule; null language or source is a group of its own.  Rows that repeat are
judged each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import saved, small_side

#: Significant bits of a sketch's buckets.
PRECISION = 7
#: Documents that a group needs for fences of its own.
LEAST_GROUP = 100
#: Spreads between a quartile and its fence.
REACH = 5
#: Events that a high rate takes to count.
EVENTS = 10
#: Per rate: what counts its events and how many of that are one, if it has any; and whether low values fail too.
RATES = {"word_length": (None, 1, True), "symbols": ("n_symbols", 1, False), "dup_lines": ("n_dup_lines", 1, False), "repeats": ("n_repeat_words", 16, False), "capitals": ("n_capitals", 1, False), "shouts": ("n_shouts", 1, False)}

_SPACE = r"[\\x20\\x09-\\x0D]"
_WORD = r"[^\\x20\\x09-\\x0D]"


def _let(name: str, value: str, body: str) -> str:
    """SQL that evaluates ``value`` once and uses it in ``body`` by name."""
    return f"transform(array({value}), {name} -> {body})[0]"


_COVERED = _let(
    "sorted",
    "sort_array(transform(hashes, (h, i) -> struct(h, i)))",
    _let(
        "places",
        "array_sort(transform(filter(sorted, (x, j) -> (j > 0 and get(sorted, j - 1).h = x.h) or (j < size(sorted) - 1 and get(sorted, j + 1).h = x.h)), x -> x.i))",
        "aggregate(places, named_struct('last', -8, 'total', 0L), (a, p) -> named_struct('last', p, 'total', a.total + least(8, p - a.last)), a -> a.total)",
    ),
)
_REPEATED = _let(
    "hashes",
    "transform(sequence(1, size(words) - 7), i -> xxhash64(slice(words, i, 8)))",
    f"if(size(array_distinct(hashes)) = size(hashes), 0L, {_COVERED})",
)


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", carried: Column | None = None) -> DataFrame:
    """The counts of each row's text, with the base rule's verdict and the rates; ``carried`` stays as a column."""
    more = [] if carried is None else ["carried"]
    text = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        *([] if carried is None else [carried.alias("carried")]),
    )
    split = text.select(
        *more,
        "doc_id",
        "lang",
        "source",
        F.expr(f"filter(split(text, '{_SPACE}+'), w -> w != '')").alias("words"),
        F.expr(f"filter(split(text, '\\n'), l -> l rlike '{_WORD}')").alias("lines"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        F.regexp_count("text", F.lit("!")).cast("long").alias("n_shouts"),
    )
    counted = split.select(
        *more,
        "doc_id",
        "lang",
        "source",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(f"if(size(words) < 8, 0L, {_REPEATED})").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        "n_capitals",
        "n_shouts",
    )
    rate = lambda a, b, unit: F.floor(F.col(a) * unit / F.greatest(F.col(b), F.lit(1))).cast("long")
    return counted.withColumns(
        {
            "base_failed": (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
            "word_length": rate("word_chars", "n_words", 1000),
            "symbols": rate("n_symbols", "n_words", 10000),
            "dup_lines": rate("n_dup_lines", "n_lines", 1000),
            "repeats": rate("n_repeat_words", "n_words", 1000),
            "capitals": rate("n_capitals", "word_chars", 10000),
            "shouts": rate("n_shouts", "n_words", 10000),
        }
    )


def fences(counted: DataFrame) -> DataFrame:
    """Lower and upper fence of each rate for every language and source."""
    bucket = F.expr(f"shiftleft(shiftright(value, greatest(length(bin(value)) - {PRECISION}, 0)), greatest(length(bin(value)) - {PRECISION}, 0))")
    rates = F.explode(F.array(*[F.struct(F.lit(r).alias("rate"), F.col(r).alias("value")) for r in RATES]))
    sketch = counted.where(~F.col("base_failed")).select("lang", "source", rates.alias("r")).select("lang", "source", "r.rate", F.col("r.value").alias("value"))
    sketch = sketch.groupBy("lang", "source", "rate", bucket.alias("bucket")).agg(F.count("*").alias("n"))
    # merged upwards: of each language, and of all
    merged = sketch.withColumn("up", F.explode(F.array(F.lit(0), F.lit(1), F.lit(3))))
    merged = merged.select("rate", "bucket", "n", F.col("up").alias("level"), F.when(F.col("up") < 3, F.col("lang")).alias("lang"), F.when(F.col("up") < 1, F.col("source")).alias("source"))
    merged = merged.groupBy("rate", "level", "lang", "source", "bucket").agg(F.sum("n").alias("n"))
    group = ["rate", "level", "lang", "source"]
    run = W.partitionBy(*group).orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
    merged = merged.withColumns({"upto": F.sum("n").over(run), "total": F.sum("n").over(W.partitionBy(*group))})
    at = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("total") * q, F.col("bucket")))
    whole = W.partitionBy(*group)
    merged = merged.withColumns({"q1": at(1).over(whole), "q3": at(3).over(whole)})
    apart = F.sum(F.col("n") * F.abs(F.col("bucket") - F.col("q1"))).alias("apart")
    quartiles = merged.groupBy(*group).agg(F.max("q1").alias("q1"), F.max("q3").alias("q3"), F.max("total").alias("total"), apart)
    both = F.create_map(*[x for r, (*_, low) in RATES.items() for x in (F.lit(r), F.lit(low))])
    # in units of the sketch at least, which knows values to a bucket's width only
    spread = F.when(F.col("q3") > F.col("q1"), REACH * (F.col("q3") - F.col("q1"))).otherwise(F.expr(f"{REACH} * apart div total"))
    gap = F.greatest(spread, F.expr(f"{REACH} * shiftleft(1L, greatest(length(bin(q3)) - {PRECISION}, 0))"))
    fence = quartiles.select(*group, "total", F.when(both[F.col("rate")], F.col("q1") - gap).alias("low"), (F.col("q3") + gap).alias("high"))
    wide = fence.groupBy("level", "lang", "source").agg(
        F.max("total").alias("total"), *[F.max(F.when(F.col("rate") == r, F.col(b))).alias(f"{r}_{b}") for r in RATES for b in ("low", "high")]
    )
    names = [f"{r}_{b}" for r in RATES for b in ("low", "high")]
    pack = F.struct("total", *names)
    own = wide.where("level = 0").select("lang", "source", pack.alias("own"))
    language = wide.where("level = 1").select("lang", pack.alias("language"))
    every = wide.where("level = 3").select(pack.alias("every"))
    best = F.when(F.col("own.total") >= LEAST_GROUP, F.col("own")).when(F.col("language.total") >= LEAST_GROUP, F.col("language")).otherwise(F.col("every"))
    # one row of everything, and a row for each language: sizes are those of the group list
    joined = own.join(language, "lang").withColumn("one", F.lit(1)).join(every.withColumn("one", F.lit(1)), "one")
    return joined.select("lang", "source", best.alias("fence"))


def _judged(counted: DataFrame, limits: DataFrame) -> DataFrame:
    """``counted`` with ``kept``, the verdict by the base rule and the fences of the row's group."""
    within = F.lit(True)
    for r, (events, one, low) in RATES.items():
        few = F.lit(False) if events is None else F.col(events) < EVENTS * one
        within = within & (few | (F.col(r) <= F.col(f"fence.{r}_high")))
        if low:
            within = within & (F.col(r) >= F.col(f"fence.{r}_low"))
    joined = counted.join(limits, ["lang", "source"], "left")
    return joined.withColumn("kept", F.when(F.col("base_failed"), False).otherwise(F.coalesce(within, F.lit(True))))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """Per row its counts, whether the base rule failed, and whether it is kept."""
    counted = saved(counts(docs, id_col, text_col, lang_col, source_col), "counts")
    judged = _judged(counted, small_side(saved(fences(counted), "fences"), 20_000))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_capitals", "n_shouts")


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``docs`` without the rows that the rules reject; columns stay as they are.

    Each row is judged by its own text, whatever its id.  The row travels beside its counts, so
    that no join by id is needed.
    """
    whole = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    counted = saved(counts(docs, id_col, text_col, lang_col, source_col, whole), "counts")
    judged = _judged(counted, small_side(saved(fences(counted.drop("carried")), "fences"), 20_000))
    return judged.where("kept").select(*[F.col(f"carried.c{i}").alias(c) for i, c in enumerate(docs.columns)])
