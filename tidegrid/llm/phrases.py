"""Phrases of two to four words that stand together more often than their parts alone, per language.

Contiguous pattern growth in the manner of PrefixSpan.  A phrase is as frequent at most as each of its words and pairs, so

1. words are counted; the frequent ones are known to all tasks by a bitmap of fixed size (``BITS``), which may pass
   others too, but never holds one back;
2. pairs of such words are counted by hash, for a second such bitmap, and then triples of such pairs, for a third;
3. each occurrence of such a pair is a pointer to what follows: up to two more words, as long as triples pass.  Equal
   pointers are counted together within a chunk, over a task's chunks as far as ``KEPT`` rows hold them, and after the shuffle;
   tasks take ``TASK_WORDS`` words, as each of them makes a row of its own for a phrase that it meets;
4. the pointers of a prefix of two words make up its projection, which one task grows to the right, depth first:
   in sorted order the prefixes that are open at any time are one path, so that a projection need not fit in memory.
   One task per first word alone would be given a tenth of all text for the commonest; and a pair with more than one
   in ``HOT`` of all occurrences is parted by its third word.  Its own count is the sum of its parts.

All counts are exact: bitmaps only spare work.  Words are recognised by their 64-bit hash within a chunk of ``CHUNK`` bytes
of text and by their letters everywhere else.

Defined results: a null text is empty, a null language ``und``; null or repeated ids do not matter, each row counts; other
columns are ignored.  Ties in score and count go by phrase in the order of UTF-8 bytes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import fold, saved, text_bytes, tidy_after
from .textbytes import chunks, mix, word_codes

#: Occurrences of a phrase, at least; words of a phrase, at most; phrases of each language.
LEAST, LONGEST, BEST = 30, 4, 2000
#: Bits of the bitmaps of what is frequent.
BITS = 1 << 26
#: A pair with more than one in so many of all occurrences is parted by its third word; there are fewer of them.
HOT = 1000
#: Bytes of text that are looked at together.
CHUNK = 1 << 21
#: Rows of counted pointers that a task keeps, about, to count equal ones of its chunks together.
KEPT = 1 << 20
#: Words of a task that makes pointers, about, unless that leaves cores without a task: the more, the more pointers are equal.
TASK_WORDS = 1 << 24
_U = np.uint64
_COUNTS = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])
_PAIRS = pa.schema([("pair", pa.int64()), ("n", pa.int64())])
_POINTERS = pa.schema([("lang", pa.string()), ("w1", pa.string()), ("w2", pa.string()), ("w3", pa.string()), ("w4", pa.string()), ("hot", pa.bool_()), ("n", pa.int64())])
_POINTERS_SQL = "lang string, w1 string, w2 string, w3 string, w4 string, hot boolean, n long"
_GROWN = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("m", pa.int32()), ("f", pa.int64())])
_GROWN_SQL = "lang string, phrase string, m int, f long"

_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2


def _seed(lang: str) -> np.uint64:
    return _U(int.from_bytes(blake2b(lang.encode(), digest_size=8).digest(), "little"))


class Words:
    """The words of some texts of a language: their bytes, hashes, and whether the next one is of the same piece."""

    def __init__(self, lang: str, texts: list[bytes]) -> None:
        self.raw = b"\n".join(texts).lower() + b"\n"
        buf = np.frombuffer(self.raw, dtype=np.uint8)
        kind = _KIND[buf]
        edge = np.flatnonzero(np.diff(kind != 0)) + 1
        if kind[0] == 0:
            edge = np.concatenate(([0], edge))
        self.begin, self.end = edge[0::2], edge[1::2]
        # texts end with a separator, so that words come in whole
        self.begin = self.begin[: len(self.end)]
        piece = np.searchsorted(np.flatnonzero(kind == 2), self.begin)
        self.follows = np.zeros(len(piece), dtype=bool)
        self.follows[:-1] = piece[1:] == piece[:-1]
        self.code = mix(word_codes(buf, self.begin, self.end) ^ _seed(lang))

    def pairs(self) -> np.ndarray:
        """Hash of each word with the one after it."""
        return self._joined(self.code, 1)

    def triples(self, pairs: np.ndarray) -> np.ndarray:
        return self._joined(pairs, 2)

    def _joined(self, first: np.ndarray, after: int) -> np.ndarray:
        out = np.zeros(len(self.code), dtype=np.uint64)
        out[:-after] = mix(first[:-after] * _U(0xD6E8FEB86659FD93) + self.code[after:])
        return out

    def strings(self, at: np.ndarray) -> pa.Array:
        return pa.array([self.raw[a:b].decode("utf-8", "replace") for a, b in zip(self.begin[at].tolist(), self.end[at].tolist(), strict=True)], type=pa.string())


class Bitmap:
    """What may be frequent, by the low bits of a hash."""

    def __init__(self, raw: bytes) -> None:
        self.bits = np.frombuffer(raw, dtype=np.uint8)

    def passes(self, code: np.ndarray) -> np.ndarray:
        at = (code & _U(len(self.bits) * 8 - 1)).astype(np.int64)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _words(batch: pa.RecordBatch) -> Iterator[tuple[str, Words]]:
    """Words of a batch's texts, by language and chunk."""
    by: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
        by.setdefault(lang, []).append(text)
    for lang, texts in by.items():
        for lo, hi in chunks(np.array([len(t) + 1 for t in texts]), CHUNK):
            words = Words(lang, texts[lo:hi])
            if len(words.code):
                yield lang, words


@tidy_after
def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lang, words in _words(batch):
            _, at, n = np.unique(words.code, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n)), words.strings(at), pa.array(n.astype(np.int64))], schema=_COUNTS)


def _positions(bits: int):
    """Places of words in a bitmap, from 1 on."""

    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, words in _words(pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.binary())], names=["lang", "text"])):
                yield pa.RecordBatch.from_arrays([pa.array((words.code & _U(bits - 1)).astype(np.int64) + 1)], names=["position"])

    return run


def _bitmap(positions: DataFrame, bits: int) -> bytes:
    """The bitmap of places, of ``bits`` / 8 bytes however many there are."""
    built = positions.groupBy(F.bitmap_bucket_number("position").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("position")).alias("bits"))
    out = bytearray(bits // 8)
    for row in built.collect():  # bits / 32768 rows at most
        at = (row["bucket"] - 1) * 4096
        part = bytes(row["bits"])[: bits // 8 - at]
        out[at : at + len(part)] = part
    return bytes(out)


def _passing(words: Words, bitmaps: list[Bitmap]) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """Hashes of pairs; of triples, if there is a bitmap of pairs; and where all bitmaps pass what they are of."""
    goes = bitmaps[0].passes(words.code)
    goes[:-1] &= goes[1:]
    goes &= words.follows
    pair = words.pairs()
    if len(bitmaps) == 1:
        return pair, None, goes
    goes &= bitmaps[1].passes(pair)
    return pair, words.triples(pair), goes


def _counts(*known):
    """Of pairs by the bitmap of words, or of triples by those of words and of pairs."""

    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps = [Bitmap(k.value) for k in known]
        for batch in batches:
            for _, words in _words(batch):
                pair, triple, goes = _passing(words, bitmaps)
                if triple is not None:
                    goes[:-1] &= goes[1:]
                    goes[-1] = False
                code, n = np.unique((pair if triple is None else triple)[goes], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64)), pa.array(n.astype(np.int64))], schema=_PAIRS)

    return run


class Kept:
    """Counted pointers of a task, equal ones together; words are numbers, by language and letters."""

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[tuple[str, str], int] = {}
        self.parts: list[tuple[np.ndarray, ...]] = []

    def add(self, lang: str, words: list[str], paths: list[np.ndarray], crowded: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Takes paths of places in ``words``, from 1 on; about ``limit`` rows are kept at most, others are told."""
        numbers = self.numbers
        number = np.array([0, *(numbers.setdefault((lang, w), len(numbers) + 1) for w in words)], dtype=np.int64)
        of = [number[p] for p in paths] + [np.zeros(len(n), dtype=np.int64)] * (4 - len(paths))
        self.parts.append((crowded.astype(np.int64) << 62 | of[0] << 31 | of[1], of[2] << 31 | of[3], n))
        if sum(len(p[0]) for p in self.parts) > self.limit:
            self._together()
            # few are equal: counting them over and over would save little
            if len(self.parts[0][0]) > self.limit // 4 * 3:
                yield from self.told()

    def _together(self) -> None:
        rows = pa.table([np.concatenate(c) for c in zip(*self.parts, strict=True)], names=["front", "back", "n"])
        self.parts = []
        rows = rows.group_by(["front", "back"], use_threads=False).aggregate([("n", "sum")])
        self.parts = [tuple(rows[c].to_numpy() for c in ("front", "back", "n_sum"))]

    def told(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            self._together()
            (front, back, n), low = self.parts[0], (1 << 31) - 1
            langs, words = (pa.array(c, pa.string()) for c in zip(*self.numbers, strict=True))
            for lo in range(0, len(n), 50_000):
                f, b = front[lo : lo + 50_000], back[lo : lo + 50_000]
                of = [f >> 31 & low, f & low, b >> 31, b & low]
                columns = [words.take(pa.array(o - 1, mask=o == 0)) for o in of]
                yield pa.RecordBatch.from_arrays([langs.take(pa.array(of[0] - 1)), *columns, pa.array(f >> 62 == 1), pa.array(n[lo : lo + 50_000])], schema=_POINTERS)
        self.clear()


def _pointers(known, hot, longest: int):
    """Counted pointers: a pair that may be frequent, and the words after it."""

    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmaps, crowd, kept = [Bitmap(k.value) for k in known], hot.value, Kept(KEPT)
        for batch in batches:
            for lang, words in _words(batch):
                pair, triple, goes = _passing(words, bitmaps)
                first = np.flatnonzero(goes)
                if not len(first):
                    continue
                more = goes & bitmaps[2].passes(triple)
                more[:-1] &= goes[1:]
                more[-1] = False
                _, at, name = np.unique(words.code, return_index=True, return_inverse=True)
                size = len(at)
                more = np.concatenate((more, np.zeros(longest, dtype=bool)))
                name = np.concatenate((name, np.zeros(longest, dtype=np.int64)))
                # the path of names from each pair on; 0 where it has ended
                open_, path = np.ones(len(first), dtype=bool), [name[first] + 1, name[first + 1] + 1]
                for k in range(2, longest):
                    open_ = open_ & more[first + k - 2]
                    path.append(np.where(open_, name[first + k] + 1, 0))
                packed = [reduce(lambda x, y: x * (size + 1) + y, path[k : k + 2]) for k in range(0, longest, 2)]
                order = np.lexsort(packed[::-1])
                new = np.concatenate(([True], reduce(np.logical_or, [p[order][1:] != p[order][:-1] for p in packed])))
                edge = np.flatnonzero(new)
                n = np.diff(np.append(edge, len(order)))
                chosen = order[edge]
                path = [p[chosen] for p in path]
                named = np.zeros(size + 1, dtype=bool)
                for p in path:
                    named[p] = True
                named[0] = False
                place = np.cumsum(named) * named
                crowded = np.isin(pair[first[chosen]].view(np.int64), crowd)
                spelled = words.strings(at[np.flatnonzero(named) - 1]).to_pylist()
                yield from kept.add(lang, spelled, [place[p] for p in path], crowded, n)
        yield from kept.told()

    return run


def grow(pointers: Iterable[tuple], least: int) -> Iterator[tuple[str, str, int, int]]:
    """Frequent phrases of sorted pointers (language, up to four words, whether the pair is hot, count), depth first.

    The counts of a hot pair are parts, of which some may be small, so they are told in any case.
    """
    path: list[str] = []
    counts: list[int] = []
    lang, hot = None, False

    def leave(depth: int) -> Iterator[tuple[str, str, int, int]]:
        while len(path) > depth:
            n = counts.pop()
            if len(path) >= 2 and (n >= least or hot and len(path) == 2):
                yield lang, " ".join(path), len(path), n
            path.pop()

    for of, *words, crowded, n in pointers:
        words = [w for w in words if w is not None]
        same = 0
        if of == lang:
            while same < len(path) and same < len(words) and path[same] == words[same]:
                same += 1
        yield from leave(same)
        lang = of
        if same < 2:
            hot = crowded
        for word in words[same:]:
            path.append(word)
            counts.append(0)
        for depth in range(len(words)):
            counts[depth] += n
    yield from leave(0)


def _grown(least: int):
    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        out: list[tuple] = []
        for found in grow(rows, least):
            out.append(found)
            if len(out) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True), _GROWN, strict=True)], schema=_GROWN)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True), _GROWN, strict=True)], schema=_GROWN)

    return run


def frequent_phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, longest: int = LONGEST, bits: int = BITS, hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """Per language: phrases of one to ``longest`` words with their ``f`` of ``least`` or more; and ``n``, all words."""
    spark = docs.sparkSession
    parts = fold(spark)
    plain = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text_bytes(text_col).alias("text"))
    counted = plain.mapInArrow(_word_counts, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counted = saved(counted, "words")
    total = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    single = counted.where(F.col("n") >= least)
    share = spark.sparkContext.broadcast
    known = [share(_bitmap(single.select("lang", "word").mapInArrow(_positions(bits), "position long"), bits))]
    every, crowd = 0, share(np.zeros(0, dtype=np.int64))
    for name in ("pairs", "triples"):
        counts = plain.mapInArrow(_counts(*known), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
        counts = saved(counts.where(F.col("n") >= least), name)
        if name == "pairs":
            every = counts.agg(F.sum("n")).first()[0] or 0
            crowded = counts.where(F.col("n") * hot > every).select("pair").collect()  # fewer than ``hot`` rows
            crowd = share(np.sort(np.array([r["pair"] for r in crowded], dtype=np.int64)))
        known.append(share(_bitmap(counts.select((F.col("pair").bitwiseAND(F.lit(bits - 1)) + 1).alias("position")), bits)))
    words = total.agg(F.sum("n")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-words // TASK_WORDS))
    pointers = plain.coalesce(tasks).mapInArrow(_pointers(known, crowd, longest), _POINTERS_SQL)
    pointers = pointers.groupBy(*_POINTERS.names[:-1]).agg(F.sum("n").alias("n"))
    dealt = pointers.repartition(parts, F.col("lang"), F.col("w1"), F.col("w2"), F.when(F.col("hot"), F.col("w3"))).sortWithinPartitions("lang", "w1", "w2", "w3", "w4")
    grown = dealt.mapInArrow(_grown(least), _GROWN_SQL).groupBy("lang", "phrase", "m").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    phrases = single.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("m"), F.col("n").alias("f")).unionByName(grown)
    return saved(phrases, "phrases"), total


def scored(phrases: DataFrame) -> DataFrame:
    """Candidates (lang, phrase, m, a) with the l, r and score of their lowest-scoring cut."""
    words = F.split("phrase", " ")
    cuts = phrases.where("m >= 2").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("m") - 1)))
    first, rest = F.slice(words, 1, F.col("k")), F.slice(words, F.col("k") + 1, F.col("m") - F.col("k"))
    cuts = cuts.select("lang", "phrase", "m", F.col("f").alias("a"), "k", F.array_join(first, " ").alias("first"), F.array_join(rest, " ").alias("rest"))
    part = lambda name, value: phrases.select("lang", F.col("phrase").alias(name), F.col("f").alias(value))
    cuts = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    # decimals, as the product may pass 64 bits
    score = F.expr("CAST(2000000 AS DECIMAL(7, 0)) * CAST(a AS DECIMAL(20, 0)) DIV (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))")
    least = cuts.groupBy("lang", "phrase", "m", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return least.select("lang", "phrase", "m", "a", "cut.l", "cut.r", "cut.score")


def _outermost(candidates: DataFrame, phrases: DataFrame) -> DataFrame:
    """Candidates but those that lie inside a longer one that is at least four fifths as frequent."""
    words = F.split("phrase", " ")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("m") - 1), lambda size: F.transform(F.sequence(F.lit(1), F.col("m") - size + 1), lambda at: F.array_join(F.slice(words, at, size), " "))))
    longer = phrases.where("m >= 3").select("lang", F.explode(inner).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("outer"))
    joined = candidates.join(longer, ["lang", "phrase"], "left")
    return joined.where(F.expr("outer IS NULL OR CAST(100 AS DECIMAL(3, 0)) * CAST(outer AS DECIMAL(20, 0)) < CAST(80 AS DECIMAL(2, 0)) * CAST(a AS DECIMAL(20, 0))")).drop("outer")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, longest: int = LONGEST, best: int = BEST, bits: int = BITS, hot: int = HOT) -> DataFrame:
    """Per language its ``best`` phrases: lang, rank, phrase, a, l, r, n, score."""
    phrases, total = frequent_phrases(docs, lang_col, text_col, least, longest, bits, hot)
    left = _outermost(scored(phrases), phrases)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of each share of a language first, so that no task ranks all of its phrases
    left = left.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(fold(docs.sparkSession))))
    left = left.withColumn("rank", F.row_number().over(W.partitionBy("lang", "share").orderBy(*order))).where(F.col("rank") <= best)
    left = left.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= best)
    return left.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
