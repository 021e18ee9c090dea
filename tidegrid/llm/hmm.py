"""A hidden Markov language model over words, trained by Baum-Welch on the whole corpus.

Words are counted over all training texts.  The most frequent ones are symbols of their own;
any other word is the symbol of its class, by a hash of its last bytes, times the word's share of
that class.  A share is (c + 1) over the sum of that over the class's known words plus one, c the
word's training count, so that every word, known or not, has a probability and a text's
score is one: a start state, transitions, emissions and an end.

The states start at random preferences around the counts of all training texts.  Every Baum-Welch round takes its
expected counts from every training text, summed across partitions; rounds go on until one raises the training texts'
log-probability by less than ``TOLERANCE`` a token.  Texts are scored by the scaled forward recursion, exactly, whatever their
length.  In training, a text of more than ``STRETCH`` words counts as several.

Null texts are empty: only the end.  Null ids are kept, in training, as their remainder is
none.  Repeated rows count and are scored each.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, small_side, text_bytes, tidy_after

#: Hidden states, symbols for words of their own, symbols for classes of other words.
STATES, OWN_SYMBOLS, CLASSES = 8, 16_384, 256
#: Frequent words whose counts every task knows, at most.
KNOWN_WORDS = 200_000
#: Training ends with the round that raises the natural log-probability of all training texts by no more than this a token.
TOLERANCE = 0.01
#: Words of a training stretch, and of a block of texts that are computed together.
STRETCH, BLOCK = 1 << 17, 1 << 19
#: Positions after which the recursions of training are scaled.
SCALED = 16
#: Cells whose transposition fits a processor's cache.
NEAR = 1 << 11
#: Pseudo-counts of the smoothing distribution in each state.
PRIOR = 100.0


def word_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % CLASSES


class Model:
    """Parameters: start (with the end as last entry), step (likewise), and emission by symbol."""

    def __init__(self, start: np.ndarray, step: np.ndarray, emit: np.ndarray) -> None:
        self.start, self.step, self.emit = start, step, emit

    @classmethod
    def begin(cls, unigram: np.ndarray, states: int, mean_words: float) -> Model:
        rng = np.random.default_rng(7)
        # few words with much weight in each state: from an even start the first rounds would hardly part the states
        emit = unigram[:, None] * (rng.gamma(0.3, size=(len(unigram), states)) + 0.02)
        end = 1 / (mean_words + 1)
        step = np.full((states, states + 1), 0.3 * (1 - end) / max(states - 1, 1))
        np.fill_diagonal(step, (0.7 if states > 1 else 1.0) * (1 - end))
        step[:, states] = end
        start = np.full(states + 1, (1 - end) / states)
        start[states] = end
        return cls(start, step / step.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))

    @classmethod
    def fit(cls, start: np.ndarray, step: np.ndarray, emit: np.ndarray, unigram: np.ndarray) -> Model:
        """Maximises expected counts, smoothed."""
        emit = emit + PRIOR * unigram[:, None]
        step = step + 0.1
        start = start + 0.1
        return cls(start / start.sum(), step / step.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def blocks(texts: list[np.ndarray]) -> Iterator[np.ndarray]:
    """Indices of texts of like length, longest first, in blocks of bounded padded size."""
    order = np.argsort([-len(t) for t in texts], kind="stable")
    at = 0
    while at < len(order):
        longest = max(1, len(texts[order[at]]))
        n = max(1, min(512, BLOCK // longest))
        yield order[at : at + n]
        at += n


class Cells:
    """The words of a block of texts by position, then text.

    Longer texts come first, so that those that reach a position are a prefix of the block.
    """

    def __init__(self, texts: list[np.ndarray], which: np.ndarray) -> None:
        sizes = np.array([len(texts[i]) for i in which])
        self.width, self.length = len(which), int(sizes[0])
        padded = np.zeros((self.width, self.length), dtype=np.uint16)
        for row, i, n in zip(padded, which.tolist(), sizes.tolist(), strict=True):
            row[:n] = texts[i]
        #: Symbols, texts that reach each position, and the first cell of each position.
        self.seen = padded.T[np.arange(self.length)[:, None] < sizes].astype(np.intp)
        reach = np.searchsorted(-sizes, -np.arange(self.length), side="left")
        at = np.concatenate(([0], np.cumsum(reach)))
        self.reach, self.at = reach.tolist(), at.tolist()
        #: Each text's last cell.
        self.final = at[sizes - 1] + np.arange(self.width)
        #: Positions before which texts have ended.
        self.turns = [0, *(np.flatnonzero(np.diff(reach)) + 1).tolist(), self.length]


class _Ready:
    """A model's tables for the recursions; emissions are multiples of their mean, so that scaling is due but now and then."""

    def __init__(self, model: Model) -> None:
        self.states = model.step.shape[0]
        self.step, self.end = np.ascontiguousarray(model.step[:, : self.states]), model.step[:, self.states]
        self.start, self.one = model.start[: self.states], np.ones(self.states)
        level = model.emit.mean(axis=1)
        self.ratio, self.log_level = model.emit / level[:, None], np.log(level)

    def blocks(self, texts: list[np.ndarray], tables: int) -> Iterator[tuple[np.ndarray, Cells, list[np.ndarray]]]:
        """Blocks of texts, none of them empty, with tables of a row for each cell, whose memory serves all blocks; the first holds the emissions."""
        parts = list(blocks(texts))
        most = max((sum(len(texts[i]) for i in which) for which in parts), default=0)
        room = [np.empty((most, self.states)) for _ in range(tables)]
        for which in parts:
            cells = Cells(texts, which)
            part = [r[: len(cells.seen)] for r in room]
            yield which, cells, [np.take(self.ratio, cells.seen, axis=0, out=part[0], mode="clip"), *part[1:]]

    def forward(self, cells: Cells, ahead: np.ndarray, alpha: np.ndarray) -> dict[int, np.ndarray]:
        """Fills ``alpha``; the sums by which it was divided, by position."""
        at, reach, sizes = cells.at, cells.reach, {}
        np.multiply(self.start, ahead[: cells.width], out=alpha[: cells.width])
        for t in range(1, cells.length):
            here, past = at[t], at[t + 1]
            now = alpha[here:past]
            np.dot(alpha[at[t - 1] : at[t - 1] + reach[t]], self.step, now)
            now *= ahead[here:past]
            if t % SCALED == 0:
                sizes[t] = now @ self.one
                now /= sizes[t][:, None]
        return sizes


def log_likelihood(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """Natural log-probability of each text, by the scaled forward recursion."""
    out, ready = np.full(len(texts), math.log(model.start[-1])), _Ready(model)
    some = np.flatnonzero([len(t) > 0 for t in texts])
    for which, cells, (ahead, alpha) in ready.blocks([texts[i] for i in some.tolist()], 2):
        total = np.zeros(cells.width)
        for size in ready.forward(cells, ahead, alpha).values():
            total[: len(size)] += np.log(size)
        total += np.log(alpha[cells.final] @ ready.end)
        which = some[which]
        out[which] = total + [ready.log_level[texts[i]].sum() for i in which.tolist()]
    return out


def expected(model: Model, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, steps and emissions of texts: one round's counts."""
    return _expected(model, texts)[:3]


def _expected(model: Model, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected starts, steps and emissions, and the texts' natural log-probability."""
    states, symbols_n = model.step.shape[0], len(model.emit)
    ready = _Ready(model)
    back = np.ascontiguousarray(ready.step.T)
    starts, steps, emits = np.zeros(states + 1), np.zeros((states, states + 1)), np.zeros((states, symbols_n))
    starts[states] = sum(len(t) == 0 for t in texts)
    total = float(starts[states]) * math.log(model.start[states])
    texts = [t[i : i + STRETCH] for t in texts if len(t) for i in range(0, len(t), STRETCH)]
    for _, cells, (ahead, alpha, beta) in ready.blocks(texts, 3):
        seen, at, reach, width = cells.seen, cells.at, cells.reach, cells.width
        sizes = ready.forward(cells, ahead, alpha)
        chance = alpha[cells.final] @ ready.end
        total += np.log(chance).sum() + sum(np.log(size).sum() for size in sizes.values()) + ready.log_level[seen].sum()
        # what follows is divided by the text's chance and by the sums of the way there: times alpha it is the states' probability
        beta[cells.final] = ready.end / chance[:, None]
        for t in range(cells.length - 1, 0, -1):
            n, here, past, before = reach[t], at[t], at[t + 1], at[t - 1]
            # from here on ``ahead`` is the emission times what follows
            coming = ahead[here:past]
            coming *= beta[here:past]
            if t % SCALED == 0:
                coming /= sizes[t][:, None]
            np.dot(coming, back, beta[before : before + n])
        # pairs of neighbours, in stretches that as many texts reach
        both = np.zeros((states, states))
        for first, past in itertools.pairwise(cells.turns):
            n, here = reach[first], at[first]
            if first:
                both += alpha[at[first - 1] : at[first - 1] + n].T @ ahead[here : here + n]
            both += alpha[here : at[past] - n].T @ ahead[here + n : at[past]]
        steps[:, :states] += ready.step * both
        gamma = ahead.reshape(states, -1)  # its memory serves again
        for lo in range(0, len(seen), NEAR):
            some = alpha[lo : lo + NEAR]
            some *= beta[lo : lo + NEAR]
            gamma[:, lo : lo + NEAR] = some.T
        starts[:states] += gamma[:, :width].sum(axis=1)
        steps[:, states] += gamma[:, cells.final].sum(axis=1)
        for s in range(states):
            emits[s] += np.bincount(seen, weights=gamma[s], minlength=symbols_n)
    return starts, steps, emits, float(total)


@tidy_after
def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts of training texts; flushed when many."""
    counts: Counter[bytes] = Counter()

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["word", "c"])

    for batch in batches:
        for text in batch.column(0):
            counts.update(text.as_py().lower().split())
            if len(counts) > 1_000_000:
                yield flush()
                counts.clear()
    yield flush()


_CODED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_words", pa.int64()), ("known_sum", pa.float64()), ("class_sum", pa.float64()), ("known_n", pa.int64()), ("symbols", pa.binary()), ("rare", pa.string())])
_CODED_SQL = "doc_id long, held_out boolean, n_words long, known_sum double, class_sum double, known_n long, symbols binary, rare string"


def _code(known: list[bytes], counts: np.ndarray, own: int):
    """Symbols of each text, sums over its known words, and the words whose counts must be looked up.

    ``class_sum`` is the part of ``known_sum`` whose words have no symbol of their own.
    """

    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {w: i for i, w in enumerate(known)}
        logs = np.log10(counts + 1.0)
        symbol = np.array([i if i < own else own + word_class(w) for i, w in enumerate(known)] + [0], dtype=np.uint16)
        for batch in batches:
            rows = []
            for doc, held, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                words = text.as_py().lower().split()
                places = np.fromiter(map(index.get, words, itertools.repeat(-1)), dtype=np.int64, count=len(words))
                unknown = places < 0
                symbols = symbol[places]
                rare = [words[i] for i in np.flatnonzero(unknown).tolist()]
                if rare:
                    symbols[unknown] = [own + word_class(w) for w in rare]
                inside = places[~unknown]
                rows.append((doc, held, len(words), float(logs[inside].sum()), float(logs[inside[inside >= own]].sum()), len(inside), symbols.tobytes(), b" ".join(rare).decode("utf-8", "replace")))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _CODED, strict=True)] if rows else [pa.array([], f.type) for f in _CODED], schema=_CODED)

    return run


def _class_mass(own_words: frozenset[bytes]):
    """Per class the sum of (c + 1) and of c over its words."""

    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass, uses = np.zeros(CLASSES), np.zeros(CLASSES)
        for batch in batches:
            words = batch.column(0).to_pylist()
            count = batch.column(1).to_numpy().astype(np.float64)
            kind = np.array([CLASSES if w in own_words else word_class(w) for w in words], dtype=np.int64)
            mass += np.bincount(kind, weights=count + 1, minlength=CLASSES + 1)[:CLASSES]
            uses += np.bincount(kind, weights=count, minlength=CLASSES + 1)[:CLASSES]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(mass), pa.array(uses)], names=["class", "mass", "uses"])

    return run


def _round(model: Model):
    """Expected counts of a partition, a row for each symbol; starts, steps and the log-probability have rows below zero."""

    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states, symbols = model.step.shape[0], len(model.emit)
        starts, steps, emits = np.zeros(states + 1), np.zeros((states, states + 1)), np.zeros((states, symbols))
        chance = 0.0
        for batch in batches:
            texts = [np.frombuffer(x, dtype=np.uint16) for x in batch.column(0).to_pylist()]
            more = _expected(model, texts)
            starts, steps, emits, chance = starts + more[0], steps + more[1], emits + more[2], chance + more[3]
        used = np.flatnonzero(emits.any(axis=0))
        table = np.zeros((len(used) + states + 2, states + 1))
        table[: len(used), :states] = emits[:, used].T
        table[len(used) : len(used) + states] = steps
        table[-2] = starts
        table[-1, 0] = chance
        key = np.concatenate((used, -1 - np.arange(states + 2)))
        yield pa.RecordBatch.from_arrays([pa.array(key), *[pa.array(np.ascontiguousarray(table[:, s])) for s in range(states + 1)]], names=["row", *[f"s{s}" for s in range(states + 1)]])

    return run


def _train(coded: DataFrame, unigram: np.ndarray, n_words: int, n_texts: int) -> Model:
    """Baum-Welch over all training texts, until a round gains no more than ``TOLERANCE`` a token."""
    training = coded.where("not held_out").select("symbols")
    model, previous = Model.begin(unigram, STATES, n_words / max(n_texts, 1)), -math.inf
    names = [f"s{s}" for s in range(STATES + 1)]
    below = [-1 - s for s in range(STATES + 2)]
    while True:
        summed = training.mapInArrow(_round(model), ", ".join(["row long", *[f"{n} double" for n in names]]))
        counts = summed.groupBy("row").agg(*[F.sum(n).alias(n) for n in names]).toPandas().set_index("row")
        emit = np.zeros((len(unigram), STATES))
        own = counts[counts.index >= 0]
        emit[own.index.to_numpy()] = own[names[:STATES]].to_numpy()
        rest = counts.reindex(below, fill_value=0.0)[names].to_numpy()
        model = Model.fit(rest[STATES], rest[:STATES], emit, unigram)
        chance = float(rest[STATES + 1, 0])
        if chance - previous <= TOLERANCE * (n_words + n_texts):
            return model
        previous = chance


def _score(model: Model, class_logs: np.ndarray, own: int):
    schema = pa.schema([("row", pa.int64()), ("sequence", pa.float64())])

    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [np.frombuffer(x, dtype=np.uint16) for x in batch.column(1).to_pylist()]
            found = log_likelihood(model, texts) / math.log(10)
            found -= [class_logs[t[t >= own] - own].sum() for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], schema=schema)

    return run


def score_texts(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row the base-10 log-probability of its text, by word counts alone and by the model.

    The model learns from the rows for which ``held_out``, a boolean column, is false.
    """
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), text_bytes(text_col).alias("text"))
    counts = plain.where("not held_out").select("text").mapInArrow(_counter, "word binary, c long")
    counts = saved(counts.groupBy("word").agg(F.sum("c").alias("c")), "counts")
    n_texts = plain.where("not held_out").count()
    n_words, vocabulary = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    n_tokens, distinct = n_words + n_texts, vocabulary + (n_texts > 0)
    # the least count of known words, from a histogram in buckets of bounded number
    bucket = F.expr("shiftleft(shiftright(c, greatest(length(bin(c)) - 8, 0)), greatest(length(bin(c)) - 8, 0))")
    histogram = sorted(counts.groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).collect(), reverse=True)
    least, taken = None, 0
    for b, n in histogram:
        if taken + n > KNOWN_WORDS:
            break
        least, taken = b, taken + n
    frequent = counts.where(F.col("c") >= least).toPandas() if least is not None else None
    pairs = sorted(zip((-frequent["c"]).tolist(), map(bytes, frequent["word"]), strict=True)) if frequent is not None else []
    known, number = [w for _, w in pairs], np.array([-c for c, _ in pairs], dtype=np.float64)
    own = min(OWN_SYMBOLS, len(known))
    coded = saved(plain.mapInArrow(_code(known, number, own), _CODED_SQL).withColumn("row", F.monotonically_increasing_id()), "coded")

    summed = counts.mapInArrow(_class_mass(frozenset(known[:own])), "class long, mass double, uses double").groupBy("class").agg(F.sum("mass").alias("mass"), F.sum("uses").alias("uses")).toPandas().set_index("class")
    mass, uses = (summed[c].reindex(range(CLASSES), fill_value=0.0).to_numpy() for c in ("mass", "uses"))
    unigram = np.concatenate((number[:own] + 1, uses + 1))
    model = _train(coded, unigram / unigram.sum(), n_words, n_texts)
    sequence = coded.select("row", "symbols").mapInArrow(_score(model, np.log10(mass + 1), own), "row long, sequence double")

    rare = coded.where("rare <> ''").select("row", F.explode(F.split("rare", " ")).alias("word"))
    lookup = counts.where(F.col("c") < least) if least is not None else counts
    lookup = lookup.select(F.col("word").cast("string").alias("word"), "c")
    rare = rare.join(lookup, "word").groupBy("row").agg(F.sum(F.log10(F.col("c") + 1.0)).alias("rare_sum"), F.count("*").alias("rare_n"))
    lines = coded.drop("symbols", "rare").join(small_side(saved(rare, "rare")), "row", "left").join(small_side(saved(sequence, "sequence")), "row")
    rare_sum = F.coalesce("rare_sum", F.lit(0.0))
    end = math.log10(n_texts + 1)
    each = math.log10(n_tokens + distinct + 1)
    return lines.select(
        "doc_id",
        "held_out",
        (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("known_n") + F.coalesce("rare_n", F.lit(0)) + int(n_texts > 0)).alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("known_sum") + rare_sum + end - (F.col("n_words") + 1) * each).alias("base_score"),
        (F.col("sequence") + F.col("class_sum") + rare_sum).alias("score"),
    )
