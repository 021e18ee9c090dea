"""Document quality from a linear-chain conditional random field over lines.

Each line is good or bad.  Its potentials come from features of the line and of
the lines before and after it; a transition matrix ties neighbouring lines.  The
field is fitted by gradient ascent on the conditional likelihood of a bounded sample of labelled documents, all
lines of which carry the document's label.  Forward-backward then gives each line's
marginal of being good, and a document's score is their mean, weighted by line length.

Features are shape only: counts by byte class, word and line lengths, repeated words,
word triples and lines.  Neither labels, language, source nor ids enter a score.

A null or empty text is one empty line, and is scored.  Repeated rows are scored each, and are
one text to learn from; labels that repeat count each once.  Without any labels all scores are one half.
A row with a null id is scored as any other and is not held out, though there is no label for it to learn from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, text_bytes, tidy_after
from .groups import changes
from .textbytes import Prefix, chunks, join, mix, words

#: Labelled documents to fit on, at most, and their lines together.
SAMPLE_DOCS, SAMPLE_LINES = 8000, 200_000
STEPS, RATE, RIDGE = 250, 0.08, 1e-3

# fixed values: byte classes
_CLASSES = ("upper", "lower", "digit", "space", "symbol", "shout", "stop", "quote", "other", "high")
_CLASS = np.full(256, 8, dtype=np.uint8)
_CLASS[ord("A") : ord("Z") + 1] = 0
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("0") : ord("9") + 1] = 2
_CLASS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 3
_CLASS[[ord(c) for c in "#*$%&|<>"]] = 4
_CLASS[[ord("!")]] = 5
_CLASS[[ord(c) for c in ".,;:?"]] = 6
_CLASS[[ord(c) for c in "\"'()-"]] = 7
_CLASS[128:] = 9


def _repeats(owner: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each (owner, code) occurs again anywhere, and whether it occurred before."""
    order = np.lexsort((code, owner))
    new = changes(owner[order], code[order])
    size = np.diff(np.concatenate((np.flatnonzero(new), [len(new)])))
    again, before = np.zeros(len(code), dtype=bool), np.zeros(len(code), dtype=bool)
    again[order] = np.repeat(size > 1, size)
    before[order] = ~new
    return again, before


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, each text's first line, and line lengths in bytes, plus one."""
    buf, starts = join(texts)
    newline = buf == 0x0A
    end = np.flatnonzero(newline)
    begin = np.concatenate(([0], end[:-1] + 1))
    n = len(end)
    doc = np.searchsorted(starts, begin, side="right") - 1
    line = np.cumsum(newline) - newline
    count = np.bincount(line * len(_CLASSES) + _CLASS[buf], minlength=n * len(_CLASSES)).reshape(n, -1).astype(np.float64)
    count[:, 3] -= 1  # the newline itself
    size = (end - begin).astype(np.float64)
    prefix = Prefix(buf)
    first, last, word_doc = words(buf, starts)
    word_line = line[first] if len(first) else np.zeros(0, dtype=np.int64)
    n_words = np.bincount(word_line, minlength=n).astype(np.float64)
    code = prefix.of(first, last)
    _, in_line = _repeats(word_line, code)
    near = np.zeros(len(code), dtype=bool)
    near[1:] = (code[1:] == code[:-1]) & (word_doc[1:] == word_doc[:-1])
    triple = np.zeros(len(code), dtype=np.uint64)
    if len(code) > 2:
        triple[:-2] = mix(code[:-2] * np.uint64(5) + code[1:-1] * np.uint64(3) + code[2:])
        whole = np.concatenate((word_doc[:-2] == word_doc[2:], [False, False]))
    else:
        whole = np.zeros(len(code), dtype=bool)
    again = np.zeros(len(code), dtype=bool)
    again[whole], _ = _repeats(word_doc[whole], triple[whole])
    blank = n_words == 0
    line_again, line_before = _repeats(doc, np.where(blank, np.arange(n, dtype=np.uint64), prefix.of(begin, end)))
    per_word = np.maximum(n_words, 1)
    letters = np.maximum(count[:, 0] + count[:, 1] + count[:, 9] / 2, 1)
    share = lambda x, of: x / of
    flag = lambda mask, weights: np.bincount(word_line[mask], minlength=n) / weights
    doc_words = np.bincount(word_doc, minlength=len(texts))[doc]
    base = np.column_stack(
        [
            np.log1p(size),
            np.log1p(n_words),
            np.log1p(doc_words),
            share(size - count[:, 3], per_word) / 10,
            share(count[:, 0], letters),
            share(count[:, 2], np.maximum(size, 1)),
            share(count[:, 4], per_word),
            share(count[:, 5], per_word),
            share(count[:, 6], per_word),
            share(count[:, 7], per_word),
            share(count[:, 8], per_word),
            share(count[:, 9], np.maximum(size, 1)),
            flag(in_line, per_word),
            flag(near, per_word),
            flag(again, per_word),
            line_again,
            line_before,
            blank,
            np.isin(buf[np.maximum(end - 1, begin)], np.frombuffer(b".!?", dtype=np.uint8)) & ~blank,
            doc_words < 10,
            doc_words < 20,
        ]
    ).astype(np.float64)
    shares = base[:, 4:15]
    base = np.column_stack([base, np.minimum(shares, 1) ** 0.5, shares > 0.2, shares > 0.6])
    edge = changes(doc)
    before = np.vstack([np.zeros((1, base.shape[1])), base[:-1]])
    before[edge] = 0
    after = np.vstack([base[1:], np.zeros((1, base.shape[1]))])
    after[np.concatenate((edge[1:], [True]))] = 0
    ends = np.concatenate((edge[1:], [True]))
    table = np.column_stack([np.ones(n), edge, ends, base, before, after]).astype(np.float32)
    return table, np.flatnonzero(edge), size + 1


class Field:
    """Weights of the good-against-bad potential, and transitions [from, to]."""

    def __init__(self, weights: np.ndarray, transitions: np.ndarray, center: np.ndarray, spread: np.ndarray) -> None:
        self.weights, self.transitions, self.center, self.spread = weights, transitions, center, spread

    def potential(self, table: np.ndarray) -> np.ndarray:
        return ((table - self.center) / self.spread) @ self.weights


def marginals(potential: np.ndarray, first: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each line's chance of being good; expected transitions and log of the normaliser, by chain.

    Forward and backward messages are log-odds, computed for all chains position by position.
    """
    n, chains = len(potential), len(first)
    size = np.diff(np.concatenate((first, [n])))
    order = np.argsort(-size, kind="stable")
    start, size_o = first[order], size[order]
    active = np.searchsorted(-size_o, -np.arange(int(size_o[0]) if chains else 0), side="left")
    (bb, bg), (gb, gg) = transitions
    ahead, norm = np.zeros(n), np.zeros(chains)
    # forward: log of the bad and good messages
    bad, good = np.zeros(chains), np.zeros(chains)
    lows, highs = np.zeros(n), np.zeros(n)
    for t, k in enumerate(active.tolist()):
        at = start[:k] + t
        if t:
            b, g = bad[:k], good[:k]
            bad[:k], good[:k] = np.logaddexp(b + bb, g + gb), np.logaddexp(b + bg, g + gg) + potential[at]
        else:
            good[:k] = potential[at]
        lows[at], highs[at] = bad[:k], good[:k]
    norm[order] = np.logaddexp(bad, good)
    pairs = np.zeros((chains, 2, 2))
    low, high = np.zeros(chains), np.zeros(chains)  # backward messages
    for t in range(len(active) - 1, -1, -1):
        k = int(active[t])
        at = start[:k] + t
        ahead[at] = highs[at] + high[:k] - np.logaddexp(lows[at] + low[:k], highs[at] + high[:k])
        if t:
            to_bad, to_good = low[:k], high[:k] + potential[at]
            z = norm[order[:k]]
            for i, message in enumerate((lows[at - 1], highs[at - 1])):
                for j, onward in enumerate((to_bad, to_good)):
                    pairs[:k, i, j] += np.exp(message + transitions[i, j] + onward - z)
            low[:k], high[:k] = np.logaddexp(bb + to_bad, bg + to_good), np.logaddexp(gb + to_bad, gg + to_good)
    out = np.zeros_like(pairs)
    out[order] = pairs
    return np.exp(ahead), out, norm


def fit(table: np.ndarray, first: np.ndarray, label: np.ndarray, steps: int = STEPS) -> Field:
    """Gradient ascent with adaptive steps; documents of either label weigh the same as the other's in part."""
    center, spread = table.mean(axis=0), table.std(axis=0) + 1e-3
    center[0], spread[0] = 0, 1
    x = ((table - center) / spread).astype(np.float32)
    size = np.diff(np.concatenate((first, [len(table)])))
    line_label = np.repeat(label, size).astype(np.float64)
    # each document counts alike, whatever its number of lines
    weight = 1 / np.maximum(size, 1) ** 0.5
    weight /= weight.mean()
    theta = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    line_weight = np.repeat(weight, size)
    seen = np.zeros((len(first), 2, 2))
    seen[np.arange(len(first)), label, label] = size - 1
    for step in range(1, steps + 1):
        chance, pairs, _ = marginals(x @ theta[:-4], first, theta[-4:].reshape(2, 2))
        slope = np.concatenate((x.T @ ((line_label - chance) * line_weight), ((seen - pairs) * weight[:, None, None]).sum(axis=0).ravel())) / len(first)
        slope -= RIDGE * theta
        slope[-4:] -= 0.02 * theta[-4:]
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        theta += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(theta[:-4], theta[-4:].reshape(2, 2), center, spread)


def document_scores(field: Field | None, texts: list[bytes]) -> np.ndarray:
    """Length-weighted mean of the lines' marginals, for each text."""
    out = np.full(len(texts), 0.5)
    if field is None:
        return out
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    for lo, hi in chunks(sizes):
        table, first, length = line_features(texts[lo:hi])
        chance, _, _ = marginals(field.potential(table), first, field.transitions)
        out[lo:hi] = np.add.reduceat(chance * length, first) / np.add.reduceat(length, first)
    return np.clip(out, 0.0, 1.0)


@tidy_after
def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            table, _, _ = line_features([text])
            rows.append((label, len(table), table.astype(np.float16).tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.binary()))], names=["label", "n", "features"])


def sample(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """Labelled texts to fit on: ``label`` and ``text``, of bounded number and lines.

    Labels are taken in the order of a hash of their ids; of texts that share an id one counts.
    Texts are passed over whose lines no longer fit.
    """
    chosen = labels.where(usable & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id__"), F.col(label_col).cast("int").alias("label"))
    chosen = chosen.withColumn("order", F.xxhash64("id__")).orderBy("order", "id__", "label").limit(SAMPLE_DOCS)
    # the sample's size is a parameter, so it may be broadcast
    rows = docs.select(F.col(id_col).alias("id__"), text_bytes(text_col).alias("text")).join(F.broadcast(chosen), "id__")
    one = saved(rows.groupBy("order", "id__", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text")), "sample")
    lines = F.regexp_count(F.col("text").cast("string"), F.lit("\n")) + 1
    taken, left = [], SAMPLE_LINES
    for r in one.select("order", "id__", "label", lines.alias("n")).orderBy("order", "id__", "label").collect():
        if r["n"] <= left:
            taken.append((r["order"], r["id__"], r["label"]))
            left -= r["n"]
    kept = docs.sparkSession.createDataFrame(taken, one.select("order", "id__", "label").schema)
    return one.join(F.broadcast(kept), ["order", "id__", "label"], "left_semi").select("label", "text")


def train(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Field | None:
    """Fits the field on labelled documents, of which ``usable`` (over the label's id column) is true."""
    found = sample(docs, labels, usable, id_col, text_col, label_col).mapInArrow(_sample_features, "label int, n long, features binary").collect()
    if not found:
        return None
    found.sort(key=lambda r: (r["n"], r["label"], bytes(r["features"])))
    first = np.concatenate(([0], np.cumsum([r["n"] for r in found])))
    label = np.array([r["label"] for r in found])
    table = np.empty((first[-1], len(found[0]["features"]) // 2 // found[0]["n"]), dtype=np.float32)
    for i, r in enumerate(found):
        table[first[i] : first[i + 1]] = np.frombuffer(bytes(r["features"]), dtype=np.float16).reshape(r["n"], -1)
        found[i] = None
    return fit(table, first[:-1], label)


def score_documents(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id and score, from 0 (bad) to 1 (good)."""

    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(document_scores(field, batch.column(1).to_pylist()))], names=["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text")).mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, held_out, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted; labels of held-out ids are not learned from.

    ``held_out`` makes a boolean column of the name of an id column.
    """
    field = train(docs, labels, ~held_out(id_col), id_col, text_col)
    scored = score_documents(docs, field, id_col, text_col)
    return scored.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
