"""Benchmark passages in documents, by the q-gram lemma and banded alignment.

Texts are compared by their letters and digits, ASCII ones lower-cased; white space and
punctuation count for nothing.  If an item of m bytes occurs with at most k edits, at least m + 1 - q(k + 1) of
its q-grams recur within a band of k + 1 diagonals.  Documents' q-grams are looked up in the
items'; hits are counted in diagonal bands that overlap by half, so that any such band
lies within one of them; bands that reach the bound are kept and verified by
banded alignment of the whole item, many bands at a time.  Of the q-grams that more than ``COMMON`` items
share, as of a question's usual opening, an item may go without as many as its bound can
spare: the bound falls by their number, so that no region is lost.  Nothing is shuffled: items come to the
documents, in blocks of bounded number and bytes, and the hits of a megabyte of text are taken
in parts of bounded number, by item.

Items whose letters and digits make fewer than ``LEAST_ITEM`` bytes would match by chance with
edits; they are found where their words stand one after the other, whole and without edits.
Only whole items count: a quoted part of one is not reported.  Null texts and items, and items
without a letter or digit, have no match.  Equal items are each reported; of a
document's regions for an item, the best one (fewest edits, then first) is.
Rows that repeat are each searched, and reported once; rows without id are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, small_batches, text_bytes, tidy_after
from .groups import changes
from .textbytes import Prefix, chunks, join

Q = 12
#: Edits allowed in a hundred bytes of an item.
EDITS = 5
#: Bytes of an item that is searched for with edits, at least.
LEAST_ITEM = 40
#: Items that are searched for at once, and their bytes, about.
ITEMS, ITEM_BYTES = 20_000, 8 << 20
#: Items that may share a q-gram before they go without it where they can.
COMMON = 16
#: Hits, and cells of alignments, that are computed together.
HITS, CELLS = 1 << 21, 1 << 18

_LETTERS = np.zeros(256, dtype=np.uint8)
for _c in range(256):
    if _c >= 128 or chr(_c).isalnum():
        _LETTERS[_c] = bytes([_c]).lower()[0]
_FOUND = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int64()), ("item_bytes", pa.int64())])


def letters(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Compared bytes of a text, and where each stands."""
    folded = _LETTERS[buf]
    at = np.flatnonzero(folded)
    return folded[at], at


def apart(folded: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``letters``' bytes with a space before each word, and where words start in ``letters``' bytes."""
    word = np.flatnonzero(np.diff(at, prepend=-2) > 1)
    return np.insert(folded, word, 0x20), word


def budget(m: int, edits: int = EDITS) -> int:
    return m * edits // 100


class Items:
    """The q-grams of a block of items, with a bitmap in front of the sorted table."""

    def __init__(self, items: list[tuple[int, bytes]], edits: int) -> None:
        self.ids = [i for i, _ in items]
        split = [letters(np.frombuffer(t, dtype=np.uint8)) for _, t in items]
        self.texts = [t for t, _ in split]
        grams = [Prefix(t).grams(Q if len(t) >= LEAST_ITEM else len(t) + 1) for t in self.texts]
        self.short: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        by_size: dict[int, list[tuple[int, np.ndarray]]] = {}
        for i, (t, at) in enumerate(split):
            if 0 < len(t) < LEAST_ITEM:
                words = apart(t, at)[0]
                by_size.setdefault(len(words), []).append((i, words))
        for n, held in by_size.items():
            exact = np.array([Prefix(words).grams(n)[0] for _, words in held])
            sort = np.argsort(exact, kind="stable")
            self.short[n] = exact[sort], np.array([i for i, _ in held])[sort], np.stack([words for _, words in held])[sort]
        code = np.concatenate([*grams, np.zeros(0, dtype=np.uint64)])
        order = np.argsort(code, kind="stable")
        code = code[order]
        item = np.repeat(np.arange(len(items)), [len(g) for g in grams])[order]
        place = np.concatenate([*[np.arange(len(g)) for g in grams], np.zeros(0, dtype=np.int64)])[order].astype(np.int64)
        size = np.array([len(t) for t in self.texts], dtype=np.int64)
        self.size = size
        self.edits = size * edits // 100
        self.least = size + 1 - Q * (self.edits + 1)
        if len(code):
            dropped = self._spare(code, item)
            self.least -= np.bincount(item[dropped], minlength=len(items))
            code, item, place = code[~dropped], item[~dropped], place[~dropped]
        self.code, self.item, self.place = code, item, place
        self.bits = max(20, int(np.ceil(np.log2(16 * max(len(code), 1)))))
        self.bitmap = np.zeros(1 << self.bits, dtype=bool)
        self.bitmap[self.code >> np.uint64(64 - self.bits)] = True

    def _spare(self, code: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Entries that items go without: of their common q-grams the most common, up to three quarters of the bound."""
        new = changes(code)
        group = np.cumsum(new) - 1
        # items of a q-gram, each once
        pair = np.lexsort((item, group))
        shared = np.bincount(group[pair][changes(group[pair], item[pair])])[group]
        order = np.lexsort((-shared, item))
        own = item[order]
        first = np.flatnonzero(changes(own))
        rank = np.arange(len(own)) - np.repeat(first, np.diff(np.concatenate((first, [len(own)]))))
        out = np.zeros(len(code), dtype=bool)
        out[order] = (shared[order] > COMMON) & (rank < self.least[own] - np.maximum(1, self.least[own] // 4))
        return out

    def hits(self, code: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Positions in ``code``, items and positions in them, of equal q-grams; an item's all in one part."""
        at = np.flatnonzero(self.bitmap[code >> np.uint64(64 - self.bits)])
        lo = np.searchsorted(self.code, code[at], side="left")
        n = np.searchsorted(self.code, code[at], side="right") - lo
        parts = max(1, -(-int(n.sum()) // HITS))
        for part in range(min(parts, max(len(self.ids), 1))):
            if parts > 1:
                mine = np.flatnonzero(self.item % parts == part)
                table = self.code[mine]
                lo = np.searchsorted(table, code[at], side="left")
                n = np.searchsorted(table, code[at], side="right") - lo
            source = np.arange(int(n.sum())) + np.repeat(lo - (np.cumsum(n) - n), n)
            if parts > 1:
                source = mine[source]
            yield np.repeat(at, n), self.item[source], self.place[source]

    def exact(self, folded: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where short items stand as whole words in ``letters``' bytes, and which."""
        places, found = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        if self.short:
            spaced, word = apart(folded, at)
            prefix, begin = Prefix(spaced), word + np.arange(len(word))
            ends = np.append(spaced, 0x20) == 0x20
            for n, (code, item, words) in self.short.items():
                some = np.flatnonzero(begin + n <= len(spaced))
                some = some[ends[begin[some] + n]]
                here = prefix.of(begin[some], begin[some] + n)
                lo = np.searchsorted(code, here, side="left")
                times = np.searchsorted(code, here, side="right") - lo
                source = np.arange(int(times.sum())) + np.repeat(lo - (np.cumsum(times) - times), times)
                some = np.repeat(some, times)
                same = (spaced[begin[some][:, None] + np.arange(n)] == words[source]).all(axis=1)
                places.append(word[some[same]])
                found.append(item[source[same]])
        return np.concatenate(places), np.concatenate(found)


def align(items: list[np.ndarray], which: np.ndarray, folded: np.ndarray, start: np.ndarray, size: np.ndarray, low: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least edits that turn an item into a substring of a text, for many pairs; where that starts and ends.

    Pair p aligns ``items[which[p]]`` with the ``size[p]`` bytes of ``folded`` from ``start[p]`` on, on the ``width[p]``
    diagonals from ``low[p]`` on only.  Of equal costs the shortest substring, then the first, is taken.
    """
    m = np.array([len(items[i]) for i in which], dtype=np.int64)
    out = tuple(np.zeros(len(which), dtype=np.int64) for _ in range(3))
    order = np.argsort(-m, kind="stable")
    lane = np.arange(int(width.max()) if len(width) else 0)
    step = max(1, CELLS // max(len(lane), 1))
    for some in (order[i : i + step] for i in range(0, len(order), step)):
        n, lo, long = size[some, None], low[some, None], m[some]
        big = int(long.max() + size[some].max()) + 2
        symbols = np.zeros((len(some), int(long.max())), dtype=np.uint8)
        for row, i in enumerate(which[some].tolist()):
            symbols[row, : len(items[i])] = items[i]
        outside = lane >= width[some, None]
        # cell [j] of row i stands for text position low + i + j; its start is carried along
        origin = lo + lane
        cost = np.where((origin >= 0) & (origin <= n) & ~outside, 0, big)
        for i in range(symbols.shape[1]):
            k = int(np.searchsorted(-long, -i, side="left"))  # pairs whose items are longer than i
            at = lo[:k] + i + lane
            inside = (at >= 0) & (at < n[:k]) & ~outside[:k]
            differ = folded[np.where(inside, start[some[:k], None] + at, 0)] != symbols[:k, i, None]
            new = np.where(inside, cost[:k] + differ, big)
            came = origin[:k].copy()
            # the item's byte left out: the cell one lane on, of the row before
            skip = np.full_like(new, big)
            skip[:, :-1] = cost[:k, 1:] + 1
            better = skip < new
            new[better] = skip[better]
            came[:, :-1][better[:, :-1]] = origin[:k, 1:][better[:, :-1]]
            new[(at + 1 < 0) | (at + 1 > n[:k]) | outside[:k]] = big
            # bytes of the text put in: from lanes before, at one edit each
            moved = new - lane
            best = np.minimum.accumulate(moved, axis=1)
            source = np.maximum.accumulate(np.where(moved == best, lane, 0), axis=1)
            cost[:k] = np.where(outside[:k], big, np.minimum(best + lane, big))
            origin[:k] = np.take_along_axis(came, source, axis=1)
        end = lo + long[:, None] + lane
        rank = (cost * (2 * big) + np.clip(end - origin, 0, 2 * big - 1)) * len(lane) + lane
        j = np.argmin(rank, axis=1)[:, None]
        for held, found in zip(out, (cost, origin, end), strict=True):
            held[some] = np.take_along_axis(found, j, axis=1)[:, 0]
    return out


def _regions(items: Items, folded: np.ndarray, edge: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Text, item, cost, start and end of alignments within items' budgets, part by part."""
    for place, item, inner in items.hits(Prefix(folded).grams(Q)):
        doc = np.searchsorted(edge, place, side="right") - 1
        whole = place + Q <= edge[doc + 1]
        place, item, inner, doc = place[whole], item[whole], inner[whole], doc[whole]
        if not len(place):
            continue
        step = items.edits[item] + 1
        band = np.floor_divide(place - edge[doc] - inner, step)
        # each hit counts in both bands, of two steps' width, that cover its diagonal
        doc, item, inner = np.tile(doc, 2), np.tile(item, 2), np.tile(inner, 2)
        band = np.concatenate((band, band - 1))
        order = np.lexsort((inner, band, item, doc))
        doc, item, band, inner = doc[order], item[order], band[order], inner[order]
        first = np.flatnonzero(changes(doc, item, band))
        count = np.add.reduceat(changes(doc, item, band, inner).astype(np.int64), first)
        first = first[count >= items.least[item[first]]]
        doc, item, band = doc[first], item[first], band[first]
        width = items.edits[item] + 1
        low = band * width
        # the region in which the band's alignments lie
        a = np.maximum(low, 0)
        z = np.minimum(edge[doc + 1] - edge[doc], low + 2 * width - 1 + items.size[item] + width)
        cost, start, end = align(items.texts, item, folded, edge[doc] + a, np.maximum(z - a, 0), low - a, 2 * width)
        good = cost <= items.edits[item]
        yield doc[good], item[good], cost[good], (start + a)[good], (end + a)[good]


def search(items: Items, texts: list[bytes]) -> Iterator[tuple[int, int, int, int, int]]:
    """(text, item, start, end, edits) of each item's best occurrence in each text."""
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    for lo, hi in chunks(sizes):
        buf, starts = join(texts[lo:hi])
        folded, at = letters(buf)
        if not len(folded):
            continue
        edge = np.searchsorted(at, starts)
        place, item = items.exact(folded, at)
        doc = np.searchsorted(edge, place, side="right") - 1
        # one that runs on into the next text is none
        whole = place + items.size[item] <= edge[doc + 1]
        place, item, doc = place[whole], item[whole], doc[whole]
        begin = place - edge[doc]
        parts = [(doc, item, np.zeros(len(doc), dtype=np.int64), begin, begin + items.size[item]), *_regions(items, folded, edge)]
        doc, item, cost, start, end = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((end, start, cost, item, doc))
        best = order[changes(doc[order], item[order])]
        doc, item, cost, start, end = doc[best], item[best], cost[best], start[best], end[best]
        from_, to = at[edge[doc] + start] - starts[doc], at[edge[doc] + end - 1] - starts[doc] + 1
        yield from zip((doc + lo).tolist(), item.tolist(), from_.tolist(), to.tolist(), cost.tolist(), strict=True)


def find_items(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", edits: int = EDITS) -> DataFrame:
    """A row for each document and item found in it: byte range of the best occurrence, and edits."""
    plain = docs.select(F.col(id_col).cast("long").alias("doc"), text_bytes(text_col).alias("text")).where("doc is not null")
    found = None
    for items in _blocks(benchmark, item_col, item_text_col):
        one = plain.mapInArrow(_searcher(items, edits), "doc_id long, item_id long, start long, end long, edits long, item_bytes long")
        found = one if found is None else found.unionByName(one)
    return found.distinct()


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[int, bytes]]]:
    """Items, of a bounded number and bytes at a time; one empty block if there are none."""
    wanted = benchmark.select(F.col(item_col).cast("long").alias("item"), text_bytes(text_col).alias("text")).where("item is not null").distinct()
    n, size = wanted.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(-(-n // ITEMS), -(-size // ITEM_BYTES), 1)
    for b in range(blocks):
        rows = wanted.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b) if blocks > 1 else wanted
        yield [(r["item"], bytes(r["text"])) for r in rows.collect()]


def _searcher(items: list[tuple[int, bytes]], edits: int):
    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Items(items, edits)
        for batch in small_batches(batches):
            docs = batch.column(0).to_pylist()
            rows = [(docs[d], table.ids[t], start, end, cost, len(table.texts[t])) for d, t, start, end, cost in search(table, batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_FOUND)], schema=_FOUND)

    return run


def _filter(items: list[tuple[int, bytes]], edits: int, text: int):
    """Batches without the rows in whose text, column number ``text``, an item is found."""

    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Items(items, edits)
        for batch in small_batches(batches):
            clean = np.ones(batch.num_rows, dtype=bool)
            clean[[d for d, *_ in search(table, [(t or "").encode() for t in batch.column(text).to_pylist()])]] = False
            yield batch.filter(pa.array(clean))

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits: int = EDITS) -> DataFrame:
    """``docs`` without the rows in which an item is found; all columns stay.

    Each row is judged by its own text, whatever its id, in the pass that reads it.
    """
    names = docs.columns
    left = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in left.schema)
    for b, items in enumerate(_blocks(benchmark, "item_id", "text")):
        if b:
            left = saved(left, "clean")
        left = left.mapInArrow(_filter(items, edits, names.index(text_col)), schema)
    return left.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
