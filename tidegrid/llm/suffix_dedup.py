"""Exact removal of repeated byte strings, by external induced suffix sorting.

A byte goes if it lies in a ``length``-byte string that also starts earlier, in a
document of smaller id or earlier in its own.  Strings are judged on the input.

1. Each document is cut into runs of windows that share their minimiser.  Equal
   windows have equal minimisers, so comparing runs of one minimiser is enough.  Equal
   runs fold into the first, within a portion of a batch before any shuffle, so copies of a text never
   meet in numbers.
2. What remains of minimisers with several different runs goes to shards by minimiser.  There
   the windows that occur once are trimmed off, and the rest is suffix-sorted by
   recursive induction (``induced``), with queues in files beyond a memory limit.  Each stretch of
   neighbours that share ``length`` bytes keeps its first window.
3. A minimiser with more than ``CROWD`` different runs, as at the edge of a passage that very many
   documents share, would be too much for one task: its windows are compared one by one, spread by
   their content.  Which those are is told before any run is shuffled by a sample of documents, and what
   the sample misses by an exact count afterwards; either way gives the same result.
4. The covered ranges of a document are merged and cut out.

Rows without id are left out of the report, and stay as they are where texts are cut.  Null and empty
texts have no bytes to remove.  Rows that repeat an id with its text count as one document and are each
returned; different texts of one id are stretches of that document, in the order of a hash, so
that each row loses its own repeated bytes only.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import induced, textbytes
from .common import fold, saved, small_batches, small_side, text_bytes, tidy_after
from .groups import changes, key_runs, scan
from .induced import Store, suffix_order
from .textbytes import chunks

#: Bytes of a minimiser.
GRAM = 40
#: Windows of a text, and bytes of texts, that are handled at once; a window's position must fit 24 bits.
PIECE = PORTION = 2 << 20
#: Different runs of a minimiser that one block takes; those of more are compared window by window.
CROWD = 4096
#: One document in so many is looked at to tell crowded minimisers beforehand.
HINT = 16
#: Bytes of whole minimiser groups that are suffix-sorted together; more than ``induced.MEMORY``.
BLOCK = 32 << 20
#: Different texts of one id lie so many positions apart.
APART = 40

#: States of a run: open, covering a range, and open in a crowd.
OPEN, COVERED, CROWDED = 0, 1, 2
_RUNS = pa.schema([("key", pa.int64()), ("digest", pa.int64()), ("doc", pa.int64()), ("at", pa.int64()), ("n", pa.int64()), ("state", pa.int8())])
_RUNS_SQL = "key long, digest long, doc long, at long, n long, state byte"


def _firsts(run: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of runs sorted by key, digest, n, doc, at: group index, first of its group, repeats of an earlier one."""
    new = changes(run["key"], run["digest"], run["n"])
    group = np.cumsum(new) - 1
    first = np.flatnonzero(new)[group]
    later = (run["doc"] != run["doc"][first]) | (run["at"] != run["at"][first])
    return group, new, later


def _merged(doc: np.ndarray, at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of overlapping or touching ranges of each document."""
    if not len(doc):
        return doc, at, end
    order = np.lexsort((at, doc))
    doc, at, end = doc[order], at[order], end[order]
    fresh = changes(doc)
    number = np.cumsum(fresh)
    # a running maximum within each document: documents are lifted apart
    lift = number * (int(end.max()) + 2)
    reach = np.maximum.accumulate(end + lift)
    start = fresh.copy()
    start[1:] |= at[1:] + lift[1:] > reach[:-1]
    first = np.flatnonzero(start)
    last = np.concatenate((first[1:], [len(doc)])) - 1
    return doc[first], at[first], reach[last] - lift[last]


def _folded(whole: dict[str, np.ndarray], length: int) -> pa.RecordBatch:
    """First runs of a batch's equal ones, and the ranges that the others cover, under keys of their own."""
    order = np.lexsort(tuple(whole[c] for c in ("at", "doc", "n", "digest", "key")))
    whole = {c: x[order] for c, x in whole.items()}
    _, new, later = _firsts(whole)
    doc, at, end = _merged(whole["doc"][later], whole["at"][later], (whole["at"] + whole["n"])[later] + length - 1)
    whole = {c: x[new] for c, x in whole.items()}
    zero = np.zeros(len(doc), dtype=np.int64)
    spread = textbytes.mix(doc.view(np.uint64)).view(np.int64)
    state = np.concatenate((np.full(len(whole["key"]), OPEN, np.int8), np.full(len(doc), COVERED, np.int8)))
    columns = [*[np.concatenate(x) for x in ((whole["key"], spread), (whole["digest"], zero), (whole["doc"], doc), (whole["at"], at), (whole["n"], end - at))], state]
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, _RUNS, strict=True)], schema=_RUNS)


def _cut(length: int):
    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, bases = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for lo, hi in chunks(np.asarray(pa.compute.binary_length(batch.column(1))), PORTION):
                parts = []
                for i in range(lo, hi):
                    buf = np.frombuffer(batch.column(1)[i].as_buffer(), dtype=np.uint8)
                    for shift in range(0, len(buf) - length + 1, PIECE):
                        at, n, key, digest = textbytes.windows(buf[shift : shift + PIECE + length - 1], length, GRAM)
                        parts.append((key.view(np.int64), digest.view(np.int64), np.full(len(at), docs[i]), at + (shift + bases[i]), n))
                if parts:
                    whole = dict(zip(("key", "digest", "doc", "at", "n"), (np.concatenate(x) for x in zip(*parts, strict=True)), strict=True))
                    yield _folded(whole, length)

    return run


def _fold_equal(length: int):
    """Folds equal runs; keeps first runs only of minimisers with several different runs, or in a crowd."""

    def step(run: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        ready = run["state"] == COVERED
        done = {c: x[ready] for c, x in run.items()}
        run = {c: x[~ready] for c, x in run.items()}
        if len(run["key"]):
            _, new, later = _firsts(run)
            over = {c: x[later] for c, x in run.items()}
            over["n"] = over["n"] + length - 1
            over["state"] = np.full(len(over["n"]), COVERED, np.int8)
            first = {c: x[new] for c, x in run.items()}
            fresh = changes(first["key"])
            kinds = np.diff(np.concatenate((np.flatnonzero(fresh), [len(fresh)])))
            stays = np.repeat(kinds > 1, kinds) | (first["state"] == CROWDED)
            run = {c: np.concatenate((over[c], x[stays])) for c, x in first.items()}
        return {c: np.concatenate((done[c], x)) for c, x in run.items()}

    return scan("key", _RUNS, step)


_PIECES = pa.schema([("key", pa.int64()), ("doc", pa.int64()), ("at", pa.int64()), ("bytes", pa.binary())])
_RANGES = pa.schema([("doc", pa.int64()), ("at", pa.int64()), ("n", pa.int64())])


def _fetch(length: int, single: bool):
    """Runs' pieces of their texts; with ``single`` each window of a piece as a run of its own."""

    def table(key, doc, at, piece) -> pa.RecordBatch:
        if single:
            return _windows(np.array(doc), np.array(at), piece, length)
        return pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip((key, doc, at, piece), _PIECES, strict=True)], schema=_PIECES)

    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            key, doc, at, piece, size = [], [], [], [], 0
            for d, text, base, runs in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), batch.column(3), strict=True):
                text = memoryview(text.as_buffer())
                flat = runs.values.to_numpy().reshape(-1, 3)
                for k, a, n in flat[flat[:, 1] >> APART == base >> APART].tolist():
                    key.append(k)
                    doc.append(d)
                    at.append(a)
                    piece.append(bytes(text[a - base : a - base + n + length - 1]))
                    size += n + length - 1
                    if size > PORTION:
                        yield table(key, doc, at, piece)
                        key, doc, at, piece, size = [], [], [], [], 0
            if piece:
                yield table(key, doc, at, piece)

    return run


def _windows(doc: np.ndarray, start: np.ndarray, pieces: list[bytes], length: int) -> pa.RecordBatch:
    """Each window of each piece as a run of its own, named by two hashes; equal ones fold."""
    size = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
    base, count = np.cumsum(size) - size, np.maximum(size - length + 1, 0)
    piece = np.repeat(np.arange(len(size)), count)
    offset = np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count)
    at = base[piece] + offset
    hashes = textbytes.Prefix(np.frombuffer(b"".join(pieces), dtype=np.uint8))
    code, half = hashes.of(at, at + length).view(np.int64), hashes.of(at, at + length // 2).view(np.int64)
    return _folded({"key": code, "digest": half, "doc": doc[piece], "at": start[piece] + offset, "n": np.ones(len(piece), dtype=np.int64)}, length)


def _pieces(plain: DataFrame, runs: DataFrame, length: int, single: bool = False) -> DataFrame:
    """Pieces of runs, fetched from their documents, or windows as runs."""
    listed = runs.groupBy("doc").agg(F.flatten(F.collect_list(F.array("key", "at", "n"))).alias("runs"))
    joined = plain.join(small_side(saved(listed, "open")), "doc").select("doc", "text", "base", "runs")
    return joined.mapInArrow(_fetch(length, single), _RUNS_SQL if single else "key long, doc long, at long, bytes binary")


class Spool:
    """Bytes that arrive bit by bit, in memory up to a limit and then in a file."""

    def __init__(self, limit: int) -> None:
        self.limit, self.size = limit, 0
        self._parts: list[bytes] = []
        self._file = None

    def add(self, some: bytes) -> None:
        self.size += len(some)
        if self._file is None and self.size > self.limit:
            self._file = tempfile.TemporaryFile(prefix="spool-")
            self._file.write(b"".join(self._parts))
            self._parts = []
        if self._file is None:
            self._parts.append(some)
        else:
            self._file.write(some)

    def buffer(self) -> np.ndarray:
        if self._file is None:
            return np.frombuffer(b"".join(self._parts), dtype=np.uint8)
        self._file.flush()
        return np.memmap(self._file, dtype=np.uint8, mode="r").view(np.ndarray)

    def close(self) -> None:
        self._parts = []
        if self._file is not None:
            self._file.close()


def _recurring(code: np.ndarray, store: Store) -> np.ndarray:
    """Which values occur more than once, by as many passes over ranges of values as memory asks for."""
    flags = store.array(len(code), bool)
    passes = max(1, len(code) // (2 * store.step))
    ranges = lambda x: (x >> np.uint64(32)) * np.uint64(passes) >> np.uint64(32)
    for p in range(passes):
        value, many = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=bool)
        for lo, hi in store.slices(0, len(code)):
            own = code[lo:hi]
            own = own[ranges(own) == p] if passes > 1 else own
            value, many = np.concatenate((value, own)), np.concatenate((many, np.zeros(len(own), dtype=bool)))
            order = np.argsort(value, kind="stable")
            value, many = value[order], many[order]
            first = np.flatnonzero(changes(value))
            size = np.diff(np.concatenate((first, [len(value)])))
            many = (size > 1) | np.logical_or.reduceat(many, first) if len(first) else many
            value = value[first]
        value = value[many]
        for lo, hi in store.slices(0, len(code) if len(value) else 0):
            own = code[lo:hi]
            flags[lo:hi] |= value[np.minimum(np.searchsorted(value, own), len(value) - 1)] == own
    return flags


def _trimmed(whole: np.ndarray, base: np.ndarray, size: np.ndarray, length: int, store: Store) -> tuple[np.ndarray, ...]:
    """Pieces with windows that recur, the first and last such window of each, and a hash of what lies between."""
    count = np.maximum(size - length + 1, 0)
    before = np.cumsum(count) - count
    code = store.array(int(count.sum()), np.uint64)
    spans = list(chunks(size, max(store.step, 1)))
    windows = lambda lo, hi: (np.repeat(np.arange(lo, hi), count[lo:hi]), np.arange(int(count[lo:hi].sum())) - np.repeat(before[lo:hi] - before[lo], count[lo:hi]))
    for lo, hi in spans:
        piece, offset = windows(lo, hi)
        at = base[piece] - base[lo] + offset
        code[before[lo] : before[lo] + len(at)] = textbytes.Prefix(whole[base[lo] : base[hi - 1] + size[hi - 1]]).of(at, at + length)
    shared = _recurring(code, store)
    out = [(np.zeros(0, dtype=np.int64),) * 3 + (np.zeros(0, dtype=np.uint64),)]
    for lo, hi in spans:
        piece, offset = windows(lo, hi)
        own = shared[before[lo] : before[lo] + len(piece)]
        piece, offset = piece[own], offset[own]
        if not len(piece):
            continue
        begin = np.flatnonzero(changes(piece))
        until = np.concatenate((begin[1:], [len(piece)])) - 1
        owner, first, last = piece[begin], offset[begin], offset[until]
        at = base[owner] - base[lo]
        content = textbytes.Prefix(whole[base[lo] : base[hi - 1] + size[hi - 1]]).of(at + first, at + last + length)
        out.append((owner, first, last, content))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _sort_block(part: dict[str, np.ndarray], whole: np.ndarray, length: int, store: Store) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Covered ranges of a block of whole minimiser groups, whose pieces' bytes lie one after the other."""
    size = part["size"]
    base = np.cumsum(size) - size
    inner = Store(store.left)
    try:
        owner, first, last, content = _trimmed(whole, base, size, length, inner)
    finally:
        inner.close()
    if not len(owner):
        return
    key, doc, start, cut = part["key"][owner], part["doc"][owner], part["at"][owner] + first, base[owner] + first
    n = last - first + 1
    # equal trimmed pieces fold into the first; each text is then sorted once
    order = np.lexsort((start, doc, n, content, key))
    new = changes(key[order], content[order], n[order])
    head = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    later = (doc[order] != doc[head]) | (start[order] != start[head])
    d, a, end = _merged(doc[order][later], start[order][later], (start + n)[order][later] + length - 1)
    yield d, a, end - a
    keep = np.sort(order[new])
    doc, start, cut, span = doc[keep], start[keep], cut[keep], n[keep] + length - 1
    place = np.concatenate(([0], np.cumsum(span + 1)))
    text = store.array(int(place[-1]), np.int16)
    inside = lambda lo, hi: np.arange(int(span[lo:hi].sum())) - np.repeat(np.cumsum(span[lo:hi]) - span[lo:hi], span[lo:hi])
    spans = list(chunks(span, max(store.step, 1)))
    for lo, hi in spans:
        within = inside(lo, hi)
        text[np.repeat(place[lo:hi], span[lo:hi]) + within] = whole[np.repeat(cut[lo:hi], span[lo:hi]) + within].astype(np.int16) + 1
    suffix, shared = suffix_order(text, length, store)
    gone = store.array(len(text), bool)
    lo = 0
    while lo < len(suffix):
        # whole groups of equal windows: no larger than a crowd
        hi = min(lo + store.step, len(suffix))
        while hi < len(suffix) and (shared[hi : hi + store.step] >= length).all():
            hi = min(hi + store.step, len(suffix))
        if hi < len(suffix):
            hi += int(np.argmax(shared[hi : hi + store.step] < length))
        at = suffix[lo:hi].astype(np.int64)
        number = np.searchsorted(place, at, side="right") - 1
        usable = at - place[number] + length <= span[number]
        group = np.cumsum(shared[lo:hi] < length)[usable]
        at, number = at[usable], number[usable]
        d, a = doc[number], start[number] + at - place[number]
        order = np.lexsort((a, d, group))
        new = changes(group[order])
        head = order[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(order) else order
        later = (d[order] != d[head]) | (a[order] != a[head])
        gone[at[order][later]] = True
        lo = hi
    for lo, hi in spans:
        at = np.flatnonzero(gone[place[lo] : place[hi]]) + place[lo]
        number = np.searchsorted(place, at, side="right") - 1
        a = start[number] + at - place[number]
        d, a, end = _merged(doc[number], a, a + length)
        yield d, a, end - a


def _sort_shards(length: int, block: int, memory: int):
    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        spool = Spool(memory // 4)

        def flush():
            store = Store(memory - memory // 4)
            try:
                part = {c: np.concatenate([h[c] for h in held]) for c in held[0]}
                for found in _sort_block(part, spool.buffer(), length, store):
                    yield pa.RecordBatch.from_arrays([pa.array(x, type=pa.int64()) for x in found], schema=_RANGES)
            finally:
                spool.close()
                store.close()

        for part in key_runs(batches, "key"):
            pieces = part.pop("bytes")
            part["size"] = np.fromiter((len(b) for b in pieces), dtype=np.int64, count=len(pieces))
            # a batch may hold many groups: cut it where a block is full
            total = np.cumsum(part["size"])
            lo = 0
            for e in [*np.flatnonzero(changes(part["key"]))[1:].tolist(), len(total)]:
                more = int(total[e - 1] - (total[lo - 1] if lo else 0))
                if more + spool.size >= block or e == len(total):
                    held.append({c: x[lo:e] for c, x in part.items()})
                    spool.add(b"".join(pieces[lo:e]))
                    lo = e
                    if spool.size >= block:
                        yield from flush()
                        held, spool = [], Spool(memory // 4)
        if held:
            yield from flush()

    return run


def _crowds(plain: DataFrame, length: int) -> DataFrame | None:
    """Minimisers that a sample of documents shows to be crowded; None if there are none."""
    sample = plain.where(F.pmod(F.xxhash64("doc", "base"), F.lit(HINT)) == 0).mapInArrow(_cut(length), _RUNS_SQL)
    counted = sample.where(F.col("state") == OPEN).groupBy("key").agg(F.count("*").alias("runs"))
    crowded = saved(counted.where(F.col("runs") > max(CROWD // HINT, 1)).select("key"), "crowds")
    return crowded if crowded.limit(1).count() else None


def covered_ranges(plain: DataFrame, length: int = 100) -> DataFrame:
    """Byte ranges to remove: one row per document that has any, with ``doc`` and
    ``ranges``, an array that alternates start and end, not yet merged.

    ``plain`` has documents' ``doc``, ``text`` as bytes and ``base``, to which positions add.
    """
    parts = fold(plain.sparkSession)
    long = plain.where(F.length("text") >= length)
    runs = long.mapInArrow(_cut(length), _RUNS_SQL)
    crowds = _crowds(long, length)
    if crowds is not None:
        # equal runs of a crowd still meet, different ones go apart
        known = small_side(crowds.select(F.col("key").alias("crowd")))
        marked = runs.join(known, (F.col("key") == F.col("crowd")) & (F.col("state") == OPEN), "left")
        inside = F.col("crowd").isNotNull()
        runs = marked.select(F.when(inside, F.xxhash64("key", "digest", "n")).otherwise(F.col("key")).alias("key"), "digest", "doc", "at", "n", F.when(inside, CROWDED).otherwise(F.col("state")).cast("byte").alias("state"))
    runs = runs.repartition(parts, "key").sortWithinPartitions("key", "digest", "n", "doc", "at")
    runs = saved(runs.mapInArrow(_fold_equal(length), _RUNS_SQL), "runs")
    open_runs = runs.where(F.col("state") == OPEN).select("key", "doc", "at", "n")
    crowd = runs.where(F.col("state") == CROWDED).select("key", "doc", "at", "n")
    missed = saved(open_runs.groupBy("key").agg(F.count("*").alias("runs")).where(F.col("runs") > CROWD).select("key"), "crowded")
    if missed.limit(1).count():
        crowd = crowd.unionByName(open_runs.join(small_side(missed), "key", "left_semi"))
        open_runs = open_runs.join(small_side(missed), "key", "left_anti")
    pieces = _pieces(plain, open_runs, length).repartition(parts, "key").sortWithinPartitions("key")
    found = pieces.mapInArrow(_sort_shards(length, BLOCK, induced.MEMORY), "doc long, at long, n long")
    if crowd.limit(1).count():
        single = _pieces(plain, crowd, length, single=True)
        single = single.repartition(parts, "key").sortWithinPartitions("key", "digest", "n", "doc", "at")
        found = found.unionByName(single.mapInArrow(_fold_equal(length), _RUNS_SQL).where(F.col("state") == COVERED).select("doc", "at", "n"))
    every = runs.where(F.col("state") == COVERED).select("doc", "at", "n").unionByName(found)
    return every.groupBy("doc").agg(F.flatten(F.collect_list(F.array("at", F.col("at") + F.col("n")))).alias("ranges"))


def _plain(docs: DataFrame, id_col: str, text_col: str, others: list[str]) -> DataFrame:
    """``doc``, ``text`` as bytes, ``base`` and other columns of rows with an id.

    Base is 0, but for ids that come with several texts, which it holds apart.
    """
    kept = [F.col(f"`{c}`").alias(f"kept_{i}") for i, c in enumerate(others)]
    plain = docs.select(F.col(id_col).cast("long").alias("doc"), text_bytes(text_col).alias("text"), *kept).where("doc is not null")
    hashed = plain.select("doc", F.xxhash64("text").alias("hash"))
    several = saved(hashed.groupBy("doc").agg(F.min("hash").alias("least"), F.max("hash").alias("most")).where("least <> most").select("doc"), "several")
    if not several.limit(1).count():
        return plain.withColumn("base", F.lit(0).cast("long"))
    each = hashed.join(small_side(several), "doc", "left_semi").distinct()
    rank = F.row_number().over(W.partitionBy("doc").orderBy("hash")).cast("long") - 1
    each = saved(each.select(F.col("doc").alias("id"), "hash", F.shiftleft(rank, APART).alias("base")), "texts")
    if each.where(f"base < 0 or base >= {1 << 62}").limit(1).count():
        raise ValueError("an id has too many different texts")
    joined = plain.join(small_side(each), (F.col("doc") == F.col("id")) & (F.xxhash64("text") == F.col("hash")), "left")
    return joined.select(*plain.columns, F.coalesce("base", F.lit(0).cast("long")).alias("base"))


def _remove(batches: Iterator[pa.RecordBatch], whole_characters: bool) -> Iterator[tuple[pa.RecordBatch, list]]:
    for batch in small_batches(batches):
        rows = []
        for text, base, ranges in zip(batch.column("text"), batch.column("base").to_pylist(), batch.column("ranges"), strict=True):
            text = text.as_py()
            flat = ranges.values.to_numpy().reshape(-1, 2) if ranges.is_valid else np.zeros((0, 2), dtype=np.int64)
            flat = flat[flat[:, 0] >> APART == base >> APART] - base
            if not len(flat):
                rows.append((len(text), 0, 0, text))
                continue
            _, at, end = _merged(np.zeros(len(flat), dtype=np.int64), flat[:, 0], np.minimum(flat[:, 1], len(text)))
            kept, last, removed, spans = [], 0, 0, 0
            for a, e in zip(at.tolist(), end.tolist(), strict=True):
                if whole_characters:  # a character of which a part stays, stays whole
                    while a < e and text[a] & 0xC0 == 0x80:
                        a += 1
                    while e > a and e < len(text) and text[e] & 0xC0 == 0x80:
                        e -= 1
                if e > a:
                    kept.append(text[last:a])
                    last, removed, spans = e, removed + e - a, spans + 1
            kept.append(text[last:])
            rows.append((len(text), removed, spans, b"".join(kept)))
        yield batch, rows


@tidy_after
def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, rows in _remove(batches, False):
        n, removed, spans, kept = zip(*rows, strict=True) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def _with_ranges(docs: DataFrame, id_col: str, text_col: str, length: int, others: list[str]) -> DataFrame:
    plain = _plain(docs, id_col, text_col, others)
    ranges = covered_ranges(plain.select("doc", "text", "base"), length)
    return plain.join(small_side(saved(ranges, "ranges")), "doc", "left")


def removal_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100) -> DataFrame:
    """Per row: bytes, removed bytes, maximal removed runs and the SHA-256 of what is left."""
    return _with_ranges(docs, id_col, text_col, length, []).select("doc", "text", "base", "ranges").mapInArrow(_digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100) -> DataFrame:
    """``docs`` with repeated strings cut out of the text; all rows and columns stay.

    A character that is only partly covered stays whole, so that the text remains
    valid.  A null text stays null.  Rows with a null id stay as they are.
    """
    others = [c for c in docs.columns if c != text_col]
    joined = _with_ranges(docs, id_col, text_col, length, [*others, text_col])
    schema = ", ".join(f"kept_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(others)) + ", text__ string"

    @tidy_after
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows in _remove(batches, True):
            valid = batch.column(f"kept_{len(others)}").is_valid().to_pylist()
            text = pa.array([r[3].decode("utf-8", "replace") if ok else None for r, ok in zip(rows, valid, strict=True)], pa.string())
            names = [f"kept_{i}" for i in range(len(others))]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], text], names=[*names, "text__"])

    done = joined.drop("doc").mapInArrow(cut, schema)
    named = {c: F.col(f"kept_{i}").alias(c) for i, c in enumerate(others)} | {text_col: F.col("text__").alias(text_col)}
    return done.select(*[named[c] for c in docs.columns]).unionByName(docs.where(F.col(id_col).isNull()))
