"""Maximal periodic runs of words, by Crochemore's refinement of equal-factor classes.

Two positions of a text are in one class of length l if the l words from each on are equal.  Classes of length l + 1 follow
from those of length l: a class parts by the classes of its positions' successors.  Of the parts that a class fell into, only
the smaller ones, all but the largest, need to part others in turn (the smaller-half strategy), so that a position
takes part in at most log2(n) of the lengths.

Each class is a linked list of its positions in order.  Neighbours of a class of length l that are l apart are the halves
of a square whose root is no power of a shorter word: within a square of a power, the shorter period's occurrence
lies between them.  Squares of one period from adjacent starts make up one run, and all maximal runs are found so.

Many texts are refined together, a mark of its own after each, so that numpy's cost for each length is shared.  Memory
is a few numbers a word; texts are taken in chunks of about ``TOGETHER`` words, longer texts alone.

Defined results: a null, empty or blank text has no runs and collapses to the empty text; a row with a null id is not
made periodic; repeated ids and rows each have a row of their own; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_bytes, tidy_after

#: Words of texts that are refined together, about.
TOGETHER = 1 << 20
#: Bytes of a word, about.
WORD = 6
#: Words of the shortest run.
LEAST = 12


def _spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for each span, one after the other."""
    done = np.cumsum(size)
    return np.repeat(start - done + size, size) + np.arange(int(done[-1]) if len(done) else 0)


class Classes:
    """Classes of equal factors, as linked lists of ascending positions.

    A class that has no other position counts as none (-1).  ``pool`` holds each class's members, and possibly some that have
    left it since; it is renewed when it has grown to several times the positions.
    """

    def __init__(self, codes: np.ndarray) -> None:
        n = len(codes)
        self.n, self.length = n, 1
        order = np.argsort(codes, kind="stable")
        edge = np.flatnonzero(np.concatenate(([True], codes[order][1:] != codes[order][:-1])))
        self.count = np.diff(np.append(edge, n))
        self.used = len(edge)
        self.start, self.held, self.pool, self.filled = edge.copy(), self.count.copy(), order, n
        self.cls = np.empty(n, dtype=np.int64)
        self.cls[order] = np.repeat(np.arange(len(edge)), self.count)
        self.next, self.prev = np.full(n, -1, dtype=np.int64), np.full(n, -1, dtype=np.int64)
        same = np.ones(n, dtype=bool)
        same[edge] = False
        later = np.flatnonzero(same)
        self.next[order[later - 1]], self.prev[order[later]] = order[later], order[later - 1]
        self.cls[order[edge[self.count == 1]]] = -1
        self.gone = np.zeros(n, dtype=bool)
        self.changed = np.flatnonzero(self.next >= 0)  # positions whose next one is new
        self.small = np.arange(n)

    def _grow(self, more: int) -> None:
        while self.used + more > len(self.count):
            pad = np.zeros(len(self.count) + more, dtype=np.int64)
            self.count, self.start, self.held = (np.concatenate((a, pad)) for a in (self.count, self.start, self.held))

    def _store(self, members: np.ndarray, which: np.ndarray, size: np.ndarray) -> None:
        """New blocks of the pool for classes, whose members stand one after the other."""
        if self.filled + len(members) > len(self.pool):
            self.pool = np.concatenate((self.pool[: self.filled], np.empty(max(len(members), self.n), dtype=np.int64)))
        self.pool[self.filled : self.filled + len(members)] = members
        self.start[which] = self.filled + np.cumsum(size) - size
        self.held[which] = size
        self.filled += len(members)

    def _renew(self) -> None:
        live = np.flatnonzero(self.cls >= 0)
        members = live[np.argsort(self.cls[live], kind="stable")]
        ids, size = np.unique(self.cls[members], return_counts=True)
        self.filled, self.pool = 0, np.empty(max(2 * self.n, 1), dtype=np.int64)
        self._store(members, ids, size)

    def _members(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of classes, ascending in each, without those marked as ``gone``; and their classes."""
        at = _spans(self.start[which], self.held[which])
        p, c = self.pool[at], np.repeat(which, self.held[which])
        keep = (self.cls[p] == c) & ~self.gone[p]
        return p[keep], c[keep]

    def refine(self) -> None:
        """From classes of one length to those of the next."""
        self.length += 1
        small = self.small[self.small > 0]
        p = small - 1
        c = self.cls[p]
        inside = c >= 0
        inside[inside] = self.count[c[inside]] > 1
        p, c, after = p[inside], c[inside], self.cls[small[inside]]
        self.small = self.changed = np.zeros(0, dtype=np.int64)
        if not len(p):
            return
        # parts of a class by the successor's class; one that is alone counts as a class of its own
        order = np.lexsort((p, np.where(after >= 0, after, self.used + p), c))
        p, c, after = p[order], c[order], after[order]
        new_class = np.concatenate(([True], c[1:] != c[:-1]))
        new_part = new_class.copy()
        new_part[1:] |= (after[1:] != after[:-1]) | (after[1:] < 0)
        part_at = np.flatnonzero(new_part)
        size = np.diff(np.append(part_at, len(p)))
        first = np.flatnonzero(new_class[part_at])  # of a class's parts
        of = np.cumsum(new_class[part_at]) - 1  # a part's class, by number
        owner = c[part_at[first]]
        rest = self.count[owner] - np.add.reduceat(size, first)
        largest = np.maximum.reduceat(size, first)
        # the rest stays as it is unless a part is larger, which then keeps the class
        by_part = rest < largest
        keeper = np.full(len(first), -1, dtype=np.int64)
        best = np.flatnonzero(size == largest[of])[::-1]
        keeper[of[best]] = best
        keeper[~by_part] = -1
        stays = np.zeros(len(size), dtype=bool)
        stays[keeper[by_part]] = True
        part = np.cumsum(new_part) - 1
        moved = ~stays[part]
        mp, mc, mg = p[moved], c[moved], part[moved]
        parted = by_part & (rest > 0)
        if parted.any():
            self.gone[p] = True
            rp, rc = self._members(owner[parted])
            self.gone[p] = False
            number = np.searchsorted(owner[parted], rc) + len(size)
            mp, mc, mg = np.concatenate((mp, rp)), np.concatenate((mc, rc)), np.concatenate((mg, number))
        if not len(mp):
            return
        split = parted | (np.diff(first, append=len(size)) > 1)
        kept = (stays & split[of])[part]
        # take the moved ones out of their lists, a stretch of neighbours at a time
        self.gone[mp] = True
        before, behind = self.prev[mp], self.next[mp]
        head = (before < 0) | ~self.gone[before]
        tail = (behind < 0) | ~self.gone[behind]
        self.gone[mp] = False
        heads, tails = np.flatnonzero(head), np.flatnonzero(tail)
        heads, tails = heads[np.lexsort((mp[heads], mc[heads]))], tails[np.lexsort((mp[tails], mc[tails]))]
        left, right = before[heads], behind[tails]
        self.next[left[left >= 0]] = right[left >= 0]
        self.prev[right[right >= 0]] = left[right >= 0]
        changed = [left[(left >= 0) & (right >= 0)]]
        np.subtract.at(self.count, mc, 1)
        # each moved part is a class
        order = np.lexsort((mp, mg))
        mp, mg = mp[order], mg[order]
        edge = np.flatnonzero(np.concatenate(([True], mg[1:] != mg[:-1])))
        size = np.diff(np.append(edge, len(mp)))
        several = size > 1
        self._grow(int(several.sum()))
        name = np.full(len(edge), -1, dtype=np.int64)
        name[several] = self.used + np.arange(int(several.sum()))
        self.used += int(several.sum())
        self.cls[mp] = np.repeat(name, size)
        self.count[name[several]] = size[several]
        self.next[mp], self.prev[mp] = -1, -1
        linked = np.ones(len(mp), dtype=bool)
        linked[edge] = False
        later = np.flatnonzero(linked)
        self.next[mp[later - 1]], self.prev[mp[later]] = mp[later], mp[later - 1]
        changed.append(mp[later - 1])
        self._store(mp[np.repeat(several, size)], name[several], size[several])
        if kept.any():
            kp, kc = p[kept], c[kept]
            at = np.flatnonzero(np.concatenate(([True], kc[1:] != kc[:-1])))
            self._store(kp, kc[at], np.diff(np.append(at, len(kp))))
        if self.filled > 8 * self.n:
            self._renew()
        self.small = np.sort(mp)
        self.changed = np.concatenate(changed)


def find_runs(codes: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all maximal runs of ``least`` elements or more, by start, then period.

    A run is at least twice as long as its smallest period.  Texts are parted by elements that occur once.
    """
    found: list[np.ndarray] = []
    classes = Classes(codes)
    due: dict[int, list[np.ndarray]] = {}
    horizon = 1
    while True:
        at = classes.length
        if at >= horizon:
            # neighbours that are so far apart that their squares are due before the next look at all
            horizon = 2 * at
            linked = np.flatnonzero(classes.next >= 0)
            due = {}
        else:
            linked = classes.changed
        if len(linked):
            gap = classes.next[linked] - linked
            near = (gap >= at) & (gap < horizon)
            linked, gap = linked[near], gap[near]
            if len(linked):
                order = np.argsort(gap, kind="stable")
                gap = gap[order]
                edge = np.flatnonzero(np.concatenate(([True], gap[1:] != gap[:-1])))
                for g, part in zip(gap[edge].tolist(), np.split(linked[order], edge[1:]), strict=True):
                    due.setdefault(g, []).append(part)
        if at in due:
            roots = np.unique(np.concatenate(due.pop(at)))
            roots = roots[classes.next[roots] - roots == at]
            if len(roots):
                begin = np.flatnonzero(np.concatenate(([True], roots[1:] != roots[:-1] + 1)))
                last = np.append(begin[1:], len(roots)) - 1
                found.append(np.stack((roots[begin], roots[last] - roots[begin] + 2 * at, np.full(len(begin), at))))
        if not len(classes.small):
            break
        classes.refine()
    every = np.concatenate(found, axis=1) if found else np.zeros((3, 0), dtype=np.int64)
    every = every[:, every[1] >= least]
    return tuple(every[:, np.lexsort((every[2], every[0]))])


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()), ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])
_RESULT_SQL = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def repeat_tail(words: list, at: int, period: int) -> list:
    """The words up to ``at``, then the ``period`` words from there on, again and again, as many words in all."""
    times = -(-(len(words) - at) // period)
    return words[:at] + (words[at : at + period] * times)[: len(words) - at]


def _words(text: bytes, seed: int | None, planted: bool) -> list[bytes]:
    words = text.split()  # at the ASCII white space
    if planted and words and seed is not None and seed % 10 == 0:
        g, n = seed // 10, len(words)
        words = repeat_tail(words, g % n, 1 + (n - g % n) // (3 + g % 8))
    return words


def report(texts: list[list[bytes]], least: int = LEAST) -> list[tuple]:
    """For each text: its runs, the greatest of them, and hashes of the list of runs and of what stays without repeats."""
    names: dict[bytes, int] = {}
    size = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    first = np.concatenate(([0], np.cumsum(size)))
    codes = np.empty(int(first[-1]), dtype=np.int64)
    for k, (words, at) in enumerate(zip(texts, first.tolist(), strict=False)):
        names.clear()
        codes[at : at + len(words)] = [names.setdefault(w, len(names)) for w in words]
        codes[at : at + len(words)] += at + k  # classes do not span texts: a text's codes are its own range
        codes[at + len(words)] = at + len(words) + k
    start, length, period = find_runs(codes, least)
    again = np.zeros(len(codes) + 1, dtype=np.int64)
    np.add.at(again, start + period, 1)
    np.add.at(again, start + length, -1)
    again = np.cumsum(again) > 0
    owner = np.searchsorted(first, start, side="right") - 1
    bound = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = []
    for k, words in enumerate(texts):
        lo, hi, at = int(bound[k]), int(bound[k + 1]), int(first[k])
        rows = list(zip((start[lo:hi] - at).tolist(), length[lo:hi].tolist(), period[lo:hi].tolist(), strict=True))
        if rows:
            words = [w for w, drop in zip(words, again[at : at + len(words)].tolist(), strict=True) if not drop]
            s, n, q = min(rows, key=lambda r: (-r[1], r[0], r[2]))
            best = (s, n, q, 1000 * n // q)
        else:
            best = (None,) * 4
        listed = "".join(f"{a},{b},{c}\n" for a, b, c in rows)
        out.append((len(rows), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest()))
    return out


def _run(least: int, planted: bool, together: int):
    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, seeds = (c.to_pylist() for c in batch.columns)
            # texts of like length together, as a chunk takes as many rounds as its longest repeat has words
            order = sorted(range(len(texts)), key=lambda i: len(texts[i]))
            chunk: list[int] = []
            held = 0
            for i in [*order, -1]:
                if chunk and (i < 0 or held + len(texts[i]) > together * WORD):
                    found = report([_words(texts[j], seeds[j], planted) for j in chunk], least)
                    rows = [(ids[j], *r) for j, r in zip(chunk, found, strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), _RESULT, strict=True)], schema=_RESULT)
                    chunk, held = [], 0
                if i >= 0:
                    chunk.append(i)
                    held += len(texts[i]) + WORD

    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, planted: bool = False, together: int = TOGETHER) -> DataFrame:
    """Per row: its runs of words, the greatest one, and hashes of all runs and of the text without what they repeat.

    ``planted`` makes the end of about every tenth text periodic first, by the CRC-32 of its id.
    """
    row = docs.select(F.col(id_col).cast("long"), text_bytes(text_col), F.crc32(F.col(id_col).cast("string").cast("binary")))
    return row.mapInArrow(_run(least, planted, together), _RESULT_SQL)


def without_repeats(docs: DataFrame, text_col: str = "text", least: int = LEAST) -> DataFrame:
    """``docs`` with each text's periodic runs cut to one period, words joined by a space; texts without runs stay as they are."""
    from pyspark.sql.pandas.functions import pandas_udf

    @pandas_udf("string")
    def cut(text):
        words = [(t or "").encode().split() for t in text]
        out = []
        lo = 0
        while lo < len(words):
            hi, held = lo, 0
            while hi < len(words) and (hi == lo or held + len(words[hi]) <= TOGETHER):
                held += len(words[hi])
                hi += 1
            codes, first = [], [0]
            names: dict[tuple[int, bytes], int] = {}
            for k in range(lo, hi):
                codes += [names.setdefault((k, w), len(names)) for w in words[k]]
                codes.append(names.setdefault((k, b" "), len(names)))  # no word
                first.append(len(codes))
            start, length, period = find_runs(np.array(codes, dtype=np.int64), least)
            again = np.zeros(len(codes) + 1, dtype=np.int64)
            np.add.at(again, start + period, 1)
            np.add.at(again, start + length, -1)
            keep = np.cumsum(again) == 0
            for k in range(lo, hi):
                own = keep[first[k - lo] : first[k - lo] + len(words[k])]
                out.append(text.iloc[k] if own.all() else b" ".join(w for w, x in zip(words[k], own.tolist(), strict=True) if x).decode())
            lo = hi
        return type(text)(out)

    return docs.withColumn(text_col, cut(F.col(text_col)))
