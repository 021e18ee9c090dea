"""Suffix order and common prefixes by recursive induced sorting on disk-backed queues.

Suffixes are classed as descending (their first symbol that differs from the leading run is smaller) or
ascending.  The ascending ones that follow a descending one anchor the order: their
pieces are named, the string of names is sorted by recursion, and two sweeps induce
all other suffixes from the anchors.  A sweep is a priority queue over (first symbol, rank of the
following suffix): each symbol has a first-in-first-out region, because pushes reach it in
rank order.  The regions lie in one array and are read and appended to in slices.  Next to each
suffix tuple (position, slot of the suffix it was induced by) the sweeps carry
the prefix shared with its neighbour: one more than the least value between the two
inducing suffixes.

Every array as long as the text (the text itself, classes, names, queues, prefixes, symbol
counts) comes from a ``Store``: once their sum passes the memory limit, further ones are
memory-mapped files in the task's own temporary folder.  All work on them goes slice by slice, so
that a text may be far larger than the limit.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator

import numpy as np

#: Bytes of a store's arrays that stay in memory; the others are files.
MEMORY = 16 << 20
#: Slots that are induced from one by one.
FEW = 6


class Store:
    """Arrays in memory up to a limit, then in files of a temporary folder of this task."""

    def __init__(self, memory: int = MEMORY) -> None:
        self.left = memory
        #: Items of a slice: some arrays of so many are held besides.
        self.step = max(1, memory // 64)
        self.files = 0
        self._folder: tempfile.TemporaryDirectory | None = None

    def array(self, n: int, dtype) -> np.ndarray:
        """An array of zeros."""
        size = n * np.dtype(dtype).itemsize
        if size <= self.left or not n:
            self.left -= size
            return np.zeros(n, dtype=dtype)
        if self._folder is None:
            self._folder = tempfile.TemporaryDirectory(prefix="induced-")
        self.files += 1
        made = np.memmap(os.path.join(self._folder.name, str(self.files)), dtype=dtype, mode="w+", shape=(n,))
        return made.view(np.ndarray)

    def slices(self, lo: int, hi: int) -> Iterator[tuple[int, int]]:
        for at in range(lo, hi, self.step):
            yield at, min(at + self.step, hi)

    def close(self) -> None:
        if self._folder is not None:
            self._folder.cleanup()
            self._folder = None


def index_kind(n: int):
    """The integers that count to n."""
    return np.int32 if n < 1 << 31 else np.int64


def common(text: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Symbols that the suffixes at a and b share, up to ``cap``."""
    out = np.zeros(len(a), dtype=np.int32)
    n, live, depth = len(text), np.arange(len(a)), 0
    while len(live) and depth < cap:
        x, y = a[live] + depth, b[live] + depth
        inside = (x < n) & (y < n)
        live, x, y = live[inside], x[inside], y[inside]
        live = live[text[x] == text[y]]
        out[live] += 1
        depth += 1
    return out


def _ascending(text: np.ndarray, store: Store) -> np.ndarray:
    """Class of each suffix; the end of the text is less than any symbol."""
    n = len(text)
    up = store.array(n, bool)
    after, kind = -1, False
    for lo, hi in reversed(list(store.slices(0, n))):
        part = np.append(text[lo:hi].astype(np.int64), after)
        ends = np.flatnonzero(part[1:] != part[:-1])
        kinds = part[ends] < part[ends + 1]
        if part[-2] == part[-1]:  # the last run goes on in the slice that follows
            ends, kinds = np.append(ends, hi - lo - 1), np.append(kinds, kind)
        up[lo:hi] = np.repeat(kinds, np.diff(ends, prepend=-1))
        after, kind = int(part[0]), bool(up[lo])
    return up


def _anchors(up: np.ndarray, store: Store) -> np.ndarray:
    """Positions of ascending suffixes that follow a descending one."""
    found = lambda lo, hi: np.flatnonzero(up[lo + 1 : hi + 1] & ~up[lo:hi]) + lo + 1
    spans = list(store.slices(0, max(len(up) - 1, 0)))
    out = store.array(sum(len(found(lo, hi)) for lo, hi in spans), index_kind(len(up)))
    at = 0
    for lo, hi in spans:
        some = found(lo, hi)
        out[at : at + len(some)] = some
        at += len(some)
    return out


def _occurrence(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each item its rank among the earlier equal symbols; the symbols; their counts."""
    if len(symbols) == 1:
        return np.zeros(1, dtype=np.int64), symbols, np.ones(1, dtype=np.int64)
    order = np.argsort(symbols, kind="stable")
    s = symbols[order]
    first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
    count = np.diff(np.concatenate((first, [len(s)])))
    rank = np.empty(len(s), dtype=np.int64)
    rank[order] = np.arange(len(s)) - np.repeat(first, count)
    return rank, s[first], count


class _Sweeps:
    """Both induction sweeps over one text; without ``cap`` no prefixes are carried."""

    def __init__(self, text: np.ndarray, up: np.ndarray, store: Store, cap: int) -> None:
        self.text, self.up, self.cap, self.store = text, up, cap, store
        n, kind = len(text), index_kind(len(text))
        kinds = max(int(text[lo:hi].max()) for lo, hi in store.slices(0, n)) + 1
        self.size, self.begin, self.end, self.head, self.tail = (store.array(kinds, np.int64) for _ in range(5))
        for lo, hi in store.slices(0, n):
            symbol, count = np.unique(text[lo:hi], return_counts=True)
            self.size[symbol] += count
        np.cumsum(self.size, out=self.end)
        np.subtract(self.end, self.size, out=self.begin)
        self.queue = store.array(n, kind)
        if cap:
            self.source = store.array(n, kind)
            self.shared = store.array(n, np.int16 if cap < 1 << 15 else np.int32)
            for lo, hi in store.slices(0, n):
                self.shared[lo:hi] = cap

    def run(self, anchors: np.ndarray) -> np.ndarray:
        text, queue, n, store = self.text, self.queue, len(self.text), self.store
        head, tail = self.head, self.tail
        tail[:], head[:] = self.end, self.begin
        # from the last anchor to the first, each symbol's region fills from its end
        for lo, hi in reversed(list(store.slices(0, len(anchors)))):
            items = anchors[lo:hi][::-1]
            symbol = text[items]
            rank, kinds, count = _occurrence(symbol)
            where = tail[symbol] - 1 - rank
            queue[where] = items
            tail[kinds] -= count
            if self.cap:
                # neighbouring anchors' shared prefixes seed those that are carried
                seed = np.zeros(hi - lo, dtype=np.int32)
                before = anchors[max(lo - 1, 0) : hi - 1]
                seed[hi - lo - len(before) :] = common(text, before, anchors[hi - len(before) : hi], self.cap)
                self.shared[where[::-1]] = seed
        # the suffix before the end of the text is descending and induced by the empty one
        self._push(np.array([n - 1]), np.array([-1]), head)
        for c in self._present(False):
            at, until = int(self.begin[c]), int(self.end[c])
            begin = at
            if self.cap and head[c] > at:
                self.shared[at] = 0
            while at < head[c]:
                stop = min(int(head[c]), at + store.step)
                if self.cap:
                    self._carry(max(at - 1, begin), stop)
                self._descending(at, stop, head)
                at = stop
            first = int(tail[c])
            if first < until:
                if self.cap:
                    self._join(int(head[c]), begin, first)
                for lo, hi in store.slices(first, until):
                    self._descending(lo, hi, head)
        low = tail
        low[:] = self.end
        for c in self._present(True):
            begin, until = int(self.begin[c]), int(self.end[c])
            at = until
            while at > low[c]:
                stop = max(int(low[c]), at - store.step)
                if self.cap:
                    self._carry(stop, min(at + 1, until))
                self._ascending(stop, at, low)
                at = stop
            if self.cap and low[c] < until:
                self._join(int(head[c]), begin, int(low[c]))
            for lo, hi in reversed(list(store.slices(begin, int(head[c])))):
                self._ascending(lo, hi, low)
        return queue

    def _present(self, back: bool) -> Iterator[int]:
        """Symbols that occur, in order or against it."""
        spans = list(self.store.slices(0, len(self.size)))
        for lo, hi in reversed(spans) if back else spans:
            some = (np.flatnonzero(self.size[lo:hi]) + lo).tolist()
            yield from reversed(some) if back else some

    def _join(self, head: int, begin: int, first: int) -> None:
        """The prefix that a symbol's first ascending suffix shares with its last descending one."""
        if head > begin:
            self.shared[first] = common(self.text, self.queue[head - 1 : head], self.queue[first : first + 1], self.cap)[0]
        else:
            self.shared[first] = 0

    def _push(self, items: np.ndarray, source: np.ndarray, head: np.ndarray) -> None:
        symbol = self.text[items]
        rank, kinds, count = _occurrence(symbol)
        where = head[symbol] + rank
        self.queue[where] = items
        if self.cap:
            self.source[where] = source
        head[kinds] += count

    def _few(self, slots: range, up: bool, pointer: np.ndarray) -> None:
        """Induces from a few slots one by one, which costs less than arrays do."""
        for slot in slots:
            before = int(self.queue[slot]) - 1
            if before < 0 or self.up[before] != up:
                continue
            symbol = self.text[before]
            where = int(pointer[symbol]) - up
            self.queue[where] = before
            if self.cap:
                self.source[where] = slot
            pointer[symbol] = where if up else where + 1

    def _descending(self, lo: int, hi: int, head: np.ndarray) -> None:
        if hi - lo <= FEW:
            self._few(range(lo, hi), False, head)
            return
        before = self.queue[lo:hi] - 1
        keep = before >= 0
        keep[keep] = ~self.up[before[keep]]
        if keep.any():
            self._push(before[keep], np.flatnonzero(keep) + lo, head)

    def _ascending(self, lo: int, hi: int, low: np.ndarray) -> None:
        if hi - lo <= FEW:
            self._few(range(hi - 1, lo - 1, -1), True, low)
            return
        before = self.queue[lo:hi][::-1] - 1
        keep = before >= 0
        keep[keep] = self.up[before[keep]]
        if not keep.any():
            return
        items = before[keep]
        symbol = self.text[items]
        rank, kinds, count = _occurrence(symbol)
        where = low[symbol] - 1 - rank
        self.queue[where] = items
        if self.cap:
            self.source[where] = hi - 1 - np.flatnonzero(keep)
        low[kinds] -= count

    def _carry(self, lo: int, hi: int) -> None:
        """Prefixes that the slots lo+1..hi share with those before, from those between their sources."""
        if hi - lo < 2:
            return
        source = self.source[lo:hi].astype(np.int64)
        # sources ascend, so the ranges (source[i-1], source[i]] lie side by side
        least = np.minimum.reduceat(self.shared[: source[-1] + 1], source[:-1] + 1)
        self.shared[lo + 1 : hi] = np.minimum(least + 1, self.cap)


def _order(text: np.ndarray, store: Store, cap: int) -> _Sweeps:
    up = _ascending(text, store)
    anchors = _anchors(up, store)
    sweeps = _Sweeps(text, up, store, cap)
    if len(anchors) > 1:
        # pieces between anchors, sorted by inducing from unsorted anchors, in room that is given back
        inner = Store(store.left)
        inner.step = store.step
        try:
            rough = _Sweeps(text, up, inner, 0).run(anchors)
            anchor = inner.array(len(text), bool)
            for lo, hi in store.slices(0, len(anchors)):
                anchor[anchors[lo:hi]] = True
            ordered = store.array(len(anchors), anchors.dtype)
            at = 0
            for lo, hi in store.slices(0, len(text)):
                some = rough[lo:hi][anchor[rough[lo:hi]]]
                ordered[at : at + len(some)] = some
                at += len(some)
        finally:
            inner.close()
        inner = Store(store.left)
        inner.step = store.step
        try:
            names, distinct = _names(text, anchors, ordered, inner)
            if distinct < len(anchors):
                rank = _order(names, inner, 0).queue
                for lo, hi in store.slices(0, len(anchors)):
                    ordered[lo:hi] = anchors[rank[lo:hi]]
        finally:
            inner.close()
        anchors = ordered
    sweeps.run(anchors)
    return sweeps


def _names(text: np.ndarray, anchors: np.ndarray, ordered: np.ndarray, store: Store) -> tuple[np.ndarray, int]:
    """Name of each anchor's piece, which reaches to the next anchor, in text order; how many there are."""
    names = store.array(len(anchors), index_kind(len(anchors)))
    last, rank = len(anchors) - 1, 0
    for lo, hi in store.slices(0, len(ordered)):
        own = ordered[max(lo - 1, 0) : hi].astype(np.int64)
        index = np.searchsorted(anchors, own)
        size = np.where(index < last, anchors[np.minimum(index + 1, last)] + 1, len(text)) - own
        same = size[:-1] == size[1:]
        same[(index[:-1] == last) | (index[1:] == last)] = False
        live, depth = np.flatnonzero(same), 0
        while len(live):
            live = live[depth < size[live]]
            differ = text[own[live] + depth] != text[own[live + 1] + depth]
            same[live[differ]] = False
            live = live[~differ]
            depth += 1
        # the first of a slice follows on the last of the one before
        rise = np.cumsum(~same) if lo else np.concatenate(([0], np.cumsum(~same)))
        names[index[len(index) - (hi - lo) :]] = rise + rank
        rank += int(rise[-1])
    return names, rank + 1


def suffix_order(text: np.ndarray, cap: int, store: Store) -> tuple[np.ndarray, np.ndarray]:
    """Positions of ``text``'s suffixes in order, and each one's prefix shared with the last.

    ``text`` holds integers from 0; shared prefixes are counted up to ``cap``.  An empty text
    has no suffixes.  The arrays are ``store``'s, and end with it.
    """
    if not len(text):
        return store.array(0, np.int32), store.array(0, np.int16)
    done = _order(text, store, cap)
    return done.queue, done.shared
