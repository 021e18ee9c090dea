"""Vectorised hashing of UTF-8 text: words, word shingles and byte k-grams.

Every function works on one flat ``uint8`` buffer holding several documents, so
that numpy's per-call cost is shared, and keeps its working set to a few times
``CHUNK`` bytes.  Hashes are 64-bit: a prefix sum of random byte codes times powers of
an odd base (mod 2**64), from which the hash of any substring follows in O(1), then a
bit mixer.  They depend only on content, never on the batch a document came in.

Such sums mod 2**64 collide on long strings of a certain structure, whatever the base, from about
2,000 bytes on.  Words longer than ``LONG_WORD`` bytes are therefore hashed by BLAKE2b; ``Prefix`` itself is
for short strings (q-grams, windows of at most 160 bytes), or for what is verified afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np

CHUNK = 1 << 20
#: Words of more bytes are hashed one by one.
LONG_WORD = 32
_U = np.uint64
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 1 << 64)
_CODES = np.random.default_rng(20240611).integers(1, 1 << 63, size=256, dtype=np.uint64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) mod 2**64; the usual lengths are kept."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK + CHUNK // 4)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        if size <= 2 * CHUNK:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def chunks(sizes: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive documents with at most ``limit`` bytes, or one document."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += int(n)
    if start < len(sizes):
        yield start, len(sizes)


class Prefix:
    """Hashes of substrings of one buffer."""

    def __init__(self, buf: np.ndarray) -> None:
        n = len(buf)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_CODES[buf] * _power(_BASE, n), out=self.sums[1:])
        self.inverse = _power(_BASE_INV, n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k bytes from each position on."""
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        return mix((self.sums[k:] - self.sums[:n]) * self.inverse[:n])


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def join(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One buffer, each document followed by a newline, and each document's start."""
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts)), out=starts[1:])
    return np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8), starts


def words(buf: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word of ``join``'s buffer, and its document's index."""
    space = _SPACE[buf]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(buf) and not space[0]:
        edge = np.concatenate(([0], edge))
    begin, end = edge[0::2], edge[1::2]
    return begin, end, np.searchsorted(starts, begin, side="right") - 1


def word_codes(buf: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of every word."""
    code = Prefix(buf).of(begin, end)
    for i in np.flatnonzero(end - begin > LONG_WORD).tolist():
        code[i] = int.from_bytes(blake2b(buf[begin[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    return code


def shingles(texts: list[bytes], width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(index, sorted distinct 64-bit shingles) of every document.

    Texts must be lower-cased already.  A document with fewer than ``width`` words,
    but one at least, has its whole word sequence as its only shingle; one without
    words has none.
    """
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    for lo, hi in chunks(sizes):
        buf, starts = join(texts[lo:hi])
        begin, end, doc = words(buf, starts)
        code = word_codes(buf, begin, end)
        count = np.bincount(doc, minlength=hi - lo)
        first = np.concatenate(([0], np.cumsum(count)))
        n = len(code)
        full = code.copy()
        for j in range(1, min(width, n)):
            full[: n - j] = full[: n - j] * _U(0xD6E8FEB86659FD93) + code[j:]
        full = mix(full)
        inside = np.arange(n) + width <= first[doc + 1]
        short = (count > 0) & (count < width)
        parts, owners = [full[inside]], [doc[inside]]
        for i in np.flatnonzero(short):
            h = _U(int(count[i]))
            for x in code[first[i] : first[i + 1]]:
                h = _U((int(h) * 0xD6E8FEB86659FD93 + int(x)) & _MASK)
            parts.append(mix(np.array([h], dtype=np.uint64)))
            owners.append(np.array([i]))
        value, owner = np.concatenate(parts), np.concatenate(owners)
        order = np.lexsort((value, owner))
        value, owner = value[order], owner[order]
        keep = np.ones(len(value), dtype=bool)
        keep[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
        value, owner = value[keep], owner[keep]
        at = np.searchsorted(owner, np.arange(hi - lo + 1))
        for i in range(hi - lo):
            yield lo + i, value[at[i] : at[i + 1]]


def windows(buf: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of ``length``-byte windows of one text that share their minimiser.

    The minimiser of a window is its leftmost k-gram of least hash.  Returns, for each
    run, the first window start, the number of windows, the minimiser's hash and the hash of the
    bytes that the run's windows cover.  Equal windows have equal minimisers, at equal offsets.
    """
    n = len(buf) - length + 1
    if n <= 0:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    prefix = Prefix(buf)
    gram = prefix.grams(k)
    least = (gram >> _U(24) << _U(24)) | np.arange(len(gram), dtype=np.uint64)
    have, span = 1, length - k + 1
    while have * 2 <= span:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < span:
        least = np.minimum(least[: n], least[span - have : span - have + n])
    at = (least & _U((1 << 24) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    count = np.diff(np.concatenate((first, [n])))
    return first, count, gram[at[first]], prefix.of(first, first + count + length - 1)
