"""Fast tokenizing with vocabularies that never join across ASCII white space.

Texts are split at white space and each distinct word is tokenized once per worker;
the ids of a text are the concatenation of its words' ids.
"""

from __future__ import annotations

import os
from array import array

import numpy as np

from .common import keeps

#: Words that a worker remembers, at most; then it keeps those that recur, up to half as many.
REMEMBERED = 1_000_000
#: A character that stands between words which are tokenized together; words with it go alone.
BETWEEN = "\x01"
#: The word that stands for the end of a text.
END = b"\x02end\x02"

_loaded: dict[str, WordTokens] = {}


class WordTokens:
    def __init__(self, vocabulary: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        mark = self.tokenizer.encode(BETWEEN, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self.end: int | None = None
        self._reset()

    def _reset(self) -> None:
        self.index: dict[bytes, int] = {}
        self.flat = array("I")
        self.ends = array("q", [0])
        self.uses = np.zeros(0, dtype=np.int64)

    def _trim(self) -> None:
        """Forgets words that were used once only, or all if too many recur."""
        words, uses = list(self.index), self.uses
        ends, flat = np.array(self.ends, dtype=np.int64), np.array(self.flat, dtype=np.uint32)
        keep = np.flatnonzero(uses > 1)
        self._reset()
        if 0 < len(keep) <= REMEMBERED // 2:
            begin, size = ends[keep], np.diff(ends)[keep]
            done = np.cumsum(size)
            source = np.repeat(begin - done + size, size) + np.arange(int(done[-1]))
            self._add([words[i] for i in keep.tolist()], flat[source], done)
            self.uses = uses[keep] // 2

    def rest(self) -> None:
        """Keeps only what recurs, while no text is at hand."""
        if len(self.index) > REMEMBERED // 2:
            self._trim()

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=np.uint32) for e in found]

    def _learn(self, words: list[bytes]) -> None:
        """Tokenizes many words at a time, with a mark between them."""
        special = BETWEEN.encode()
        together = b" ".join(words)
        odd = lambda w: self.mark is None or special in w or b"<|" in w or END in w
        if odd(together):
            alone = [w for w in words if odd(w)]
            skip = set(alone)
            words = [w for w in words if w not in skip]
            for word, ids in zip(alone, self._encode([w.decode("utf-8", "replace") for w in alone]), strict=True):
                self._add([word], ids, np.array([len(ids)]))
        rows = [words[i : i + 256] for i in range(0, len(words), 256)]
        between = b" " + special + b" "
        for row, ids in zip(rows, self._encode([between.join(r).decode("utf-8", "replace") for r in rows]), strict=True):
            at = ids == self.mark
            self._add(row, ids[~at], np.append(np.flatnonzero(at) - np.arange(len(row) - 1), len(ids) - len(row) + 1))

    def _add(self, words: list, ids: np.ndarray, ends: np.ndarray) -> None:
        """Remembers words whose ids lie one after the other and end where ``ends`` says."""
        first, base = len(self.ends) - 1, len(self.flat)
        self.index.update(zip(words, range(first, first + len(words)), strict=True))
        self.flat.frombytes(ids.astype(np.uint32).tobytes())
        self.ends.frombytes((ends + base).astype(np.int64).tobytes())

    def encode(self, texts: list[bytes], end: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, each followed by ``end`` if given; where each starts."""
        if len(self.index) > REMEMBERED:
            self._trim()
        if END not in self.index or end != self.end:
            self._reset()
            self.end = end
            tail = [] if end is None else [end]
            self._add([END], np.array(tail, dtype=np.uint32), np.array([len(tail)]))
        if any(END in t for t in texts):
            # a text with the end word in it is one word
            words = [w for t in texts for w in [*([t + b" "] if END in t else _spaced(t).split()), END]]
        else:
            words = _spaced((b" " + END + b" ").join([*texts, b""])).split()
        places = list(map(self.index.get, words))
        if None in places:
            new = [i for i, p in enumerate(places) if p is None]
            self._learn(list({words[i] for i in new}))
            for i in new:
                places[i] = self.index[words[i]]
        at = np.fromiter(places, dtype=np.int64, count=len(words))
        used = np.bincount(at, minlength=len(self.index))
        used[: len(self.uses)] += self.uses
        self.uses = used
        flat = np.frombuffer(self.flat, dtype=np.uint32) if len(self.flat) else np.zeros(0, np.uint32)
        ends = np.frombuffer(self.ends, dtype=np.int64)
        begin = ends[at]
        size = ends[at + 1] - begin
        done = np.zeros(len(at) + 1, dtype=np.int64)
        np.cumsum(size, out=done[1:])
        source = np.repeat(begin - done[:-1], size)
        source += np.arange(len(source))
        return flat[source], np.concatenate(([0], done[np.flatnonzero(at == self.index[END]) + 1]))


def _spaced(text: bytes) -> bytes:
    """``text`` in lower case, with a space before each lone comma or stop that ends a word.

    Neither changes the ids of vocabularies that lower-case and that part letters from
    punctuation.  Texts with a special token's brackets stay as they are.
    """
    if b"<|" in text:
        return text
    a = np.frombuffer(text.lower(), dtype=np.uint8)
    at = np.flatnonzero((a[1:-1] == 0x2C) | (a[1:-1] == 0x2E)) + 1
    before, after = a[at - 1], a[at + 1]
    at = at[(before >= 0x61) & (before <= 0x7A) & ((after == 0x20) | (after == 0x0A))]
    return np.insert(a, at, 0x20).tobytes() if len(at) else a.tobytes()


def word_tokens(vocabulary: str) -> WordTokens:
    """This process's tokenizer for a vocabulary file."""
    if vocabulary not in _loaded:
        _loaded[vocabulary] = WordTokens(vocabulary)
    return _loaded[vocabulary]


@keeps("packing", "training_order")
def forget() -> None:
    """Drops this process's tokenizers, whose room later tasks of the same worker need."""
    _loaded.clear()
