"""Byte-level BPE ids of whole texts, and back; long texts are encoded in parts that are joined exactly.

Short texts are encoded whole, where they are read.  A long text is cut into leaves that are dealt over all tasks:

* where a boundary between pre-tokens is certain, leaves need no joining.  Matches of the splitting pattern look
  forward only and never run from a visible character into white space, so a cut before white space is safe;
* a stretch that is unsplit for longer than a leaf is halved again and again.  Its leaves are
  encoded in parallel and joined in pairs, level by level.  Around a join the last tokens of the left half and the first of the
  right are encoded anew, in a window that grows until its first token is the left half's and its last the
  right half's own, or until it has taken in that half.

Why the join is exact: a sequence of tokens is the BPE of its bytes if each two neighbours are the BPE
of theirs.  Neighbours outside of the window are as they were in their half, those inside it are new, and
at its edges the token that both sides agree on keeps its old neighbour.

Defined results: a null text is empty and has no tokens; rows with a null id, repeated ids and repeated rows each
have a row of their own; other columns are ignored.
"""

from __future__ import annotations

import codecs
import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, keeps, saved, tidy_after

#: Characters of a text that is cut into leaves, from this many on, and of a leaf, about.
LONG, LEAF = 1 << 16, 1 << 14
#: Tokens on each side of a join that are encoded anew at first.
WINDOW = 8

# Fixed value: the splitting pattern of byte-level vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_SPLIT = regex.compile(PATTERN)
_SAFE = regex.compile(r"[0-9A-Za-z](?=[ \n])")
#: From here on there are characters that Unicode versions class differently.
_LATER = regex.compile("[԰-\U0010ffff]")
_loaded: dict[str, ByteBpe] = {}


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Visible characters of Latin-1 stand for themselves, other bytes for U+0100 and what follows, in order.
    """
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, other = [], 0x100
    for b in range(256):
        out.append(chr(b if b in visible else other))
        other += b not in visible
    return out


class ByteBpe:
    """A vocabulary: ids of texts, bytes of ids, and exact joins."""

    def __init__(self, vocabulary: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tiktoken import Encoding
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.to_char = byte_characters()
        to_byte = {c: b for b, c in enumerate(self.to_char)}
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size(with_added_tokens=True))]
        self.table = [bytes(to_byte[c] for c in n) if all(c in to_byte for c in n) else n.encode() for n in names]
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.parts = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._known: dict[str, bool] = {}
        # each token but the special ones is the rank of its bytes
        self.ranks = Encoding("tree", pat_str=PATTERN, mergeable_ranks={x: i for i, x in enumerate(self.table) if i not in self.special.values()}, special_tokens={})

    def _assigned(self, text: str) -> bool:
        """Whether all versions of Unicode class the characters alike: none is unassigned in an older one."""
        import unicodedata

        known = self._known
        for c in set(text):
            if c not in known:
                known[c] = unicodedata.category(c) != "Cn"
            if not known[c]:
                return False
        return True

    def split(self, text: str) -> list[str]:
        """The pre-tokens, in order; special tokens are pre-tokens of their own."""
        if self.parts is not None and any(s in text for s in self.special):
            return [w for i, part in enumerate(self.parts.split(text)) for w in ([part] if i % 2 else self._plain(part))]
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if _LATER.search(text) and not self._assigned(text):
            return [text[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]
        return _SPLIT.findall(text)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text; strings of special tokens are those tokens."""
        if self.parts is None or not any(s in text for s in self.special):
            return np.array(self.ranks.encode_ordinary(text), dtype=np.uint32)
        out = [[self.special[part]] if i % 2 else self.ranks.encode_ordinary(part) for i, part in enumerate(self.parts.split(text))]
        return np.array([x for part in out for x in part], dtype=np.uint32)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.table.__getitem__, ids.tolist()))

    def unsplit(self, raw: bytes) -> np.ndarray:
        """Ids of bytes within one pre-token."""
        chars = "".join(map(self.to_char.__getitem__, raw))
        return np.array([t.id for t in self.tokenizer.model.tokenize(chars)], dtype=np.uint32)

    def join(self, left: np.ndarray, right: np.ndarray, window: int = WINDOW) -> np.ndarray:
        """Ids of the bytes of ``left`` and ``right`` together, two parts of one pre-token."""
        if not len(left) or not len(right):
            return left if len(left) else right
        a, b = min(window, len(left)), min(window, len(right))
        while True:
            new = self.unsplit(self.decode(left[len(left) - a :]) + self.decode(right[:b]))
            begins = a == len(left) or new[0] == left[len(left) - a]
            ends = b == len(right) or new[-1] == right[b - 1]
            if begins and ends:
                return np.concatenate((left[: len(left) - a], new, right[b:]))
            a, b = a if begins else min(2 * a, len(left)), b if ends else min(2 * b, len(right))


def byte_bpe(vocabulary: str) -> ByteBpe:
    """This process's vocabulary of a file."""
    if vocabulary not in _loaded:
        _loaded[vocabulary] = ByteBpe(vocabulary)
    return _loaded[vocabulary]


@keeps("bpe_tree")
def forget() -> None:
    """Drops this process's vocabularies."""
    _loaded.clear()


def leaves(bpe: ByteBpe, text: str, leaf: int = LEAF) -> Iterator[tuple[str, int]]:
    """The text in order, in leaves: each with its number in a stretch that is unsplit, 0 if it starts anew."""
    at = 0
    while at < len(text):
        safe = _SAFE.search(text, at + leaf - 1, at + 2 * leaf) if at + leaf < len(text) else None
        if at + 2 * leaf >= len(text) and safe is None and len(text) - at <= leaf:
            yield text[at:], 0
            return
        if safe is not None:
            yield text[at : safe.end()], 0
            at = safe.end()
            continue
        # no safe cut near: whole pre-tokens up to the next one
        until = _SAFE.search(text, at + leaf - 1)
        stop = until.end() if until else len(text)
        held = ""
        for word in bpe.split(text[at:stop]):
            if held and len(held) + len(word) > leaf:
                yield held, 0
                held = ""
            if len(word) <= leaf or word in bpe.special:
                held += word
                continue
            for part, i in enumerate(range(0, len(word), leaf)):
                yield word[i : i + leaf], part
        if held:
            yield held, 0
        at = stop


_FIRST = pa.schema([("row", pa.int64()), ("chain", pa.int64()), ("part", pa.int64()), ("leaf", pa.string()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
_FIRST_SQL = "row long, chain long, part long, leaf string, doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_NODES = pa.schema([("row", pa.int64()), ("chain", pa.int64()), ("part", pa.int64()), ("ids", pa.binary())])
_NODES_SQL = "row long, chain long, part long, ids binary"


def _le(ids: np.ndarray) -> bytes:
    return ids.astype("<u4").tobytes()


def _digest(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def _first(vocabulary: str, long: int, leaf: int):
    """Results of short texts, and leaves of long ones."""

    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        bpe, row = byte_bpe(vocabulary), TaskContext.get().partitionId() << 40
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            out = []
            for i, text in zip(ids, texts, strict=True):
                if not text or len(text) < long:
                    t = bpe.encode(text)
                    out.append((None, None, None, None, i, len(t), _digest(_le(t)), _digest(bpe.decode(t).decode("utf-8", "replace").encode())))
                    continue
                row += 1
                chain = 0
                for k, (piece, part) in enumerate(leaves(bpe, text, leaf)):
                    chain = k if part == 0 else chain
                    out.append((row, chain, part, piece, i, None, None, None))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True), _FIRST, strict=True)], schema=_FIRST)

    return run


def _encoded(vocabulary: str):
    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(vocabulary)
        for batch in batches:
            for i, text in enumerate(batch.column(3).to_pylist()):
                one = batch.slice(i, 1)
                yield pa.RecordBatch.from_arrays([*one.columns[:3], pa.array([_le(bpe.encode(text))], type=pa.binary())], schema=_NODES)

    return run


def _joined(vocabulary: str):
    """Of rows sorted by row, chain and part, each even part joined with the odd one after it."""

    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, held = byte_bpe(vocabulary), None
        for row, chain, part, raw in ((*c,) for b in batches for c in zip(*(x.to_pylist() for x in b.columns), strict=True)):
            ids = np.frombuffer(raw, dtype="<u4")
            if held is not None and held[:2] == (row, chain) and part == held[2] + 1 and part % 2:
                ids, part = bpe.join(held[3], ids), held[2]
                held = None
            if held is not None:
                yield _node(*held)
            held = row, chain, part, ids
        if held is not None:
            yield _node(*held)

    return run


def _node(row: int, chain: int, part: int, ids: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x], type=f.type) for x, f in zip((row, chain, part >> 1, _le(ids)), _NODES, strict=True)], schema=_NODES)


def _whole(vocabulary: str):
    """Of rows sorted by row and chain, the results of each text, node by node."""

    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, held, at = byte_bpe(vocabulary), None, None
        schema = pa.schema([("row", pa.int64()), *[_FIRST.field(n) for n in ("n_tokens", "ids_sha256", "decoded_sha256")]])

        def end():
            text.update(reader.decode(b"", final=True).encode())
            return pa.RecordBatch.from_arrays([pa.array([x], type=f.type) for x, f in zip((at, n, held.hexdigest(), text.hexdigest()), schema, strict=True)], schema=schema)

        for batch in batches:
            for row, raw in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if row != at:
                    if held is not None:
                        yield end()
                    at, n, held, text, reader = row, 0, hashlib.sha256(), hashlib.sha256(), codecs.getincrementaldecoder("utf-8")("replace")
                n += len(raw) // 4
                held.update(raw)
                text.update(reader.decode(bpe.decode(np.frombuffer(raw, dtype="<u4"))).encode())
        if held is not None:
            yield end()

    return run


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", long: int = LONG, leaf: int = LEAF) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256 (of little-endian unsigned 32-bit ids) and decoded_sha256 (of the decoded text)."""
    parts = fold(docs.sparkSession)
    plain = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    first = saved(plain.mapInArrow(_first(vocabulary, long, leaf), _FIRST_SQL), "encoded")
    result = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    short = first.where("row is null").select(*result)
    most = first.where("row is not null").agg(F.max("part")).first()[0]
    if most is None:
        return short
    cut = first.where("row is not null").select("row", "chain", "part", "leaf")
    nodes = saved(cut.repartition(parts, "row", "chain", "part").mapInArrow(_encoded(vocabulary), _NODES_SQL), "leaves")
    # a stretch's leaves have numbers from 0 on; a lone leaf has 0
    chains = nodes.where("part > 0").select("row", "chain").distinct()
    done, open_ = nodes.join(chains, ["row", "chain"], "left_anti").select(*_NODES.names), nodes.join(chains, ["row", "chain"], "left_semi").select(*_NODES.names)
    while most > 0:
        dealt = open_.repartition(parts, F.col("row"), F.col("chain"), F.shiftright("part", 1)).sortWithinPartitions("row", "chain", "part")
        open_ = saved(dealt.mapInArrow(_joined(vocabulary), _NODES_SQL), "joined")
        most >>= 1
    nodes = done.unionByName(open_).select("row", "chain", "ids")
    whole = nodes.repartition(parts, "row").sortWithinPartitions("row", "chain").mapInArrow(_whole(vocabulary), "row long, n_tokens long, ids_sha256 string, decoded_sha256 string")
    ids = first.where("chain = 0 and part = 0").select("row", "doc_id")
    return short.unionByName(whole.join(ids, "row").select(*result))


def decode_ids(tokens: DataFrame, vocabulary: str, ids_col: str = "ids") -> DataFrame:
    """``tokens`` with a column ``text``, decoded from the array of ids in ``ids_col``; null ids have a null text."""
    from pyspark.sql.pandas.functions import pandas_udf

    @pandas_udf("string")
    def text(ids):
        bpe = byte_bpe(vocabulary)
        return ids.map(lambda x: None if x is None else bpe.decode(np.asarray(x, dtype=np.int64)).decode("utf-8", "replace"))

    return tokens.withColumn("text", text(F.col(ids_col)))
