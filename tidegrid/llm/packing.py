"""Packing token sequences by bounded-space online best-fit.

Each packer keeps a fixed number of open bins.  A bitset has a bit for each amount of
free space that some open bin has; the least set bit from the piece's length up is the best fit.
When no open bin fits, a new one opens; if that is one too many, the fullest closes first.

Documents are tokenized where they lie.  Only those longer than a bin are cut, into whole bins
and a rest.  Pieces are dealt to packers by a hash; each packer takes its share
from the longest down.  A null or empty text has the end id only.  Repeated rows are packed
each; a null id stays null.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, text_bytes, tidy_after
from .textbytes import chunks
from .wordtokens import word_tokens

#: Open bins of a packer.
OPEN_BINS = 8192
#: Pieces for one packer, about.
PIECES_PER_PACKER = 50_000


class BestFit:
    """Bounded-space best-fit: bins of ``size``, at most ``open_bins`` of them open."""

    def __init__(self, size: int, open_bins: int = OPEN_BINS) -> None:
        self.size, self.limit = size, open_bins
        self.bits = 0
        self.by_free: list[list[int]] = [[] for _ in range(size + 1)]
        self.open = 0
        self.made = 0

    def _take(self, free: int) -> int:
        stack = self.by_free[free]
        number = stack.pop()
        if not stack:
            self.bits ^= 1 << free
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """Bin and offset for a piece."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.size, self.made
            self.made += 1
            if self.open >= self.limit and length < self.size:
                self._take((self.bits & -self.bits).bit_length() - 1)
        left = free - length
        if left:
            if not self.by_free[left]:
                self.bits |= 1 << left
            self.by_free[left].append(number)
            self.open += 1
        return number, self.size - free


_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])


def _tokenize(vocabulary: str, size: int, end: int, with_ids: bool):
    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(vocabulary)
        for batch in batches:
            docs, texts = batch.column(0).to_pylist(), batch.column(1)
            lengths = np.asarray(pa.compute.binary_length(texts))
            for lo, hi in chunks(lengths):
                ids, starts = tokens.encode(texts.slice(lo, hi - lo).to_pylist(), end)
                raw = memoryview(ids.astype("<u4").tobytes())
                out: list[tuple] = []
                for doc, a, b in zip(docs[lo:hi], starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                    for piece, at in enumerate(range(a, b, size)):
                        stop = min(at + size, b)
                        part = raw[4 * at : 4 * stop]
                        out.append((doc, piece, at - a, stop - at, zlib.crc32(part), bytes(part) if with_ids else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True), _PIECES, strict=True)], schema=_PIECES)
        tokens.rest()

    return run


def _pack(size: int, open_bins: int):
    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit = BestFit(size, open_bins)
        for batch in batches:
            first = batch.column(batch.schema.get_field_index("packer"))[0].as_py() << 33 if batch.num_rows else 0
            placed = [fit.place(n) for n in batch.column(batch.schema.get_field_index("length")).to_pylist()]
            number = np.fromiter((p[0] for p in placed), dtype=np.int64, count=len(placed)) + first
            offset = np.fromiter((p[1] for p in placed), dtype=np.int64, count=len(placed))
            kept = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != "packer"]
            names = [n for n in batch.schema.names if n != "packer"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(number), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    return run


def pack_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", size: int = 2048, end: int = 0, open_bins: int = OPEN_BINS, with_ids: bool = False) -> DataFrame:
    """One row per piece: where it comes from, its CRC-32, and its sequence and place there.

    With ``with_ids`` also the piece's ids, as little-endian unsigned 32-bit integers.
    """
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"))
    fields = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
    pieces = plain.mapInArrow(_tokenize(vocabulary, size, end, with_ids), fields)
    pieces = saved(pieces if with_ids else pieces.drop("ids"), "pieces")
    # by row, as ids may be null or repeated
    packers = max(1, -(-pieces.count() // PIECES_PER_PACKER))
    names = pieces.columns
    dealt = pieces.repartition(packers, F.xxhash64("doc_id", "piece", F.monotonically_increasing_id())).withColumn("packer", F.spark_partition_id().cast("long"))
    dealt = dealt.sortWithinPartitions(F.desc("length"), "doc_id", "piece")
    schema = ", ".join(f"{n} {pieces.schema[n].dataType.simpleString()}" for n in names)
    return dealt.mapInArrow(_pack(size, open_bins), f"{schema}, sequence_id long, offset long")
