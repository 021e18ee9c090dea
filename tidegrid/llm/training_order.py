"""Token sequences laid down in a keyed pseudo-random training order.

Sequences are numbered densely, in the order of the input's partitions and rows.  A Feistel
network over an even number of bits, keyed, permutes the numbers; numbers beyond the
last sequence are permuted again until they fall below it (cycle-walking), which keeps the
permutation one of exactly the sequences' numbers.  A sequence's number becomes its
global slot.  Slots are range-partitioned into shards of equal size, and runs of shards to tasks: the
ranges follow from the number of sequences, so that no sample has to find them.  A shard is a file of
records of one stride, so that slot s lies in shard s // size at (s % size) * stride and a
reader can resume anywhere.  A record is the document's id (64 bits), the sequence's place in it
(32), its number of ids (32, of which the highest bit marks a null id), and the ids, padded with zeros;
all little-endian.  Ids have one, two
or four bytes each, the least that the vocabulary's greatest id fits.

Sequences travel to their shard in compressed bundles, one for each batch and shard.  A task
writes whole shards to files named after its attempt; the manifest names those of finished
tasks only.  A shard whose slots are not filled exactly once raises an error.

Ids are a tokenizer's, those of a column, or the text's bytes, and an end id.  Texts are tokenized
once, to a table that both the numbering and the shards read.  A null text has the end id only; a
null id stays null.  Repeated rows have sequences each.  Without rows there are no shards.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import DENSE, fold, fresh_path, saved, text_bytes, tidy_after
from .groups import key_runs
from .textbytes import chunks, mix
from .warc import _store
from .wordtokens import forget, word_tokens

#: Ids of a sequence, slots of a shard, rounds of the network.
LENGTH, SHARD, ROUNDS = 512, 32_768, 6
#: Marks a null id in a record's number of ids.
_NO_DOC = np.uint32(1 << 31)
_HEAD = np.dtype([("doc", "<i8"), ("piece", "<u4"), ("length", "<u4")])


class Permutation:
    """A keyed permutation of 0 .. n-1, and its inverse."""

    def __init__(self, n: int, key: int) -> None:
        self.n = n
        half = max(1, -(-max(n - 1, 1).bit_length() // 2))
        self.half, self.mask = np.uint64(half), np.uint64((1 << half) - 1)
        self.keys = mix(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key & ((1 << 64) - 1)))

    def _once(self, x: np.ndarray, keys: np.ndarray, back: bool) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        if back:
            left, right = right, left
        for k in keys:
            left, right = right, left ^ (mix(right + k) & self.mask)
        if back:
            left, right = right, left
        return (left << self.half) | right

    def _walk(self, x: np.ndarray, keys: np.ndarray, back: bool) -> np.ndarray:
        x = self._once(np.asarray(x, dtype=np.uint64), keys, back)
        beyond = np.flatnonzero(x >= self.n)
        while len(beyond):
            x[beyond] = self._once(x[beyond], keys, back)
            beyond = beyond[x[beyond] >= self.n]
        return x.astype(np.int64)

    def slots(self, numbers: np.ndarray) -> np.ndarray:
        return self._walk(numbers, self.keys, False)

    def numbers(self, slots: np.ndarray) -> np.ndarray:
        return self._walk(slots, self.keys[::-1], True)


def id_width(vocabulary: str) -> int:
    """Bytes that each of a vocabulary's ids needs."""
    most = max(word_tokens(vocabulary).tokenizer.get_vocab().values())
    return 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4


def token_ids(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row its id, its text's token ids, little-endian, of ``id_width`` bytes each, and their number."""
    kind = f"<u{id_width(vocabulary)}"

    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(vocabulary)
        for batch in batches:
            texts = batch.column(1)
            for lo, hi in chunks(np.asarray(pa.compute.binary_length(texts))):
                ids, starts = tokens.encode(texts.slice(lo, hi - lo).to_pylist(), None)
                ids = ids.astype(kind)
                held = [ids[a:b].tobytes() for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(held, pa.binary()), pa.array(np.diff(starts))], names=["doc_id", "ids", "n_ids"])
        tokens.rest()

    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_bytes(text_col).alias("text"))
    return plain.mapInArrow(run, "doc_id long, ids binary, n_ids long")


def _bundles(order: Permutation, first: dict[int, int], length: int, shard: int, end: int, width: int):
    kind = np.dtype(f"<u{width}")
    last = np.array([end], dtype=kind).tobytes()

    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        pack = zstandard.ZstdCompressor(level=9)
        number = first.get(TaskContext.get().partitionId(), 0)
        for batch in batches:
            docs = batch.column(0).to_pylist()
            sizes = np.asarray(pa.compute.binary_length(batch.column(1)), dtype=np.int64)
            if (sizes % width).any():
                raise ValueError(f"ids are not of {width} bytes each")
            sizes = sizes // width + 1
            lo = 0
            while lo < len(docs):
                hi = max(lo + 1, int(np.searchsorted(np.cumsum(sizes[lo:]), (16 << 20) // width)) + lo)
                texts = batch.column(1).slice(lo, hi - lo).to_pylist()
                flat = np.frombuffer(b"".join([t + last for t in texts]), dtype=kind)
                pieces = -(-sizes[lo:hi] // length)
                total = int(pieces.sum())
                owner = np.repeat(np.arange(hi - lo), pieces)
                piece = np.arange(total) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = np.repeat(np.cumsum(sizes[lo:hi]) - sizes[lo:hi], pieces) + piece * length
                held = np.minimum(length, sizes[lo:hi][owner] - piece * length)
                head = np.zeros(total, dtype=_HEAD)
                missing = np.array([d is None for d in docs[lo:hi]])[owner]
                head["doc"] = np.array([0 if d is None else d for d in docs[lo:hi]], dtype=np.int64)[owner]
                head["piece"], head["length"] = piece, held.astype(np.uint32) | missing * _NO_DOC
                body = np.zeros((total, length), dtype=kind)
                body[np.arange(length) < held[:, None]] = flat
                table = np.concatenate((head.view(np.uint8).reshape(total, -1), body.view(np.uint8)), axis=1)
                slot = order.slots(np.arange(number, number + total))
                number += total
                by = np.argsort(slot, kind="stable")
                slot, table = slot[by], table[by]
                edges = np.flatnonzero(np.diff(slot // shard, prepend=-1))
                ends = [*edges[1:].tolist(), total]
                packed = [pack.compress(slot[a:z].astype("<i8").tobytes() + table[a:z].tobytes()) for a, z in zip(edges.tolist(), ends, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(slot[edges] // shard), pa.array(np.array(ends) - edges), pa.array(packed, pa.binary())], names=["shard", "n", "bundle"])
                lo = hi

    return run


def _write(folder: str, n: int, length: int, shard: int, width: int = 1):
    stride = _HEAD.itemsize + length * width

    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        unpack = zstandard.ZstdDecompressor()
        done: list[tuple] = []
        open_shard, table, filled = -1, np.zeros((0, stride), np.uint8), np.zeros(0, np.int64)

        def close():
            if (filled != 1).any():
                raise ValueError(f"shard {open_shard}: {int((filled != 1).sum())} slots are not filled exactly once")
            path = f"{base}/shard-{open_shard:08d}-{TaskContext.get().taskAttemptId()}.bin"
            with store.open_output_stream(path) as out:
                out.write(pa.py_buffer(table))
            done.append((open_shard, path, open_shard * shard, len(table)))

        for part in key_runs(batches, "shard"):
            for number, count, bundle in zip(part["shard"].tolist(), part["n"].tolist(), part["bundle"], strict=True):
                if number != open_shard:
                    if open_shard >= 0:
                        close()
                    size = min(shard, n - number * shard)
                    open_shard, table, filled = number, np.zeros((size, stride), np.uint8), np.zeros(size, np.int64)
                raw = unpack.decompress(bundle)
                slot = np.frombuffer(raw, dtype="<i8", count=count) - number * shard
                table[slot] = np.frombuffer(raw, dtype=np.uint8, offset=8 * count).reshape(count, stride)
                np.add.at(filled, slot, 1)
        if open_shard >= 0:
            close()
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate(kinds)], names=["shard", "path", "first_slot", "slots"])

    return run


def write_shards(docs: DataFrame, folder: str, key: int = 0, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, shard: int = SHARD, end: int = 0, ids_col: str | None = None, width: int = 1, n_col: str | None = None) -> DataFrame:
    """Writes all sequences in training order; the manifest: shard, path, first_slot, slots.

    Ids are those in ``ids_col``, little-endian and of ``width`` bytes each, or else the text's bytes.
    ``n_col``, if there is one, has their number, so that numbering need not read them.
    ``docs`` must give the same partitions and rows when read again, as files do.
    """
    if width not in (1, 2, 4) or (ids_col is None and width != 1) or not 0 <= end < 1 << 8 * width:
        raise ValueError(f"width {width}, end {end}")
    plain = docs.select(F.col(id_col).cast("long").alias("doc"), text_bytes(ids_col or text_col).alias("ids"))
    n_ids = F.coalesce(F.col(n_col), F.lit(0)) if n_col else F.length(text_bytes(ids_col or text_col)) / width
    pieces = F.ceil((n_ids + 1) / length).cast("long")
    counted = docs.select(F.spark_partition_id().alias("part"), pieces.alias("n")).groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    first, n = {}, 0
    for row in counted:
        first[row["part"]] = n
        n += row["n"]
    bundles = plain.mapInArrow(_bundles(Permutation(n, key), first, length, shard, end, width), "shard long, n long, bundle binary")
    shards = max(1, -(-n // shard))
    # ranges of slots of equal size, known without the sample that a range exchange would take
    tasks = min(shards, fold(docs.sparkSession))
    dealt = bundles.repartitionById(tasks, F.floor(F.col("shard") * tasks / shards).cast("int"))
    return saved(dealt.sortWithinPartitions("shard").mapInArrow(_write(folder, n, length, shard, width), "shard long, path string, first_slot long, slots long"), "manifest")


def _read(length: int, from_slot: int, width: int):
    stride = _HEAD.itemsize + length * width

    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, path, first, slots in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                skip = min(max(from_slot - first, 0), slots)
                store, place = _store(path)
                with store.open_input_file(place) as file:
                    file.seek(skip * stride)
                    at = first + skip
                    while raw := file.read(4096 * stride):
                        table = np.frombuffer(raw, dtype=np.uint8).reshape(-1, stride)
                        head = np.ascontiguousarray(table[:, : _HEAD.itemsize]).view(_HEAD).ravel()
                        held = head["length"] & ~_NO_DOC
                        ids = [table[i, _HEAD.itemsize : _HEAD.itemsize + m * width].tobytes() for i, m in enumerate(held.tolist())]
                        slot = at + np.arange(len(table))
                        at += len(table)
                        doc = pa.array(head["doc"], mask=head["length"] >= _NO_DOC)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(slot), pa.array(np.full(len(table), shard)), pa.array((slot - first) * stride), doc, pa.array(head["piece"].astype(np.int32)), pa.array(held.astype(np.int64)), pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                            names=["slot", "shard", "file_offset", "doc_id", "piece", "length", "ids_crc32", "ids"],
                        )

    return run


def read_shards(manifest: DataFrame, length: int = LENGTH, from_slot: int = 0, width: int = 1) -> DataFrame:
    """The sequences from a slot on; each task reads its shards from front to back."""
    paths = manifest.select("shard", "path", "first_slot", "slots").where(F.col("first_slot") + F.col("slots") > from_slot)
    fields = "slot long, shard long, file_offset long, doc_id long, piece int, length long, ids_crc32 long, ids binary"
    return paths.repartitionByRange(fold(manifest.sparkSession), "shard").mapInArrow(_read(length, from_slot, width), fields)


def order_report(docs: DataFrame, key: int = 0, vocabulary: str | None = None) -> DataFrame:
    """Writes ``docs`` in training order to fresh shards and lists what was read back.

    With a vocabulary the ids are its tokens', else the texts' bytes.
    """
    folder = fresh_path(docs.sparkSession, "shards")
    if vocabulary is None:
        return read_shards(write_shards(docs, folder, key)).drop("ids")
    width = id_width(vocabulary)
    ids = saved(token_ids(docs, vocabulary), "token-ids", **DENSE)
    return read_shards(write_shards(ids, folder, key, ids_col="ids", width=width, n_col="n_ids"), width=width).drop("ids")
