"""A Spark source and sink for two-dimensional chunked array stores (zarr formats 2 and 3).

Each chunk of rows is a partition; of a shard only the index and the chunks' own bytes are read.  Rows are appended by
chunk: tasks write whole chunks beside the old ones, and the store's length in its metadata changes last, at
once, so that an append that fails leaves the store as long as it was.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from . import codecs

#: Rows of a chunk of a new store, at most.
HEIGHT = 1024
#: Where each format keeps its metadata.
FILES = {2: ".zarray", 3: "zarr.json"}
_ABSENT = (1 << 64) - 1


def _open(path: str):
    from pyarrow import fs

    if "://" in path and not path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")


def _bytes(store, path: str) -> bytes:
    with store.open_input_stream(path, compression=None) as stream:
        return stream.read()


def _put(store, path: str, raw: bytes) -> None:
    """Written beside and moved, so that readers see the old or the new bytes."""
    draft = f"{path}.{uuid.uuid4().hex}"
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with store.open_output_stream(draft) as out:
        out.write(raw)
    store.move(draft, path)


@dataclass(frozen=True)
class Layout:
    """What a store's metadata say, in either format."""

    format: int
    shape: tuple[int, int]
    chunk: tuple[int, int]
    dtype: np.dtype
    fill: object
    separator: str
    prefix: str
    codecs: tuple[dict, ...]  # from array to bytes, in order of encoding
    order: str = "C"
    shard: tuple[int, int] | None = None
    index_codecs: tuple[dict, ...] = ()
    index_first: bool = False

    def key(self, row: int, column: int) -> str:
        return f"{self.prefix}{row}{self.separator}{column}"


def _fill(value, kind: np.dtype):
    if value is None:
        return kind.type(0)
    if isinstance(value, str) and kind.kind == "f":
        return kind.type(value.replace("Infinity", "inf"))
    return kind.type(value)


def parse(meta: dict, path: str = "store") -> Layout:
    """The layout that a metadata document describes; an error if this source cannot read it."""
    if len(meta["shape"]) != 2:
        raise ValueError(f"{path}: {len(meta['shape'])} dimensions, not 2")
    shape = tuple(meta["shape"])
    if meta.get("zarr_format", 2) == 2:
        if meta.get("filters"):
            raise ValueError(f"{path}: filters are not supported")
        kind, packed = np.dtype(meta["dtype"]), meta.get("compressor")
        steps = ({"name": packed["id"], "configuration": packed},) if packed else ()
        return Layout(2, shape, tuple(meta["chunks"]), kind, _fill(meta.get("fill_value"), kind), meta.get("dimension_separator", "."), "", steps, meta.get("order", "C"))
    keys = meta.get("chunk_key_encoding", {"name": "default"})
    plain = keys["name"] == "v2"
    separator = (keys.get("configuration") or {}).get("separator", "." if plain else "/")
    grid, steps = tuple(meta["chunk_grid"]["configuration"]["chunk_shape"]), list(meta["codecs"])
    shard, index, first = None, (), False
    if steps[0]["name"] == "sharding_indexed":
        inner = steps[0]["configuration"]
        shard, grid, steps = grid, tuple(inner["chunk_shape"]), list(inner["codecs"])
        index, first = tuple(inner.get("index_codecs") or ()), inner.get("index_location", "end") == "start"
    order = "C"
    if steps[0]["name"] == "transpose":
        asked = (steps.pop(0).get("configuration") or {}).get("order")
        order = "F" if asked in ([1, 0], "F") else "C"
    if steps[0]["name"] != "bytes":
        raise ValueError(f"{path}: codec {steps[0]['name']} is not supported")
    endian = (steps.pop(0).get("configuration") or {}).get("endian", "little")
    kind = np.dtype(meta["data_type"]).newbyteorder(">" if endian == "big" else "<")
    return Layout(3, shape, grid, kind, _fill(meta.get("fill_value"), kind), separator, "" if plain else f"c{separator}", tuple(steps), order, shard, index, first)


def find_format(path: str) -> int | None:
    """The format of the store at ``path``; None if there is none."""
    store, place = _open(path.rstrip("/"))
    return next((f for f, name in FILES.items() if store.get_file_info(f"{place}/{name}").is_file), None)


def describe(path: str) -> Layout:
    """The store's own description: shape, chunks, type and so on."""
    found = find_format(path)
    if found is None:
        raise FileNotFoundError(f"{path} is not an array store")
    store, place = _open(path.rstrip("/"))
    return parse(json.loads(_bytes(store, f"{place}/{FILES[found]}")), path)


def _decoded(layout: Layout, raw: bytes) -> np.ndarray:
    for step in reversed(layout.codecs):
        # a checksum of four bytes at the end
        raw = raw[:-4] if step["name"] == "crc32c" else codecs.decode(step["name"], raw)
    return np.frombuffer(raw, dtype=layout.dtype).reshape(layout.chunk, order=layout.order)


def _encoded(layout: Layout, block: np.ndarray) -> bytes:
    raw = np.ascontiguousarray(block, dtype=layout.dtype).tobytes(order=layout.order)
    for step in layout.codecs:
        raw = codecs.encode(step["name"], raw, layout.dtype.itemsize)
    return raw


def _shard_index(layout: Layout, stream, size: int) -> np.ndarray:
    """Offset and length of each chunk of a shard."""
    count = math.prod(a // b for a, b in zip(layout.shard, layout.chunk, strict=True))
    names = [s["name"] for s in layout.index_codecs]
    if set(names) - {"bytes", "crc32c"}:
        raise ValueError(f"index codecs {names} are not supported")
    sums = 4 * names.count("crc32c")
    stream.seek(0 if layout.index_first else size - 16 * count - sums)
    raw = stream.read(16 * count + sums)
    if sums and codecs.crc32c(raw[:-4]) != int.from_bytes(raw[-4:], "little"):
        raise ValueError("a shard's index does not have its checksum")
    return np.frombuffer(raw, dtype="<u8", count=2 * count).reshape([*(a // b for a, b in zip(layout.shard, layout.chunk, strict=True)), 2])


def read_chunk(store, place: str, layout: Layout, row: int, column: int) -> np.ndarray:
    """One chunk; the fill value where there is none."""
    if layout.shard is None:
        name = f"{place}/{layout.key(row, column)}"
        if store.get_file_info(name).is_file:
            return _decoded(layout, _bytes(store, name))
        return np.full(layout.chunk, layout.fill, dtype=layout.dtype)
    down, across = (a // b for a, b in zip(layout.shard, layout.chunk, strict=True))
    info = store.get_file_info(f"{place}/{layout.key(row // down, column // across)}")
    if info.is_file:
        with store.open_input_file(info.path) as stream:
            at, n = _shard_index(layout, stream, info.size)[row % down, column % across].tolist()
            if at != _ABSENT:
                stream.seek(at)
                return _decoded(layout, stream.read(n))
    return np.full(layout.chunk, layout.fill, dtype=layout.dtype)


def read_rows(store, place: str, layout: Layout, number: int) -> np.ndarray:
    """The rows of the ``number``-th chunk row, as many as the store has."""
    (rows, dim), (height, width) = layout.shape, layout.chunk
    parts = [read_chunk(store, place, layout, number, j) for j in range(math.ceil(dim / width))]
    return np.hstack(parts)[: max(0, min(height, rows - number * height)), :dim]


class _Rows(InputPartition):
    def __init__(self, number: int) -> None:
        super().__init__(number)


class _Reader(DataSourceReader):
    def __init__(self, path: str, start: int, stop: int | None) -> None:
        self.path, self.layout = path.rstrip("/"), describe(path)
        self.start, self.stop = start, self.layout.shape[0] if stop is None else min(stop, self.layout.shape[0])

    def partitions(self):
        height = self.layout.chunk[0]
        return [_Rows(i) for i in range(self.start // height, math.ceil(self.stop / height))] if self.start < self.stop else []

    def read(self, partition):
        if partition is None or partition.value is None:
            return
        store, place = _open(self.path)
        first = partition.value * self.layout.chunk[0]
        low, high = max(self.start - first, 0), self.stop - first
        data = read_rows(store, place, self.layout, partition.value)[low:high].astype(np.float32)
        lists = pa.FixedSizeListArray.from_arrays(pa.array(data.ravel()), self.layout.shape[1]).cast(pa.list_(pa.float32()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(first + low, first + low + len(data))), lists], names=["store_index", "data"])


@dataclass
class Written(WriterCommitMessage):
    rows: int
    last: int
    chunks: tuple[int, ...]


class _Writer(DataSourceArrowWriter):
    """Appends rows that come by chunk, each chunk's rows in one task and in order."""

    def __init__(self, path: str, layout: Layout) -> None:
        self.path, self.layout = path.rstrip("/"), layout

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, place = _open(self.path)
        (old, dim), height = self.layout.shape, self.layout.chunk[0]
        block, number, rows, last, done = None, -1, 0, -1, []

        def close() -> None:
            if block is not None:
                self._put(store, place, number, block)
                done.append(number)

        for batch in iterator:
            index, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            if lists.null_count or len(lists.flatten()) != len(lists) * dim or (len(lists) and (np.diff(lists.offsets.to_numpy()) != dim).any()):
                raise ValueError(f"{self.path}: a vector does not have {dim} values")
            data = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), dim)
            for c in np.unique(index // height).tolist():
                if c != number:
                    close()
                    number, block = c, np.full((height, dim), self.layout.fill, dtype=self.layout.dtype)
                    if c * height < old:  # the edge: what the store has already stays
                        have = read_rows(store, place, self.layout, c)
                        block[: len(have)] = have
                own = index // height == c
                block[index[own] - c * height] = data[own]
            rows += len(index)
            last = max(last, int(index.max(initial=-1)))
        close()
        return Written(rows, last, tuple(done))

    def _put(self, store, place: str, number: int, block: np.ndarray) -> None:
        width = self.layout.chunk[1]
        for j in range(math.ceil(block.shape[1] / width)):
            part = np.full(self.layout.chunk, self.layout.fill, dtype=self.layout.dtype)
            own = block[:, j * width : (j + 1) * width]
            part[:, : own.shape[1]] = own
            _put(store, f"{place}/{self.layout.key(number, j)}", _encoded(self.layout, part))

    def commit(self, messages) -> None:
        rows = sum(m.rows for m in messages if m)
        last = max([self.layout.shape[0] - 1, *(m.last for m in messages if m)])
        if last + 1 != self.layout.shape[0] + rows:
            raise ValueError(f"{self.path}: rows up to {last} and {rows} new ones do not follow {self.layout.shape[0]}")
        resize(self.path, last + 1)

    def abort(self, messages) -> None:
        store, place = _open(self.path)
        beyond = math.ceil(self.layout.shape[0] / self.layout.chunk[0])
        for number in (c for m in messages if m for c in m.chunks if c >= beyond):
            for j in range(math.ceil(self.layout.shape[1] / self.layout.chunk[1])):
                name = f"{place}/{self.layout.key(number, j)}"
                if store.get_file_info(name).is_file:
                    store.delete_file(name)


class ChunkedArraySource(DataSource):
    """``spark.read.format("chunked_array").load(path)``: store_index and data; options ``start`` and ``stop``."""

    @classmethod
    def name(cls) -> str:
        return "chunked_array"

    def schema(self) -> str:
        return "store_index long, data array<float>"

    def reader(self, schema) -> DataSourceReader:
        stop = self.options.get("stop")
        return _Reader(self.options["path"], int(self.options.get("start", 0)), None if stop is None else int(stop))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("a store is created and then appended to")
        return _Writer(self.options["path"], describe(self.options["path"]))


def read_array(spark: SparkSession, path: str, start: int = 0, stop: int | None = None) -> DataFrame:
    """``store_index`` and ``data`` of the rows from ``start`` to ``stop``; other chunks are not read."""
    spark.dataSource.register(ChunkedArraySource)
    reader = spark.read.format("chunked_array").option("start", start)
    return (reader if stop is None else reader.option("stop", stop)).load(path)


def create(path: str, dim: int, dtype: str = "float32", height: int = HEIGHT, format: int = 2, compressor: str | None = "blosc") -> None:
    """An empty store; an error if there is one."""
    if find_format(path) is not None:
        raise FileExistsError(path)
    kind, height = np.dtype(dtype), max(1, height)
    if format == 2:
        # fixed values: fields and names of the format
        how = {"blosc": {"id": "blosc", "cname": "lz4", "clevel": 5, "shuffle": 1, "blocksize": 0}, "zstd": {"id": "zstd", "level": 3}, "zlib": {"id": "zlib", "level": 1}, "gzip": {"id": "gzip", "level": 5}}
        meta = {"zarr_format": 2, "shape": [0, dim], "chunks": [height, dim], "dtype": kind.str, "compressor": how[compressor] if compressor else None, "fill_value": 0, "order": "C", "filters": None}
    else:
        how = {"blosc": {"typesize": kind.itemsize, "cname": "lz4", "clevel": 5, "shuffle": "shuffle", "blocksize": 0}, "zstd": {"level": 3, "checksum": False}, "gzip": {"level": 5}}
        steps = [{"name": "bytes", "configuration": {"endian": "little"}}] + ([{"name": compressor, "configuration": how[compressor]}] if compressor else [])
        grid, keys = {"name": "regular", "configuration": {"chunk_shape": [height, dim]}}, {"name": "default", "configuration": {"separator": "/"}}
        meta = {"zarr_format": 3, "node_type": "array", "shape": [0, dim], "data_type": kind.name, "chunk_grid": grid, "chunk_key_encoding": keys, "fill_value": 0, "codecs": steps, "attributes": {}}
    store, place = _open(path.rstrip("/"))
    _put(store, f"{place}/{FILES[format]}", json.dumps(meta, indent=4).encode())


def resize(path: str, rows: int) -> None:
    """Only the length in the store's metadata, at once."""
    layout = describe(path)
    store, place = _open(path.rstrip("/"))
    name = f"{place}/{FILES[layout.format]}"
    meta = json.loads(_bytes(store, name))
    meta["shape"][0] = rows
    _put(store, name, json.dumps(meta, indent=4).encode())


def append(df: DataFrame, path: str, dtype: str | None = None, order: str = "n") -> int:
    """Appends the vectors ``data``, numbered from 0 without gaps by ``order``; the number of rows.

    A vector of another size than the store's, another ``dtype``, or numbers with gaps or repeats are an error, and
    the store keeps its length.  Chunks are dealt to tasks whole, so no two tasks write one file.
    """
    spark, layout = df.sparkSession, describe(path)
    if layout.shard is not None:
        raise ValueError(f"{path}: shards are read only")
    if dtype is not None and np.dtype(dtype) != layout.dtype:
        raise ValueError(f"{path} has type {layout.dtype}, not {np.dtype(dtype)}")
    spark.dataSource.register(ChunkedArraySource)
    told = df.agg(F.count("*").alias("rows"), F.min(order).alias("a"), F.max(order).alias("z"), F.count_distinct(order).alias("d")).first()
    if told["rows"] == 0:
        return 0
    if (told["a"], told["z"], told["d"]) != (0, told["rows"] - 1, told["rows"]):
        raise ValueError(f"{told['rows']} rows have {told['d']} numbers from {told['a']} to {told['z']}")
    old, height = layout.shape[0], layout.chunk[0]
    placed = df.select((F.col(order).cast("long") + old).alias("store_index"), F.col("data").cast("array<double>" if layout.dtype.itemsize == 8 else "array<float>").alias("data"))
    chunk = F.floor(F.col("store_index") / height)
    placed.repartition(chunk).sortWithinPartitions("store_index").write.format("chunked_array").mode("append").save(path)
    return told["rows"]


def write_array(df: DataFrame, path: str, dim: int, dtype: str = "float32", order: str = "store_index", height: int = HEIGHT, format: int = 2, compressor: str | None = "blosc") -> int:
    """A new store of the vectors ``data`` in the order of their numbers, which start at 0; the number of rows."""
    create(path, dim, dtype, height, format, compressor)
    return append(df, path, dtype, order)


def truncate(spark: SparkSession, path: str, rows: int) -> None:
    """Keeps the first ``rows``.  The length changes first; then the chunks beyond go, and the edge beyond it is filled.

    A store that has fewer rows is an error.
    """
    layout = describe(path)
    if layout.shape[0] < rows or rows < 0:
        raise ValueError(f"{path} has {layout.shape[0]} rows, not {rows}")
    if layout.shard is not None:
        raise ValueError(f"{path}: shards are read only")
    (old, dim), (height, width) = layout.shape, layout.chunk
    resize(path, rows)
    across = math.ceil(dim / width)

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = _open(path.rstrip("/"))
        for batch in batches:
            for number in batch.column(0).to_pylist():
                for j in range(across):
                    name = f"{place}/{layout.key(number, j)}"
                    if store.get_file_info(name).is_file:
                        store.delete_file(name)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    first, end = math.ceil(rows / height), math.ceil(old / height)
    if first < end:
        spark.range(first, end).mapInArrow(remove, "n long").agg(F.sum("n")).collect()
    if rows % height:
        store, place = _open(path.rstrip("/"))
        edge = np.full((height, dim), layout.fill, dtype=layout.dtype)
        have = read_rows(store, place, describe(path), rows // height)
        edge[: len(have)] = have
        _Writer(path, layout)._put(store, place, rows // height, edge)


__all__ = ["ChunkedArraySource", "Layout", "append", "create", "describe", "find_format", "parse", "read_array", "resize", "truncate", "write_array"]
