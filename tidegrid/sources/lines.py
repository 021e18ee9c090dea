"""A Spark source of the lines of text files of any size, with their numbers.

Files are cut into ranges of bytes; a line belongs to the range that it starts in.  A first pass counts the lines of each
range, where nothing but the counts leaves the tasks; sums over them give each range the number of its first
line, and a second pass reads.  No task holds more than a block and a line.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .arrays import _open

#: Bytes of a range, and ranges in all beyond which they grow.
SPLIT, MOST_RANGES = 32 << 20, 10_000
#: Bytes that are read at a time, and lines that are handed on.
BLOCK, LINES = 1 << 20, 10_000


def files_of(path: str) -> list[tuple[str, int]]:
    """Files with their sizes: one, or all of a folder in the order of their paths, but for hidden ones."""
    from pyarrow import fs

    store, place = _open(path.rstrip("/"))
    info = store.get_file_info(place)
    if info.is_file:
        return [(path, info.size)]
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    base = path.rstrip("/")
    found = store.get_file_info(fs.FileSelector(place, recursive=True))
    hidden = lambda p: any(part.startswith((".", "_")) for part in p[len(place) :].split("/"))
    return sorted((base + f.path[len(place) :], f.size) for f in found if f.is_file and not hidden(f.path))


def ranges_of(path: str, split: int | None = None) -> list[tuple[str, int, int, int]]:
    """(file, from, to, size) of every range."""
    files = files_of(path)
    split = max(split or SPLIT, -(-sum(n for _, n in files) // MOST_RANGES))
    return [(f, at, min(at + split, n), n) for f, n in files for at in range(0, n, split)]


def count_lines(store, place: str, start: int, stop: int, size: int) -> int:
    """Lines that start in a range: after each line end but the file's last byte, and at the file's beginning."""
    total, at, end = int(start == 0 and size > 0), max(start - 1, 0), min(stop, size) - 1
    with store.open_input_file(place) as stream:
        stream.seek(at)
        while at < end:
            block = stream.read(min(BLOCK, end - at))
            if not block:
                break
            total += block.count(b"\n")
            at += len(block)
    return total


def read_lines(store, place: str, start: int, stop: int) -> Iterator[bytes]:
    """Lines that start in a range, without their ends."""
    with store.open_input_file(place) as stream:
        at = max(start - 1, 0)
        stream.seek(at)
        held, skip = b"", start > 0  # up to the first line end from the byte before the range on
        while True:
            block = stream.read(BLOCK)
            if skip:
                cut = block.find(b"\n")
                if cut < 0:
                    if not block:
                        return
                    at += len(block)
                    continue
                block, at, skip = block[cut + 1 :], at + cut + 1, False
                if not block:
                    continue
            if not block:
                break
            *whole, held_next = (held + block).split(b"\n")
            for line in whole:
                if at >= stop:
                    return
                yield line
                at += len(line) + 1
            held = held_next
            if at >= stop:
                return
        if held and at < stop:
            yield held


class _Range(InputPartition):
    def __init__(self, number: int) -> None:
        super().__init__(number)


class _Reader(DataSourceReader):
    def __init__(self, ranges: list, counting: bool) -> None:
        self.ranges, self.counting = ranges, counting

    def partitions(self):
        return [_Range(i) for i in range(len(self.ranges))]

    def read(self, partition):
        if partition is None or partition.value is None:
            return
        file, start, stop, size, line, place = self.ranges[partition.value]
        store, name = _open(file)
        if self.counting:
            n = count_lines(store, name, start, stop, size)
            yield pa.RecordBatch.from_arrays([pa.array([partition.value]), pa.array([n])], names=["range", "lines"])
            return
        held: list[str] = []

        def batch() -> pa.RecordBatch:
            n = len(held)
            return pa.RecordBatch.from_arrays([pa.array([file] * n), pa.array(range(line - n, line)), pa.array(range(place - n, place)), pa.array(held, type=pa.string())], names=["file", "line", "place", "text"])

        size = 0
        for text in read_lines(store, name, start, stop):
            held.append(text.decode("utf-8", "replace"))
            line, place, size = line + 1, place + 1, size + len(text)
            if len(held) >= LINES or size >= BLOCK:
                yield batch()
                held, size = [], 0
        if held:
            yield batch()


class LineSource(DataSource):
    """``numbered_lines``: file, line and place of each line, and its text; see ``read_numbered``."""

    @classmethod
    def name(cls) -> str:
        return "numbered_lines"

    def schema(self) -> str:
        return "range long, lines long" if self.options.get("count") == "true" else "file string, line long, place long, text string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(json.loads(self.options["ranges"]), self.options.get("count") == "true")


def read_numbered(spark: SparkSession, path: str, split: int | None = None) -> DataFrame:
    """Lines of a file or of a folder's files: ``file``, ``line`` from 1 in it, ``place`` from 1 in all, and ``text``.

    Lines end with a line feed; a last line without one counts if it has a byte.  Undecodable bytes become U+FFFD.
    """
    spark.dataSource.register(LineSource)
    ranges = [[*r, 0, 0] for r in ranges_of(path, split)]
    told = spark.read.format("numbered_lines").option("ranges", json.dumps(ranges)).option("count", "true").load()
    counts = {r["range"]: r["lines"] for r in told.collect()}  # MOST_RANGES rows, or one for each file
    place, line, file = 1, 1, None
    for i, r in enumerate(ranges):
        line = line if r[0] == file else 1
        file = r[0]
        r[4], r[5] = line, place
        line, place = line + counts[i], place + counts[i]
    return spark.read.format("numbered_lines").option("ranges", json.dumps(ranges)).load()


__all__ = ["LineSource", "count_lines", "files_of", "ranges_of", "read_lines", "read_numbered"]
