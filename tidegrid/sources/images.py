"""Image files: a listing that opens none, headers by ranged reads, and the pixels of 8-bit PNGs."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .arrays import _open

# Fixed values of the formats: signatures, frame headers' markers, and channels by colour type.
PNG, JPEG = bytes.fromhex("89504E470D0A1A0A"), bytes.fromhex("FFD8")
FRAMES = {0xC0, 0xC1, 0xC2, 0xC3, 0xC5, 0xC6, 0xC7, 0xC9, 0xCA, 0xCB, 0xCD, 0xCE, 0xCF}
ALONE = {0x01, *range(0xD0, 0xD8)}
CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def list_images(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """``path`` and ``length`` of the files under a folder that have any bytes; none of them is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return files.select("path", "length")


def header(read: Callable[[int, int], bytes]) -> tuple[str | None, int | None, int | None, bool | None]:
    """Format, width, height and whether pixels are 8-bit red, green, blue; ``read`` gives bytes by offset and length."""
    start = read(0, 26)
    if start[:8] == PNG and len(start) == 26:
        return "png", int.from_bytes(start[16:20], "big"), int.from_bytes(start[20:24], "big"), start[24:26] == bytes([8, 2])
    at = 2 if start[:2] == JPEG else None
    while at is not None:
        part = read(at, 10)
        if len(part) < 4 or part[0] != 0xFF:
            break
        if part[1] == 0xFF:  # filling
            at += 1
        elif part[1] in ALONE:
            at += 2
        elif part[1] in FRAMES:
            if len(part) < 10:
                break
            return "jpeg", int.from_bytes(part[7:9], "big"), int.from_bytes(part[5:7], "big"), part[4] == 8 and part[9] == 3
        else:
            at += 2 + int.from_bytes(part[2:4], "big")
    return None, None, None, None


_PROBED = pa.schema([("path", pa.string()), ("format", pa.string()), ("width", pa.int64()), ("height", pa.int64()), ("rgb8", pa.bool_()), ("bytes_read", pa.int64())])


def probe_images(paths: DataFrame, column: str = "path") -> DataFrame:
    """Of each path: format, width, height, ``rgb8`` and how many bytes were read; nulls for a file that is no image or is absent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                found, used = (None,) * 4, 0
                if path is not None:
                    store, place = _open(path)
                    if store.get_file_info(place).is_file:
                        with store.open_input_file(place) as stream:
                            taken = []

                            def read(at: int, n: int, stream=stream, taken=taken) -> bytes:
                                stream.seek(at)
                                part = stream.read(n)
                                taken.append(len(part))
                                return part

                            found = header(read)
                            used = sum(taken)
                rows.append((path, *found, used))
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows, strict=True), _PROBED, strict=True)] if rows else [pa.array([], type=f.type) for f in _PROBED], schema=_PROBED)

    return paths.select(column).mapInArrow(run, "path string, format string, width long, height long, rgb8 boolean, bytes_read long")


def _unfiltered(kinds: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Pixels (height, width, bytes) from rows whose bytes are told as differences to their neighbours.

    The last two kinds of difference look left and up, so pixels are made along diagonals, all rows at once.
    """
    height, width, size = rows.shape
    out = np.zeros((height + 1, width + 1, size), dtype=np.int16)
    if not (kinds > 2).any():
        for y in range(height):
            row = rows[y].astype(np.int64)
            row = np.cumsum(row, axis=0) if kinds[y] == 1 else row + out[y, 1:] if kinds[y] == 2 else row
            out[y + 1, 1:] = row & 255
        return out[1:, 1:].astype(np.uint8)
    for d in range(height + width - 1):
        y = np.arange(max(0, d - width + 1), min(height, d + 1))
        x = d - y
        left, up, corner = out[y + 1, x], out[y, x + 1], out[y, x]
        kind = kinds[y][:, None]
        slope = left + up - corner
        a, b, c = np.abs(slope - left), np.abs(slope - up), np.abs(slope - corner)
        nearest = np.where((a <= b) & (a <= c), left, np.where(b <= c, up, corner))
        guess = np.select([kind == 1, kind == 2, kind == 3, kind == 4], [left, up, (left + up) >> 1, nearest], 0)
        out[y + 1, x + 1] = (rows[y, x] + guess) & 255
    return out[1:, 1:].astype(np.uint8)


def decode_png(raw: bytes) -> np.ndarray:
    """Red, green and blue (height, width, 3) of a PNG of 8 bits a channel: grey is spread, transparency dropped.

    A file that is damaged, interlaced or of another depth is an error.
    """
    if raw[:8] != PNG:
        raise ValueError("not a PNG")
    at, packed, colours, head = 8, [], None, None
    while at + 12 <= len(raw):
        n, name = int.from_bytes(raw[at : at + 4], "big"), raw[at + 4 : at + 8]
        body = raw[at + 8 : at + 8 + n]
        if len(body) < n or zlib.crc32(name + body) != int.from_bytes(raw[at + 8 + n : at + 12 + n], "big"):
            raise ValueError(f"part {name!r} is damaged")
        at += 12 + n
        if name == b"IHDR":
            head = body
        elif name == b"PLTE":
            colours = np.frombuffer(body, dtype=np.uint8).reshape(-1, 3)
        elif name == b"IDAT":
            packed.append(body)
        elif name == b"IEND":
            break
    else:
        raise ValueError("the end is missing")
    if head is None:
        raise ValueError("no header")
    width, height = (int.from_bytes(head[i : i + 4], "big") for i in (0, 4))
    depth, kind, interlaced = head[8], head[9], head[12]
    if depth != 8 or interlaced or kind not in CHANNELS:
        raise ValueError(f"depth {depth}, colour type {kind}, interlace {interlaced} are not supported")
    size = CHANNELS[kind]
    lines = np.frombuffer(zlib.decompress(b"".join(packed)), dtype=np.uint8)
    if len(lines) != height * (1 + width * size):
        raise ValueError("the pixels are not as many as the header says")
    lines = lines.reshape(height, 1 + width * size)
    pixels = _unfiltered(lines[:, 0].astype(np.int64), lines[:, 1:].reshape(height, width, size))
    if kind == 3:
        if colours is None or int(pixels.max(initial=0)) >= len(colours):
            raise ValueError("a colour is missing")
        return colours[pixels[:, :, 0]]
    return np.repeat(pixels[:, :, :1], 3, axis=2) if kind in (0, 4) else pixels[:, :, :3]


_PIXELS = pa.schema([("path", pa.string()), ("height", pa.int64()), ("width", pa.int64()), ("rgb", pa.binary()), ("problem", pa.string())])


def read_pixels(paths: DataFrame, column: str = "path") -> DataFrame:
    """Of each path: height, width and ``rgb`` bytes, or ``problem`` where it cannot be read.  One image at a time is in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                try:
                    if path is None:
                        raise ValueError("no path")
                    store, place = _open(path)
                    with store.open_input_stream(place, compression=None) as stream:
                        pixels = decode_png(stream.read())
                    row = (path, *pixels.shape[:2], pixels.tobytes(), None)
                except (OSError, ValueError, zlib.error) as e:
                    row = (path, None, None, None, str(e)[:200] or type(e).__name__)
                yield pa.RecordBatch.from_arrays([pa.array([x], type=f.type) for x, f in zip(row, _PIXELS, strict=True)], schema=_PIXELS)

    return paths.select(column).mapInArrow(run, "path string, height long, width long, rgb binary, problem string")


__all__ = ["decode_png", "header", "list_images", "probe_images", "read_pixels"]
