"""Decoding and encoding of array chunks: the codecs that chunked array stores name in their metadata."""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa

# The container's header and flags, and its inner formats by number.
HEADER, SHUFFLED, STORED, BIT_SHUFFLED, ONE_STREAM = 16, 0x01, 0x02, 0x04, 0x10
FORMATS = {1: "lz4_raw", 2: "snappy", 3: "zlib", 4: "zstd"}
#: Streams of a block are one for each byte of an element, up to so many, if each has so many bytes.
MOST_STREAMS, LEAST_STREAM = 16, 128


def _zstd(raw: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompressobj().decompress(raw)


def _inner(kind: str, raw: bytes, size: int) -> bytes:
    if kind == "zlib":
        return zlib.decompress(raw)
    if kind == "zstd":
        return _zstd(raw)
    return pa.Codec(kind).decompress(raw, size).to_pybytes()


def unshuffle(raw: bytes, width: int) -> bytes:
    """From all first bytes, all second bytes and so on to elements of ``width`` bytes; a rest is as it was."""
    n = len(raw) // width
    a = np.frombuffer(raw, dtype=np.uint8, count=n * width).reshape(width, n)
    return a.T.tobytes() + raw[n * width :]


def shuffle(raw: bytes, width: int) -> bytes:
    n = len(raw) // width
    a = np.frombuffer(raw, dtype=np.uint8, count=n * width).reshape(n, width)
    return a.T.tobytes() + raw[n * width :]


def bit_unshuffle(raw: bytes, width: int) -> bytes:
    """From a row of bits for each bit of an element to elements, eight at a time; a rest is as it was."""
    n = len(raw) // width // 8 * 8
    a = np.frombuffer(raw, dtype=np.uint8, count=n * width).reshape(width * 8, n // 8)
    bits = np.unpackbits(a, axis=1, bitorder="little").reshape(width, 8, n)
    return np.packbits(bits.transpose(2, 0, 1), axis=2, bitorder="little").tobytes() + raw[n * width :]


def unblosc(raw: bytes) -> bytes:
    """The bytes of a container of filtered, compressed blocks."""
    flags, width = raw[2], raw[3]
    size, block = (int.from_bytes(raw[i : i + 4], "little") for i in (4, 8))
    if flags & STORED:
        return raw[HEADER : HEADER + size]
    kind = FORMATS.get(flags >> 5)
    if kind is None:
        raise ValueError(f"blocks of format {flags >> 5} are not supported")
    count = -(-size // block) if block else 0
    starts = np.frombuffer(raw, dtype="<i4", count=count, offset=HEADER).tolist()
    out = []
    for k, at in enumerate(starts):
        own = min(block, size - k * block)
        streams = width if not flags & ONE_STREAM and own == block and width <= MOST_STREAMS and block // width >= LEAST_STREAM else 1
        parts = []
        for _ in range(streams):
            n, at = int.from_bytes(raw[at : at + 4], "little"), at + 4
            part = raw[at : at + n]
            parts.append(part if n == own // streams else _inner(kind, part, own // streams))
            at += n
        data = b"".join(parts)
        if flags & SHUFFLED and width > 1:
            data = unshuffle(data, width)
        elif flags & BIT_SHUFFLED and own >= width:
            data = bit_unshuffle(data, width)
        out.append(data)
    return b"".join(out)


def blosc(raw: bytes, width: int, block: int = 1 << 18) -> bytes:
    """Such a container: bytes of elements apart, each block one LZ4 stream."""
    block = max(width, min(block, len(raw)) // width * width) if raw else 1
    bodies, starts = [], []
    at = HEADER + 4 * -(-len(raw) // block)
    for i in range(0, len(raw), block):
        data = raw[i : i + block]
        data = shuffle(data, width) if width > 1 else data
        packed = pa.Codec("lz4_raw").compress(data).to_pybytes()
        packed = packed if len(packed) < len(data) else data
        starts.append(at)
        bodies.append(len(packed).to_bytes(4, "little") + packed)
        at += 4 + len(packed)
    flags = (SHUFFLED if width > 1 else 0) | ONE_STREAM | 1 << 5
    head = bytes([2, 1, flags, width]) + b"".join(n.to_bytes(4, "little") for n in (len(raw), block, at))
    return head + b"".join(n.to_bytes(4, "little") for n in starts) + b"".join(bodies)


def _lz4(raw: bytes) -> bytes:
    """A block after its size, of four bytes."""
    return pa.Codec("lz4_raw").decompress(raw[4:], int.from_bytes(raw[:4], "little")).to_pybytes()


DECODERS: dict[str, Callable[[bytes], bytes]] = {"zlib": zlib.decompress, "gzip": gzip.decompress, "zstd": _zstd, "blosc": unblosc, "lz4": _lz4}


def decode(name: str, raw: bytes) -> bytes:
    if name not in DECODERS:
        raise ValueError(f"compressor {name} is not supported")
    return DECODERS[name](raw)


def encode(name: str | None, raw: bytes, width: int) -> bytes:
    if name is None:
        return raw
    if name == "zlib":
        return zlib.compress(raw, 1)
    if name == "gzip":
        return gzip.compress(raw, 5, mtime=0)
    if name == "zstd":
        import zstandard

        return zstandard.ZstdCompressor().compress(raw)
    if name == "blosc":
        return blosc(raw, width)
    raise ValueError(f"compressor {name} is not supported")


def crc32c(raw: bytes) -> int:
    """The Castagnoli checksum, of short inputs such as indices."""
    table = _castagnoli()
    value = 0xFFFFFFFF
    for b in raw:
        value = table[(value ^ b) & 0xFF] ^ value >> 8
    return value ^ 0xFFFFFFFF


def _castagnoli(known: list[int] = []) -> list[int]:  # noqa: B006 the table is made once
    if not known:
        for b in range(256):
            for _ in range(8):
                b = b >> 1 ^ (0x82F63B78 if b & 1 else 0)
            known.append(b)
    return known
