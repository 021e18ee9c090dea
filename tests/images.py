"""PNGs put together from plain arrays, each row with a filter of its own."""

from __future__ import annotations

import zlib

import numpy as np

SIGNATURE = bytes.fromhex("89504E470D0A1A0A")


def part(name, body):
    return len(body).to_bytes(4, "big") + name + body + zlib.crc32(name + body).to_bytes(4, "big")


def png(pixels, kind=2, filters=(0,), colours=None, depth=8, interlaced=0, pieces=1):
    """``pixels`` (height, width, bytes a pixel); filters are taken in turn."""
    height, width, size = pixels.shape
    a = pixels.astype(int)
    raw = b""
    for y in range(height):
        f, out = filters[y % len(filters)], []
        for x in range(width):
            for k in range(size):
                left = a[y, x - 1, k] if x else 0
                up = a[y - 1, x, k] if y else 0
                corner = a[y - 1, x - 1, k] if x and y else 0
                best = min((left, up, corner), key=lambda v: abs(left + up - corner - v))
                out.append((a[y, x, k] - (0, left, up, (left + up) // 2, best)[f]) % 256)
        raw += bytes([f, *out])
    packed = zlib.compress(raw)
    step = -(-len(packed) // pieces)
    head = width.to_bytes(4, "big") + height.to_bytes(4, "big") + bytes([depth, kind, 0, 0, interlaced])
    palette = part(b"PLTE", np.asarray(colours, dtype=np.uint8).tobytes()) if colours is not None else b""
    return SIGNATURE + part(b"IHDR", head) + palette + b"".join(part(b"IDAT", packed[i : i + step]) for i in range(0, len(packed), step)) + part(b"IEND", b"")


PLAIN = png(np.arange(72, dtype=np.uint8).reshape(4, 6, 3))
