"""Binary frames and images, as Arrow-batched functions over bytes.

A result is a struct: what was read, and ``error``, the reason where nothing could be.
"""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from .profiles import PACKED_V1, segments

# fixed value: layout of a frame's header, little-endian: magic, version, header size, session, sequence,
# frame number, start and end of capture in nanoseconds, payload size
HEADER_FORMAT = "<8sIIQQQQQQ"
HEADER_BYTES = struct.calcsize(HEADER_FORMAT)
# fixed values: channels of each encoding, and the order that makes them red, green, blue
ENCODINGS = {"bgr8": (3, (2, 1, 0)), "rgb8": (3, (0, 1, 2)), "bgra8": (4, (2, 1, 0)), "rgba8": (4, (0, 1, 2)), "mono8": (1, (0, 0, 0)), "8uc1": (1, (0, 0, 0))}


def header_parser(magic: bytes, version: int, payload: int):
    """Function of a header's bytes: session, sequence, frame, start, end, middle and error."""
    schema = "session decimal(20,0), sequence decimal(20,0), frame_idx long, start_ns long, end_ns long, mid_ns long, error string"

    def one(raw: bytes | None) -> tuple:
        nothing = (None,) * 6
        if raw is None or len(raw) < HEADER_BYTES:
            return (*nothing, "short")
        found, kind, size, session, sequence, frame, start, end, length = struct.unpack(HEADER_FORMAT, raw[:HEADER_BYTES])
        for bad, reason in ((found != magic, "magic"), (kind != version, "version"), (size != HEADER_BYTES, "header size"), (length != payload, "payload size"), (sequence % 2 == 1, "torn")):
            if bad:
                return (*nothing, reason)
        return session, sequence, frame, start, end, (start + end) // 2, None

    @pandas_udf(schema)
    def parse(raw: pd.Series) -> pd.DataFrame:
        from decimal import Decimal

        rows = [one(r) for r in raw]
        wide = [(None if r[0] is None else Decimal(r[0]), None if r[1] is None else Decimal(r[1]), *r[2:]) for r in rows]
        return pd.DataFrame(wide, columns=["session", "sequence", "frame_idx", "start_ns", "end_ns", "mid_ns", "error"]).astype({k: "Int64" for k in ("frame_idx", "start_ns", "end_ns", "mid_ns")})

    return parse


def new_frames(sequence: Column, last: Column) -> Column:
    """Whether a read is whole and newer than the last one taken."""
    return (sequence % 2 == 0) & (sequence > F.coalesce(last, F.lit(-1)))


def to_rgb8(encoding: Column, height: Column, width: Column, step: Column, data: Column) -> Column:
    """Rows of red, green and blue bytes without padding, and ``error``."""
    return _rgb8(encoding, height, width, step, data)


@pandas_udf(T.StructType([T.StructField("rgb", T.BinaryType()), T.StructField("error", T.StringType())]))
def _rgb8(encoding: pd.Series, height: pd.Series, width: pd.Series, step: pd.Series, data: pd.Series) -> pd.DataFrame:
    out = []
    for name, h, w, s, raw in zip(encoding, height, width, step, data, strict=True):
        kind = ENCODINGS.get(str(name).lower())
        if kind is None:
            out.append((None, "encoding"))
        elif not (h > 0 and w > 0):
            out.append((None, "size"))
        elif raw is None or s < w * kind[0] or len(raw) != h * s:
            out.append((None, "data"))
        else:
            grid = np.frombuffer(raw, dtype=np.uint8).reshape(int(h), int(s))[:, : int(w) * kind[0]]
            out.append((grid.reshape(int(h), int(w), kind[0])[:, :, list(kind[1])].tobytes(), None))
    return pd.DataFrame(out, columns=["rgb", "error"])


@pandas_udf(T.StructType([T.StructField("data", T.BinaryType()), T.StructField("error", T.StringType())]))
def _rows(height: pd.Series, width: pd.Series, step: pd.Series, item: pd.Series, big_endian: pd.Series, data: pd.Series) -> pd.DataFrame:
    out = []
    for h, w, s, size, big, raw in zip(height, width, step, item, big_endian, data, strict=True):
        row = int(w) * int(size)
        if not (h > 0 and w > 0):
            out.append((None, "size"))
        elif s < row:
            out.append((None, "step"))
        elif raw is None or len(raw) < h * s:
            out.append((None, "data"))
        elif big and size % 4 == 0:
            out.append((None, "big endian"))
        else:
            grid = np.frombuffer(raw, dtype=np.uint8, count=int(h) * int(s)).reshape(int(h), int(s))
            out.append((grid[:, :row].tobytes(), None))
    return pd.DataFrame(out, columns=["data", "error"])


def image_rows(height: Column, width: Column, step: Column, pixel_bytes: Column | int, big_endian: Column, data: Column) -> Column:
    """An image's bytes without row padding; floats must be little-endian."""
    return _rows(height, width, step, pixel_bytes if isinstance(pixel_bytes, Column) else F.lit(pixel_bytes), big_endian, data)


def pack(parts: dict[str, Column], shapes: dict[str, tuple[int, int, int, int]] = PACKED_V1) -> Column:
    """One frame of all segments in order; null if any is missing or has another size."""
    if set(parts) != set(shapes):
        raise ValueError(f"segments {sorted(set(parts) ^ set(shapes))} are missing or unknown")
    good = F.lit(True)
    for s in segments(shapes):
        good = good & (F.length(parts[s["segment"]]) == s["length"])
    return F.when(F.coalesce(good, F.lit(False)), F.concat(*[parts[n] for n in shapes]))


def segment(packed: Column, name: str, shapes: dict[str, tuple[int, int, int, int]] = PACKED_V1) -> Column:
    """A segment's bytes out of a packed frame."""
    s = next(s for s in segments(shapes) if s["segment"] == name)
    return F.substring(packed, s["start"] + 1, s["length"])


@pandas_udf(T.ArrayType(T.FloatType()))
def floats(raw: pd.Series) -> pd.Series:
    """Little-endian float32 values of bytes."""
    return raw.map(lambda b: None if b is None else np.frombuffer(b, dtype="<f4"))


@pandas_udf(T.StructType([T.StructField("min", T.IntegerType()), T.StructField("max", T.IntegerType()), T.StructField("mean", T.DoubleType()), T.StructField("channels", T.ArrayType(T.DoubleType()))]))
def image_summary(rgb: pd.Series) -> pd.DataFrame:
    """Least, greatest and mean byte, and each channel's mean, of red-green-blue bytes."""
    out = []
    for raw in rgb:
        a = None if not raw else np.frombuffer(raw, dtype=np.uint8).reshape(-1, 3)
        out.append((None,) * 4 if a is None else (int(a.min()), int(a.max()), float(a.mean()), a.mean(axis=0).tolist()))
    return pd.DataFrame(out, columns=["min", "max", "mean", "channels"])


@pandas_udf(T.StructType([T.StructField("mae", T.DoubleType()), T.StructField("max_abs", T.DoubleType()), T.StructField("swapped", T.BooleanType())]))
def image_difference(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """Mean and greatest difference of two images' bytes, and whether red and blue are swapped.

    They are if exchanging them lowers the mean difference by more than one.  Images of different size give nulls.
    """
    out = []
    for x, y in zip(a, b, strict=True):
        if not x or not y or len(x) != len(y):
            out.append((None, None, None))
            continue
        p, q = (np.frombuffer(v, dtype=np.uint8).reshape(-1, 3).astype(np.int16) for v in (x, y))
        d = np.abs(p - q)
        out.append((float(d.mean()), float(d.max()), bool(np.abs(p - q[:, ::-1]).mean() + 1 < d.mean())))
    return pd.DataFrame(out, columns=["mae", "max_abs", "swapped"])
