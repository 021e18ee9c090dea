"""Array stores: fixtures are put together here from the formats' public descriptions, not by the library's own writer."""

from __future__ import annotations

import json
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from tidegrid.sources import arrays, codecs


def container(raw, width, how="lz4_raw", block=1 << 12, bits=False, shuffled=True, split=True):
    """A filtered, compressed container; blocks may be split in a stream for each byte of an element."""
    number = {"lz4_raw": 1, "snappy": 2, "zlib": 3, "zstd": 4}[how]
    pack = {"zlib": zlib.compress, "zstd": zstandard.ZstdCompressor().compress}.get(how) or (lambda x: pa.Codec(how).compress(x).to_pybytes())
    body, starts = b"", []
    count = -(-len(raw) // block)
    for i in range(count):
        part = raw[i * block : (i + 1) * block]
        n = len(part) // width
        if bits and len(part) >= width:
            m = n // 8 * 8
            planes = []
            for byte in range(width):
                for bit in range(8):
                    planes.append(bytes(sum(((part[(8 * g + k) * width + byte] >> bit) & 1) << k for k in range(8)) for g in range(m // 8)))
            part = b"".join(planes) + part[m * width :]
        elif shuffled and width > 1:
            part = b"".join(part[b : n * width : width] for b in range(width)) + part[n * width :]
        streams = width if split and len(part) == block and width <= 16 and block // width >= 128 else 1
        starts.append(16 + 4 * count + len(body))
        for k in range(streams):
            own = part[k * len(part) // streams : (k + 1) * len(part) // streams]
            packed = pack(own)
            packed = packed if len(packed) < len(own) else own
            body += len(packed).to_bytes(4, "little") + packed
    flags = (4 if bits else 1 if shuffled else 0) | (0 if split else 16) | number << 5
    head = bytes([2, 1, flags, width]) + len(raw).to_bytes(4, "little") + block.to_bytes(4, "little") + (16 + 4 * count + len(body)).to_bytes(4, "little")
    return head + b"".join(s.to_bytes(4, "little") for s in starts) + body


def bytes_like(rng, n):
    return bytes(rng.choice([0, 0, 0, 1, rng.randrange(256)]) for _ in range(n))


def test_containers_of_every_kind_decode():
    rng = random.Random(1)
    for how in ("lz4_raw", "snappy", "zlib", "zstd"):
        for width in (1, 2, 4, 8):
            for n in (1, 7, 64, 4096, 10_000):
                raw = bytes_like(rng, n)
                for options in ({}, {"split": False}, {"bits": True}, {"shuffled": False}):
                    assert codecs.unblosc(container(raw, width, how, **options)) == raw
    raw = bytes(range(200))
    assert codecs.unblosc(bytes([2, 1, 2, 1]) + (200).to_bytes(4, "little") * 2 + (216).to_bytes(4, "little") + raw) == raw
    for width in (1, 4, 8):
        for n in (0, 1, 4, 4000, 700_000):
            raw = bytes_like(rng, min(n, 4000)) * max(1, n // 4000)
            assert codecs.unblosc(codecs.blosc(raw, width)) == raw
    with pytest.raises(ValueError):
        codecs.unblosc(bytes([2, 1, 1, 4]) + bytes(12))
    assert codecs.crc32c(b"123456789") == 0xE3069283


def store(path, data, height, width, version, name, keys="default", fill=0, absent=(), big=False):
    """A store with one file for each chunk, but those of ``absent``."""
    kind = data.dtype.newbyteorder(">" if big else "<")
    path.mkdir()
    if version == 2:
        made = {"blosc": {"id": "blosc", "cname": "lz4", "clevel": 5, "shuffle": 1, "blocksize": 0}, "zlib": {"id": "zlib", "level": 1}, "lz4": {"id": "lz4", "acceleration": 1}, None: None}[name]
        meta = {"zarr_format": 2, "shape": list(data.shape), "chunks": [height, width], "dtype": kind.str, "compressor": made, "fill_value": fill, "order": "C", "filters": None}
        (path / ".zarray").write_text(json.dumps(meta))
    else:
        steps = [{"name": "bytes", "configuration": {"endian": "big" if big else "little"}}] + ([{"name": name, "configuration": {}}] if name else [])
        meta = {"zarr_format": 3, "node_type": "array", "shape": list(data.shape), "data_type": data.dtype.name, "chunk_grid": {"name": "regular", "configuration": {"chunk_shape": [height, width]}}}
        meta |= {"chunk_key_encoding": {"name": keys}, "fill_value": fill, "codecs": steps, "attributes": {}}
        (path / "zarr.json").write_text(json.dumps(meta))
    pack = {"blosc": lambda x: container(x, kind.itemsize), "zlib": zlib.compress, "zstd": zstandard.ZstdCompressor().compress, "lz4": lambda x: len(x).to_bytes(4, "little") + pa.Codec("lz4_raw").compress(x).to_pybytes(), None: lambda x: x}[name]
    for i in range(-(-data.shape[0] // height)):
        for j in range(-(-data.shape[1] // width)):
            if (i, j) in absent:
                continue
            block = np.full((height, width), 0, kind)
            part = data[i * height : (i + 1) * height, j * width : (j + 1) * width]
            block[: part.shape[0], : part.shape[1]] = part
            file = path / (f"{i}.{j}" if version == 2 or keys == "v2" else f"c/{i}/{j}")
            file.parent.mkdir(parents=True, exist_ok=True)
            file.write_bytes(pack(block.tobytes()))


def rows_of(df):
    return [(r["store_index"], r["data"]) for r in df.orderBy("store_index").collect()]


@pytest.mark.parametrize(("version", "name", "options"), [(2, "blosc", {}), (2, "zlib", {}), (2, "lz4", {}), (2, None, {"big": True}), (3, "zstd", {}), (3, "blosc", {"keys": "v2"}), (3, None, {"big": True})])
def test_stores_of_both_formats(spark, tmp_path, version, name, options):
    data = np.arange(66, dtype="f4").reshape(11, 6) % 17
    store(tmp_path / "z", data, 4, 4, version, name, **options)
    assert rows_of(arrays.read_array(spark, str(tmp_path / "z"))) == list(enumerate(data.tolist()))
    assert rows_of(arrays.read_array(spark, str(tmp_path / "z"), 3, 9)) == [(i, data[i].tolist()) for i in range(3, 9)]
    assert rows_of(arrays.read_array(spark, str(tmp_path / "z"), 11)) == []
    df = arrays.read_array(spark, str(tmp_path / "z"))
    assert df.rdd.getNumPartitions() == 3 and arrays.read_array(spark, str(tmp_path / "z"), 5, 7).rdd.getNumPartitions() == 1


def test_absent_chunks_hold_the_fill_value(spark, tmp_path):
    data = np.arange(8, dtype="u1").reshape(4, 2)
    store(tmp_path / "a", data, 2, 2, 2, "zlib", fill=7, absent={(0, 0)})
    assert rows_of(arrays.read_array(spark, str(tmp_path / "a"))) == [(0, [7, 7]), (1, [7, 7]), (2, [4, 5]), (3, [6, 7])]
    store(tmp_path / "b", data.astype("f4"), 2, 2, 3, "zstd", fill="NaN", absent={(1, 0)})
    assert np.isnan(rows_of(arrays.read_array(spark, str(tmp_path / "b")))[3][1]).all()
    store(tmp_path / "c", data, 2, 2, 2, None, fill=None, absent={(1, 0)})
    assert rows_of(arrays.read_array(spark, str(tmp_path / "c")))[2:] == [(2, [0, 0]), (3, [0, 0])]


@pytest.mark.parametrize("place", ["start", "end"])
def test_shards_are_read_chunk_by_chunk(spark, tmp_path, place):
    data = np.arange(40, dtype="f4").reshape(10, 4)
    z = tmp_path / "z"
    index_codecs = [{"name": "bytes", "configuration": {"endian": "little"}}, {"name": "crc32c"}]
    inner = {"chunk_shape": [2, 4], "codecs": [{"name": "bytes", "configuration": {"endian": "little"}}, {"name": "zstd"}], "index_codecs": index_codecs, "index_location": place}
    (z / "c" / "0").mkdir(parents=True)
    (z / "c" / "1").mkdir()
    meta = {"zarr_format": 3, "node_type": "array", "shape": [10, 4], "data_type": "float32", "chunk_grid": {"name": "regular", "configuration": {"chunk_shape": [6, 4]}}, "chunk_key_encoding": {"name": "default"}, "fill_value": -1, "codecs": [{"name": "sharding_indexed", "configuration": inner}]}
    (z / "zarr.json").write_text(json.dumps(meta))
    for shard in range(2):
        body, index = b"", []
        at = 3 * 16 + 4 if place == "start" else 0
        for k in range(3):
            part = data[shard * 6 + 2 * k : shard * 6 + 2 * k + 2]
            if len(part) < 2 or (shard, k) == (0, 1):
                index += [2**64 - 1] * 2
                continue
            packed = zstandard.ZstdCompressor().compress(part.tobytes())
            index += [at + len(body), len(packed)]
            body += packed
        raw = np.array(index, dtype="<u8").tobytes()
        raw += codecs.crc32c(raw).to_bytes(4, "little")
        (z / "c" / str(shard) / "0").write_bytes(raw + body if place == "start" else body + raw)
    want = data.copy()
    want[2:4] = -1
    assert rows_of(arrays.read_array(spark, str(z))) == list(enumerate(want.tolist()))
    with pytest.raises(ValueError):
        arrays.append(spark.createDataFrame([(0, [0.0] * 4)], "n long, data array<float>"), str(z))


@pytest.mark.parametrize(("version", "compressor"), [(2, "blosc"), (2, "zlib"), (2, None), (3, "zstd"), (3, "blosc"), (3, "gzip")])
def test_appends_equal_one_write(spark, tmp_path, version, compressor):
    data = (np.arange(46, dtype="f4").reshape(23, 2) % 9).tolist()
    frame = lambda lo, hi: spark.createDataFrame([(i - lo, data[i]) for i in range(lo, hi)], "n long, data array<float>").orderBy(F.rand(3))
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    assert arrays.write_array(frame(0, 23), one, 2, order="n", height=4, format=version, compressor=compressor) == 23
    arrays.create(many, 2, height=4, format=version, compressor=compressor)
    for lo, hi in ((0, 3), (3, 3), (3, 4), (4, 13), (13, 23)):
        assert arrays.append(frame(lo, hi), many, "float32") == hi - lo
    assert rows_of(arrays.read_array(spark, many)) == rows_of(arrays.read_array(spark, one)) == list(enumerate(data))
    files = lambda p: {f.relative_to(p).as_posix(): f.read_bytes() for f in p.rglob("*") if f.is_file() and not f.name.endswith(".crc")}
    assert files(tmp_path / "one") == files(tmp_path / "many")


def test_failed_appends_leave_the_length(spark, tmp_path):
    path = str(tmp_path / "z")
    rows = lambda *v: spark.createDataFrame(list(v), "n long, data array<float>")
    arrays.write_array(rows((0, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [5.0, 6.0])), path, 2, order="n", height=2)
    before = rows_of(arrays.read_array(spark, path))
    for bad in (rows((0, [1.0])), rows((0, None)), rows((0, [0.0] * 2), (2, [0.0] * 2)), rows((0, [0.0] * 2), (0, [0.0] * 2)), rows((1, [0.0] * 2))):
        with pytest.raises(Exception):  # noqa: B017
            arrays.append(bad, path)
        assert arrays.describe(path).shape == (3, 2) and rows_of(arrays.read_array(spark, path)) == before
    with pytest.raises(ValueError):
        arrays.append(rows((0, [0.0, 0.0])), path, "uint8")

    def fail(batches):
        for i, batch in enumerate(batches):
            yield batch
        raise RuntimeError

    many = spark.range(50).select(F.col("id").alias("n"), F.array(F.lit(0.0), F.lit(0.0)).cast("array<float>").alias("data"))
    broken = many.mapInArrow(lambda b: (yield from (1 / 0 for _ in b)), many.schema)
    with pytest.raises(Exception):  # noqa: B017
        arrays.append(broken, path)
    assert arrays.describe(path).shape == (3, 2) and rows_of(arrays.read_array(spark, path)) == before
    with pytest.raises(FileExistsError):
        arrays.create(path, 2)


def test_truncation(spark, tmp_path):
    path = str(tmp_path / "z")
    rows = spark.createDataFrame([(i, [float(i + 1)]) for i in range(10)], "n long, data array<float>")
    arrays.write_array(rows, path, 1, order="n", height=4)
    arrays.truncate(spark, path, 5)
    assert [d for _, d in rows_of(arrays.read_array(spark, path))] == [[1], [2], [3], [4], [5]]
    assert not (tmp_path / "z" / "2.0").exists()
    arrays.resize(path, 8)  # what was cut does not come back
    assert [d for _, d in rows_of(arrays.read_array(spark, path))][5:] == [[0]] * 3
    arrays.truncate(spark, path, 5)
    assert arrays.append(rows.limit(2).select(F.col("n"), "data"), path) == 2 and len(rows_of(arrays.read_array(spark, path))) == 7
    arrays.truncate(spark, path, 0)
    assert rows_of(arrays.read_array(spark, path)) == []
    with pytest.raises(ValueError):
        arrays.truncate(spark, path, 1)
