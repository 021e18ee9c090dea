from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard

from tests.llm.fixtures import pairs, raw, table
from tidegrid.llm import training_order


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_permutation(n):
    order = training_order.Permutation(n, 99)
    slots = order.slots(np.arange(n))
    assert sorted(slots.tolist()) == list(range(n))
    assert (order.numbers(slots) == np.arange(n)).all()
    if n > 500:
        assert (training_order.Permutation(n, 98).slots(np.arange(n)) != slots).any()


@pytest.mark.parametrize("shard", [32_768, 50])
def test_round_trip_and_resumption(spark, tmp_path, shard):
    df = table(spark).repartition(3, "doc_id")
    df.write.parquet(str(tmp_path / "docs"))
    df = spark.read.parquet(str(tmp_path / "docs"))
    manifest = training_order.write_shards(df, str(tmp_path / "out"), key=3, length=64, shard=shard)
    rows = training_order.read_shards(manifest, length=64).collect()
    assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    assert all(r["shard"] == r["slot"] // shard and r["file_offset"] == r["slot"] % shard * 80 for r in rows)
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == r["length"] for r in rows)
    want = Counter()
    for d, t in pairs(df):
        data = raw(t) + b"\0"
        want.update((d, i // 64, data[i : i + 64]) for i in range(0, len(data), 64))
    assert Counter((r["doc_id"], r["piece"], bytes(r["ids"])) for r in rows) == want
    later = training_order.read_shards(manifest, length=64, from_slot=70).collect()
    assert sorted(later) == sorted(r for r in rows if r["slot"] >= 70)


def test_order_is_spread():
    slots = training_order.Permutation(10_000, 1).slots(np.arange(10_000))
    near = defaultdict(int)
    for s in slots[:1000]:
        near[s // 1000] += 1
    assert len(near) == 10 and max(near.values()) < 150


def test_unfilled_shards_are_errors(tmp_path):
    import pyarrow as pa

    class Task:
        taskAttemptId = staticmethod(lambda: 0)

    write = training_order._write(str(tmp_path), 3, 4, 10)
    row = np.zeros(20, np.uint8).tobytes()
    bundle = zstandard.compress(np.array([0], "<i8").tobytes() + row)
    batch = pa.RecordBatch.from_arrays([pa.array([0]), pa.array([1]), pa.array([bundle])], names=["shard", "n", "bundle"])
    with pytest.raises(ValueError, match="not filled"):
        list(write(iter([batch])))


def test_empty_table(spark):
    assert training_order.order_report(table(spark, [])).collect() == []


def test_token_ids(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    width = training_order.id_width(vocabulary)
    assert width == 2
    df = table(spark).repartition(3, "doc_id")
    training_order.token_ids(df, vocabulary).write.parquet(str(tmp_path / "ids"))
    ids = spark.read.parquet(str(tmp_path / "ids"))
    manifest = training_order.write_shards(ids, str(tmp_path / "out"), key=3, length=64, shard=50, end=7, ids_col="ids", width=width)
    rows = training_order.read_shards(manifest, length=64, width=width).collect()
    assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    assert all(r["file_offset"] == r["slot"] % 50 * (16 + 128) for r in rows)
    plain = Tokenizer.from_file(vocabulary)
    want = Counter()
    for d, t in pairs(df):
        data = [*plain.encode(t or "", add_special_tokens=False).ids, 7]
        want.update((d, i // 64, tuple(data[i : i + 64])) for i in range(0, len(data), 64))
    got = Counter((r["doc_id"], r["piece"], tuple(np.frombuffer(bytes(r["ids"]), "<u2").tolist())) for r in rows)
    assert got == want and max(i for _, _, p in got for i in p) > 255


def test_ids_of_a_column(spark, tmp_path):
    wide = np.array([70_000, 0, 4_000_000_000], dtype="<u4").tobytes()
    spark.createDataFrame([(1, wide), (2, None), (-1, b""), (None, wide), (0, b"")], "doc_id long, ids binary").write.parquet(str(tmp_path / "ids"))
    ids = spark.read.parquet(str(tmp_path / "ids"))
    manifest = training_order.write_shards(ids, str(tmp_path / "out"), length=8, end=65_536, ids_col="ids", width=4)
    got = {r["doc_id"]: np.frombuffer(bytes(r["ids"]), "<u4").tolist() for r in training_order.read_shards(manifest, length=8, width=4).collect()}
    assert got == {1: [70_000, 0, 4_000_000_000, 65_536], 2: [65_536], -1: [65_536], None: [70_000, 0, 4_000_000_000, 65_536], 0: [65_536]}


def test_each_task_writes_a_range_of_slots(spark, tmp_path):
    df = spark.range(3000).selectExpr("id AS doc_id", "repeat('x', int(id % 90)) AS text")
    df.write.parquet(str(tmp_path / "docs"))
    manifest = training_order.write_shards(spark.read.parquet(str(tmp_path / "docs")), str(tmp_path / "out"), length=16, shard=100).collect()
    by_task = defaultdict(list)
    for r in manifest:
        by_task[r["path"].rsplit("-", 1)[1]].append(r["shard"])
    runs = sorted(sorted(s) for s in by_task.values())
    assert len(runs) == 4 and [s for run in runs for s in run] == list(range(len(manifest)))
