from __future__ import annotations

import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.fixtures import pairs, raw, table
from tidegrid.llm import suffix_dedup
from tidegrid.llm.induced import Store, suffix_order


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40), st.integers(1, 9), st.sampled_from([1, 200, 1 << 20]))
def test_order_and_shared_prefixes(text, cap, memory):
    store = Store(memory)
    order, shared = suffix_order(np.array(text, dtype=np.int64), cap, store)
    assert (store.files > 0) == (memory < 1 << 20 and 1 < len(text)) or memory == 200 or len(text) < 2
    want = sorted(range(len(text)), key=lambda i: text[i:])
    assert order.tolist() == want
    for a, b, n in zip(want, want[1:], shared[1:].tolist(), strict=False):
        same = 0
        while same < cap and a + same < len(text) and b + same < len(text) and text[a + same] == text[b + same]:
            same += 1
        assert n == same


def brute(rows, length=100):
    seen, out = set(), {}
    for doc, text in sorted(set((d, t) for d, t in rows if d is not None), key=lambda r: r[0]):
        data = raw(text)
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[doc] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_equals_brute_force(spark):
    df = table(spark)
    rows = pairs(df)
    want = brute(rows)
    found = suffix_dedup.removal_report(df).collect()
    assert len(found) == sum(d is not None for d, _ in rows)
    assert all(tuple(r)[1:] == want[r["doc_id"]] for r in found)


def test_blocks_and_pieces_change_nothing(spark, monkeypatch):
    df = table(spark)
    want = sorted(map(tuple, suffix_dedup.removal_report(df).collect()))
    monkeypatch.setattr(suffix_dedup, "BLOCK", 500)
    monkeypatch.setattr(suffix_dedup, "PORTION", 300)
    monkeypatch.setattr(suffix_dedup.induced, "MEMORY", 2000)
    assert sorted(map(tuple, suffix_dedup.removal_report(df).collect())) == want
    for hint in (16, 1):  # crowds told late, and beforehand
        monkeypatch.setattr(suffix_dedup, "CROWD", 2)
        monkeypatch.setattr(suffix_dedup, "HINT", hint)
        assert sorted(map(tuple, suffix_dedup.removal_report(df).collect())) == want


def test_shards_larger_than_memory_use_files():
    """Blocks many times the memory limit give the ranges that blocks in memory give."""
    rng = np.random.default_rng(5)
    common = rng.integers(97, 103, size=4000, dtype=np.uint8)
    pieces, key, doc, at = [], [], [], []
    for i in range(3000):
        a, n = int(rng.integers(0, 3800)), int(rng.integers(100, 160))
        piece = common[a : a + n].copy()
        if i % 3 == 0:
            piece[rng.integers(0, len(piece))] = 120
        pieces.append(piece.tobytes())
        key.append(i // 30)
        doc.append(i % 700)
        at.append(1000 * (i // 700))
    part = {"key": np.array(key), "doc": np.array(doc), "at": np.array(at), "size": np.array([len(x) for x in pieces])}
    whole = np.frombuffer(b"".join(pieces), dtype=np.uint8)

    def ranges(memory):
        store = Store(memory)
        found = [np.stack(x) for x in suffix_dedup._sort_block(part, whole, 100, store)]
        files = store.files
        store.close()
        covered = {(int(d), int(p)) for x in found for d, a, n in x.T for p in range(a, a + n)}
        return covered, files

    want, none = ranges(1 << 30)
    got, files = ranges(40_000)
    assert len(whole) > 9 * 40_000 and none == 0 and files >= 5 and want and got == want
    seen, brute_force = set(), set()
    for k, d, a, piece in sorted(zip(key, doc, at, pieces, strict=True), key=lambda r: r[1:3]):
        for i in range(len(piece) - 99):
            if (piece[i : i + 100]) in seen:
                brute_force |= {(d, a + p) for p in range(i, i + 100)}
        seen |= {piece[i : i + 100] for i in range(len(piece) - 99)}
    assert want == brute_force
    spool = suffix_dedup.Spool(10)
    for x in pieces[:9]:
        spool.add(x)
    assert spool.buffer().tobytes() == b"".join(pieces[:9])
    spool.close()


def test_ids_with_several_texts(spark):
    rng = np.random.default_rng(3)
    a, b, c = ("".join(map(chr, rng.integers(97, 122, size=400))) for _ in range(3))
    rows = [(3, a), (5, a), (5, b), (5, b), (6, b + c), (6, c), (None, a), (7, None), (7, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in suffix_dedup.removal_report(df).collect())
    sixes = sorted([n for d, _, n in got if d == 6])
    assert [x for x in got if x[0] != 6] == [(3, 400, 0), (5, 400, 0), (5, 400, 0), (5, 400, 400), (7, 0, 0), (7, 5, 0)]
    # of the two texts of 6, b goes, and c from the later one
    assert sixes in ([0, 800], [400, 400])
    kept = sorted((r["doc_id"], len(r["text"])) for r in suffix_dedup.remove_repeats(df).where("text is not null and doc_id <> 6").collect())
    assert kept == [(3, 400), (5, 0), (5, 400), (5, 400), (7, 5)]
    assert suffix_dedup.remove_repeats(df).where("doc_id is null").collect() == [(None, a)]


def test_texts_stay_valid_and_columns_stay(spark):
    df = table(spark)
    out = suffix_dedup.remove_repeats(df)
    assert out.schema == df.where("doc_id is not null").schema or out.columns == df.columns
    by_id = {r["doc_id"]: r["text"] for r in out.collect()}
    source = dict(pairs(df))
    assert by_id.keys() == source.keys()
    assert all((by_id[d] is None) == (source[d] is None) for d in source)
    assert all("�" not in (t or "") for t in by_id.values())


def test_empty_table(spark):
    assert suffix_dedup.removal_report(table(spark, [])).collect() == []
    assert suffix_dedup.remove_repeats(table(spark, [])).collect() == []
