from __future__ import annotations

import hashlib
import io

import pytest

from tests.oracle import TABLES, same
from tidegrid.llm import queries, warc

SCHEMA = "page_id long, url string, html string, digest string, page long"


def pages(spark):
    long = "é" * 600
    rows = [(i, f"http://a/{i}\n", long if i % 3 == 0 else f"text {i}") for i in range(30)]
    rows += [(40, None, None), (41, "u", ""), (42, "u", "x" * 1000), (43, "u", "x" * 1000), (44, "u", "y" * 999), (45, "u", "y" * 999), (43, "u", "x" * 1000), (None, "u", long), (50, "big", "z" * 3_000_000)]
    return spark.createDataFrame([(*r, "d", 5) for r in rows], SCHEMA), rows


def test_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ROLL", 2000)
    df, rows = pages(spark)
    manifest = warc.write_archives(df, str(tmp_path / "w"), date="2024-01-01T00:00:00Z")
    found = warc.read_archives(manifest, with_payload=True).collect()
    rows = [r for r in rows if r[0] is not None]
    assert len(found) == len(rows) == manifest.agg({"records": "sum"}).first()[0]
    last = {}
    for i, _, h in rows:
        last[h or ""] = max(i, last.get(h or "", -1))
    by_id = {r[0]: r for r in rows}
    for r in found:
        data = (by_id[r["page_id"]][2] or "").encode()
        again = len(data) >= 1000 and last[data.decode()] != r["page_id"]
        assert (r["payload_bytes"], r["payload_digest"], bytes(r["payload"])) == (len(data), hashlib.sha1(data).hexdigest(), data)
        assert (r["record_type"], r["refers_to"]) == (("revisit", last[data.decode()]) if again else ("response", None))


def test_ids_with_several_payloads(spark, tmp_path):
    a, b, c = "a" * 1200, "b" * 1300, "c" * 1200
    rows = [(5, a), (9, a), (5, b), (8, b), (9, c), (3, b), (9, "short"), (5, a)]
    df = spark.createDataFrame([(i, None, h) for i, h in rows], "page_id long, url string, html string")
    found = warc.read_archives(warc.write_archives(df, str(tmp_path / "w")), with_payload=True).collect()
    want = sorted((i, h, {(5, a): 9, (5, b): 8, (3, b): 8}.get((i, h), -1)) for i, h in rows)
    assert sorted((r["page_id"], bytes(r["payload"]).decode(), -1 if r["refers_to"] is None else r["refers_to"]) for r in found) == want


def test_equals_sql(spark):
    same(queries.op3_warc_revisits(spark, TABLES), queries.ORACLE["op3_warc_revisits"])


def test_broken_archives_are_errors():
    import gzip

    whole = gzip.compress(warc.record(1, "u", b"p", hashlib.sha1(b"p").hexdigest(), None, None, "d"))
    named, block = next(warc.records(io.BytesIO(whole)))
    assert named["X-Page-ID"] == "1" and block.endswith(b"\r\n\r\np")
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(whole[:-20])))
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(gzip.compress(b"nothing"))))


def test_empty_table(spark):
    assert warc.round_trip(pages(spark)[0].limit(0)).collect() == []
