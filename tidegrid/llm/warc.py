"""Web archives with revisits resolved: written deduplicated, and read back.

Payload headers (id, digest, size) are shuffled by digest to find the record that keeps a
payload; its copies are joined to it and written as revisits without payload.  Records
are written by the tasks that hold the pages, each task to files of its own attempt; only the
files that a finished task reports are in the manifest, so a lost executor
leaves at most files that nothing refers to.

Rows without id are left out.  A null payload is empty.  A null address becomes
``urn:page:<id>``.  Of equal payloads the largest id keeps it; rows that repeat that id with that
payload are responses too.  An id that comes with several payloads has a record for each.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, fresh_path, saved, small_side, text_bytes, tidy_after

#: Compressed bytes after which a task starts another archive.
ROLL = 32 << 20
#: Payloads shorter than this are never deduplicated.
LEAST_PAYLOAD = 1000
_NAMESPACE = uuid.UUID("6f1f3e2c-3a57-4c9a-9a43-0d6f0f3c7f11")


def _store(path: str):
    """File system and path in it, of a path that may be a URI."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def record_id(page: int, digest: str) -> str:
    """Of a page's id and payload, as an id may come with several payloads."""
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page}:{digest}')}>"


def _address(url: str | None, page: int) -> str:
    if not url:
        return f"urn:page:{page}"
    return "".join(c if "\x20" < c != "\x7f" else f"%{ord(c):02X}" for c in url)


def record(page: int, url: str | None, payload: bytes, digest: str, refers_to: int | None, refers_url: str | None, date: str) -> bytes:
    """One archive record: a response with its payload, or a revisit without."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    named = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": record_id(page, digest),
        "WARC-Date": date,
        "WARC-Target-URI": _address(url, page),
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
        "WARC-Block-Digest": "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode(),
        "X-Page-ID": str(page),
    }
    if refers_to is not None:
        named |= {
            "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            "WARC-Refers-To": record_id(refers_to, digest),
            "WARC-Refers-To-Target-URI": _address(refers_url, refers_to),
            "WARC-Refers-To-Date": date,
            "WARC-Truncated": "length",
        }
    named |= {"Content-Type": "application/http;msgtype=response", "Content-Length": str(len(block))}
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in named.items()) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _write(folder: str, date: str):
    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        task = TaskContext.get()
        name = f"{base}/part-{task.partitionId():06d}-{task.taskAttemptId()}"
        out, size, records, made, done = None, 0, 0, 0, []
        for batch in batches:
            at = {n: i for i, n in enumerate(batch.schema.names)}
            rows = zip(*(batch.column(at[c]).to_pylist() for c in ("page", "url", "digest", "refers_to", "refers_url")), batch.column(at["payload"]), strict=True)
            for page, url, digest, refers_to, refers_url, payload in rows:
                if out is None:
                    path = f"{name}-{made:04d}.warc.gz"
                    out, size, records, made = store.open_output_stream(path, compression=None), 0, 0, made + 1
                packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                member = packer.compress(record(page, url, payload.as_py(), digest, refers_to, refers_url, date)) + packer.flush()
                out.write(member)
                size, records = size + len(member), records + 1
                if size >= ROLL:
                    out.close()
                    out = None
                    done.append((path, records, size))
        if out is not None:
            out.close()
            done.append((path, records, size))
        names = ["path", "records", "bytes"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.string(), pa.int64(), pa.int64()), strict=True)] if done else [pa.array([], t) for t in (pa.string(), pa.int64(), pa.int64())], names=names)

    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_payload: int = LEAST_PAYLOAD, date: str | None = None) -> DataFrame:
    """Writes archives to ``folder``; the manifest: path, records and bytes of each."""
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    plain = pages.select(F.col(id_col).cast("long").alias("page"), F.col(url_col).cast("string").alias("url"), text_bytes(payload_col).alias("payload")).where("page is not null")
    plain = plain.withColumn("digest", F.sha1("payload"))
    headers = saved(plain.select("page", "url", "digest", F.length("payload").alias("n")), "headers")
    long = headers.where(F.col("n") >= least_payload)
    kept = long.groupBy("digest", "n").agg(F.max(F.struct("page", "url")).alias("kept"), F.count("*").alias("copies")).where("copies > 1")
    kept = kept.select("digest", "n", F.col("kept.page").alias("refers_to"), F.col("kept.url").alias("refers_url"))
    # a page id may come with several payloads: each is a revisit of its own only
    own = ["page", "digest", "n"]
    revisits = long.join(small_side(saved(kept, "kept")), ["digest", "n"]).where("page <> refers_to").select(*own, "refers_to", "refers_url").distinct()
    joined = plain.withColumn("n", F.length("payload")).join(small_side(saved(revisits, "revisits")), own, "left")
    return saved(joined.mapInArrow(_write(folder, date), "path string, records long, bytes long"), "manifest")


def records(stream, limit: int = 1 << 20) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a gzip archive, member by member."""
    rest = b""
    while True:
        unpack = zlib.decompressobj(31)
        parts = []
        while not unpack.eof:
            chunk = rest or stream.read(limit)
            rest = b""
            if not chunk:
                break
            parts.append(unpack.decompress(chunk))
            rest = unpack.unused_data
        data = b"".join(parts)
        if not data:
            return
        head, _, body = data.partition(b"\r\n\r\n")
        lines = head.decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/1.") or not unpack.eof:
            raise ValueError(f"not a whole archive record: {lines[0][:40]!r}")
        named = dict(line.split(": ", 1) for line in lines[1:])
        n = int(named["Content-Length"])
        if body[n:] != b"\r\n\r\n":
            raise ValueError(f"record {named.get('WARC-Record-ID')} has a wrong length")
        yield named, body[:n]


_READ = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("url", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("refers_id", pa.string()), ("payload", pa.binary())])
_READ_SQL = "record_id string, page_id long, record_type string, url string, payload_digest string, payload_bytes long, refers_id string, payload binary"


def _read(with_payload: bool):
    @tidy_after
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, place = _store(path)
                rows, size = [], 0
                with store.open_input_stream(place, compression=None) as stream:
                    for named, block in records(stream):
                        response = named["WARC-Type"] == "response"
                        payload = block.partition(b"\r\n\r\n")[2] if response else None
                        stated = base64.b32decode(named["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                        digest = hashlib.sha1(payload).hexdigest() if response else stated
                        if digest != stated:
                            raise ValueError(f"record {named['WARC-Record-ID']} has another payload than it states")
                        rows.append((named["WARC-Record-ID"], int(named["X-Page-ID"]), named["WARC-Type"], named["WARC-Target-URI"], digest, len(payload) if response else None, named.get("WARC-Refers-To"), payload if with_payload else None))
                        size += len(payload or b"") if with_payload else 200
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _READ, strict=True)], schema=_READ)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _READ, strict=True)], schema=_READ)

    return run


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """Records of the archives in a manifest, revisits joined to their responses.

    Columns: page_id, url, payload_bytes, payload_digest, record_type, refers_to and, if asked
    for, payload.
    """
    spark = manifest.sparkSession
    paths = manifest.select("path").repartition(fold(spark))
    found = saved(paths.mapInArrow(_read(with_payload), _READ_SQL), "records")
    needed = found.where("record_type = 'revisit'").select(F.col("refers_id").alias("record_id")).distinct()
    original = found.where("record_type = 'response'").join(small_side(needed), "record_id", "left_semi")
    original = original.groupBy("record_id").agg(F.first("page_id").alias("original"), F.first("payload_bytes").alias("original_bytes"), *([F.first("payload").alias("original_payload")] if with_payload else []))
    joined = found.join(small_side(saved(original, "originals"), 2_000 if with_payload else 200_000).withColumnRenamed("record_id", "refers_id"), "refers_id", "left")
    columns = ["page_id", "url", F.coalesce("payload_bytes", "original_bytes").alias("payload_bytes"), "payload_digest", "record_type", F.col("original").alias("refers_to")]
    return joined.select(*columns, *([F.coalesce("payload", "original_payload").alias("payload")] if with_payload else []))


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` to fresh archives in the shared folder and reads them back."""
    return read_archives(write_archives(pages, fresh_path(pages.sparkSession, "archives"))).drop("url")
