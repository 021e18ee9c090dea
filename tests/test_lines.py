from __future__ import annotations

import pytest

from tidegrid.sources import lines, readers
from tidegrid.sources.arrays import _open

TEXTS = [b"", b"\n", b"a", b"a\n", b"\n\n", b"a\nbb\n\nccc", b"\nx\r\n y\n\n", "é日\nz\n".encode(), b"long" * 30 + b"\n" + b"q" * 70]


def plain(raw):
    return raw.split(b"\n")[:-1] if raw.endswith(b"\n") else raw.split(b"\n") if raw else []


@pytest.mark.parametrize("block", [1, 3, 1 << 20])
def test_a_file_cut_at_every_byte(tmp_path, monkeypatch, block):
    monkeypatch.setattr(lines, "BLOCK", block)
    for k, raw in enumerate(TEXTS):
        file = tmp_path / str(k)
        file.write_bytes(raw)
        store, place = _open(str(file))
        for split in {1, 2, 3, 7, 50, max(len(raw), 1)}:
            found = []
            for _, start, stop, size in [(file, at, min(at + split, len(raw)), len(raw)) for at in range(0, len(raw), split)]:
                own = list(lines.read_lines(store, place, start, stop))
                assert lines.count_lines(store, place, start, stop, size) == len(own), (raw, split, start)
                found += own
            assert found == plain(raw), (raw, split)


@pytest.mark.parametrize("split", [1, 5, 1 << 20])
def test_numbers_of_files_and_folders(spark, tmp_path, split):
    (tmp_path / "logs" / "sub").mkdir(parents=True)
    for name, raw in (("b", b"x\ny"), ("a", b"1\n\n3\n"), ("c", b""), ("sub/d", b"z\n"), ("_hidden", b"no\n"), (".crc", b"no\n")):
        (tmp_path / "logs" / name).write_bytes(raw)
    got = sorted((r["place"], r["file"].rsplit("/logs/")[1], r["line"], r["text"]) for r in lines.read_numbered(spark, str(tmp_path / "logs"), split).collect())
    assert got == [(1, "a", 1, "1"), (2, "a", 2, ""), (3, "a", 3, "3"), (4, "b", 1, "x"), (5, "b", 2, "y"), (6, "sub/d", 1, "z")]
    one = lines.read_numbered(spark, f"file:{tmp_path}/logs/b", split).orderBy("line").collect()
    assert [(r["line"], r["place"], r["text"]) for r in one] == [(1, 1, "x"), (2, 2, "y")]
    assert lines.read_numbered(spark, str(tmp_path / "logs" / "c"), split).collect() == []
    with pytest.raises(FileNotFoundError):
        lines.read_numbered(spark, str(tmp_path / "none"))


def test_logs_by_range(spark, tmp_path, monkeypatch):
    log = tmp_path / "a.jsonl"
    log.write_text('{"k": 1, "v": "a"}\n{bad\n\n{"k": 1, "v": "b"}\n{"k": 2, "v": null}')
    for split in (1, 8, 1 << 20):
        monkeypatch.setattr(lines, "SPLIT", split)
        tolerant = readers.read_log_tolerant(spark, str(log), "k long, v string").orderBy("line").collect()
        assert [(r["line"], r["value"] and r["value"]["v"], r["error"]) for r in tolerant] == [(1, "a", None), (2, None, "{bad"), (4, "b", None), (5, None, None)]


def test_the_last_of_a_key_wins_across_files(spark, tmp_path):
    folder = tmp_path / "log"
    folder.mkdir()
    (folder / "part-1").write_text('{"k": 1, "v": "late"}\n')
    (folder / "part-0").write_text('{"k": 1, "v": "a"}\n{"k": 2, "v": "b"}\n{"k": 1, "v": "c"}\n')
    assert sorted(tuple(r) for r in readers.read_log_by(spark, str(folder), "k long, v string", "k").collect()) == [(1, "late"), (2, "b")]
    (folder / "part-1").write_text('{"k": 1, "v": \n')
    with pytest.raises(Exception):  # noqa: B017
        readers.read_log_by(spark, str(folder), "k long, v string", "k").collect()
