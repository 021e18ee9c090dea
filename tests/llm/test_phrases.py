from __future__ import annotations

import random
import re
import uuid
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.fixtures import SCHEMA, raw, table
from tidegrid.llm import phrases


def brute(rows, least=30, best=2000):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", raw(text).lower()):
            words = re.findall(rb"[^ \t]+", piece)
            n[lang] += len(words)
            for m in range(1, 5):
                f.update((lang, tuple(words[i : i + m])) for i in range(len(words) - m + 1))
    candidates = {p: a for p, a in f.items() if a >= least and len(p[1]) >= 2}
    inside = Counter()
    for (lang, p), a in candidates.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                inside[lang, p[i : i + m]] = max(inside[lang, p[i : i + m]], a)
    rows = []
    for (lang, p), a in candidates.items():
        if inside[lang, p] and 100 * inside[lang, p] >= 80 * a:
            continue
        cuts = [(2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
        score, _, l, r = min(cuts)
        rows.append((lang, -score, -a, b" ".join(p), l, r))
    out, rank = [], Counter()
    for lang, score, a, p, l, r in sorted(rows):
        rank[lang] += 1
        if rank[lang] <= best:
            out.append((lang, rank[lang], p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def corpus(seed, n=200):
    rng = random.Random(seed)
    stock = ["The", "the", "of", "New", "york", "é", "İ", "a\u0000b", "x" * 40, "日本", "semi", "|"] + [f"w{i}" for i in range(30)]
    fixed = ["new york city hall", "semi of the", "日本 é", "a b a b a b"]
    out = []
    for _ in range(n):
        text = ""
        for _ in range(rng.randint(0, 40)):
            text += rng.choice(fixed) if rng.random() < 0.25 else rng.choice(stock[:12] if rng.random() < 0.7 else stock)
            text += rng.choice([" "] * 12 + ["  ", "\t", ".", ", ", "\n", "!?", "\r\n", "\x0b"])
        out.append((rng.choice(["en", "en", "en", "de", None, "und", ""]), text))
    return [*out, (None, None), ("xx", ""), ("en", "one"), ("en", "... ,,"), ("en", "of the " * 3000)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 1, "x", 1, "y", 2) for i, (lang, t) in enumerate(rows)], SCHEMA)


@pytest.mark.parametrize(("least", "best", "bits", "hot"), [(30, 2000, 1 << 26, 1000), (30, 7, 1 << 16, 2), (3, 2000, 1 << 15, 10**9), (2, 50, 1 << 18, 5)])
def test_collocations_equal_brute_force(spark, monkeypatch, least, best, bits, hot):
    monkeypatch.setattr(phrases, "CHUNK", 3000)
    rows = corpus(least + best)
    got = phrases.collocations(frame(spark, rows), least=least, best=best, bits=bits, hot=hot)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, least, best)


def test_standard_rows_and_empty_tables(spark):
    docs = table(spark)
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, phrases.collocations(docs, least=4).collect())) == brute(rows, 4)
    assert phrases.collocations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_growth_by_paths():
    pointers = [("d", "a", "b", None, None, False, 2), ("d", "a", "b", "c", None, False, 3), ("d", "a", "b", "c", "d", False, 1), ("d", "a", "c", None, None, False, 1), ("e", "a", "b", None, None, True, 1), ("e", "a", "b", "c", None, True, 1)]
    assert sorted(phrases.grow(pointers, 3)) == [("d", "a b", 2, 6), ("d", "a b c", 3, 4), ("e", "a b", 2, 2)]


def test_large_counts_are_exact(spark):
    big = 4 * 10**15
    rows = [("en", "a b", 2, big - 1), ("en", "a", 1, big + 1), ("en", "b", 1, big)]
    got = phrases.scored(spark.createDataFrame(rows, "lang string, phrase string, m int, f long")).first()
    assert got["score"] == 2000000 * (big - 1) // (2 * big + 1)


def test_a_bitmap_passes_what_it_was_made_of(spark):
    code = np.array([0, 1, 7, 8, 32767, 32768, 65535], dtype=np.uint64)
    positions = spark.createDataFrame([(int(c) + 1,) for c in code], "position long")
    made = phrases.Bitmap(phrases._bitmap(positions, 1 << 16))
    every = np.arange(1 << 16, dtype=np.uint64)
    assert every[made.passes(every)].tolist() == code.tolist()


@pytest.mark.parametrize("kept", [1 << 19, 60])
def test_a_task_makes_each_pointer_once(monkeypatch, kept):
    """Equal pointers of several chunks are one row, as long as the task can keep them; counts are right in any case."""
    monkeypatch.setattr(phrases, "CHUNK", 200)
    monkeypatch.setattr(phrases, "KEPT", kept, raising=False)
    rows = [(lang, text) for lang, text in corpus(5, 60) if lang is not None and text] * 3
    every = SimpleNamespace(value=b"\xff" * 4096)
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1].encode() for r in rows], pa.binary())], names=["lang", "text"])
    run = phrases._pointers([every] * 3, SimpleNamespace(value=np.zeros(0, dtype=np.int64)), 4)
    made = [tuple(r.values()) for b in run(iter([batch, batch])) for r in b.to_pylist()]
    want = Counter()
    for lang, text in rows * 2:
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", raw(text).lower()):
            words = [w.decode("utf-8", "replace") for w in re.findall(rb"[^ \t]+", piece)]
            want.update((lang, *(words[i : i + 4] + [None] * 4)[:4], False) for i in range(len(words) - 1))
    found = Counter()
    for *pointer, n in made:
        found[tuple(pointer)] += n
    assert found == want
    assert kept == 60 or len(made) == len(want)


def test_pointers_are_made_by_tasks_of_many_words(spark, monkeypatch, tmp_path):
    """A table of many small partitions has no row for each of them and phrase; all of its words are counted."""
    real = phrases._pointers

    def watched(*args):
        run = real(*args)

        def told(batches):
            made = list(run(batches))
            (tmp_path / str(uuid.uuid4())).write_text(str(sum(b.num_rows for b in made)))
            yield from made

        return told

    monkeypatch.setattr(phrases, "_pointers", watched)
    rows = [(lang, text) for _ in range(3) for lang, text in corpus(6, 60) if lang is not None]
    cores = spark.sparkContext.defaultParallelism
    df = spark.createDataFrame([r for r in rows for _ in range(6 * cores)], "lang string, text string").repartition(6 * cores)
    got = phrases.collocations(df).collect()
    made = [int(p.read_text()) for p in tmp_path.iterdir()]
    assert sorted(map(tuple, got)) == brute(rows * 6 * cores)
    assert 0 < len(made) <= cores


def test_kept_pointers_tell_words_of_several_languages_apart():
    kept = phrases.Kept(5)
    one, none = np.ones(2, dtype=np.int64), np.zeros(2, dtype=bool)
    made = list(kept.add("en", ["a", "b"], [np.array([1, 2]), np.array([2, 1]), np.array([1, 0])], none, one))
    made += kept.add("de", ["b", "a"], [np.array([1, 2]), np.array([2, 1])], ~none, one)
    made += kept.add("en", ["b", "a"], [np.array([1, 2]), np.array([2, 1]), np.array([0, 2])], none, 2 * one)
    made += kept.told()
    assert sorted((tuple(r.values()) for b in made for r in b.to_pylist()), key=str) == [("de", "a", "b", None, None, True, 1), ("de", "b", "a", None, None, True, 1), ("en", "a", "b", "a", None, False, 3), ("en", "b", "a", None, None, False, 3)]
    assert list(kept.told()) == []
