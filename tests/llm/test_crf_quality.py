from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import functions as F

from tests.llm.fixtures import table
from tidegrid.llm import crf_quality


def held_out(column):
    return F.crc32(F.col(column).cast("string").cast("binary")) % 4 == 2


def test_marginals_are_exact():
    rng = np.random.default_rng(0)
    potential, first, steps = rng.normal(size=9), np.array([0, 4, 5]), rng.normal(size=(2, 2))
    chance, pairs, norm = crf_quality.marginals(potential, first, steps)
    for chain, (a, b) in enumerate(((0, 4), (4, 5), (5, 9))):
        total, good, moves = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=b - a):
            e = np.exp(sum(potential[a + i] * y[i] for i in range(b - a)) + sum(steps[y[i - 1], y[i]] for i in range(1, b - a)))
            total, good = total + e, good + e * np.array(y)
            for i in range(1, b - a):
                moves[y[i - 1], y[i]] += e
        assert np.allclose(good / total, chance[a:b]) and np.allclose(moves / total, pairs[chain]) and np.isclose(np.log(total), norm[chain])


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    found = crf_quality.classify(docs, labels, held_out).join(labels, "doc_id").where("held_out")
    right, usual = found.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.avg("quality")).first()
    assert right > 0.95 > usual


def test_held_out_labels_are_not_learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    turned = labels.withColumn("quality", F.when(held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (crf_quality.classify(docs, x, held_out).orderBy("doc_id").collect() for x in (labels, turned))
    assert one == two


def test_awkward_rows(spark):
    df = table(spark)
    labels = spark.createDataFrame([(0, 1, 0), (7, 0, 1), (14, None, 0), (None, 1, 0), (21, 1, 0), (21, 0, 0), (28, 0, None), (35, 1, 1)], "doc_id long, quality int, toxic int")
    found = crf_quality.classify(df, labels, held_out).collect()
    assert len(found) == df.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in found)
    none = crf_quality.classify(df, labels.limit(0), held_out).collect()
    assert {r["score"] for r in none} == {0.5}
    assert crf_quality.classify(table(spark, []), labels, held_out).collect() == []


def test_scores_do_not_depend_on_the_batch():
    rng = np.random.default_rng(1)
    texts = [b"", b"\n\n", b"a b c\nd e f", b"X!! Y!!\n| a | b |", b"the " * 40]
    table_, _, _ = crf_quality.line_features(texts)
    field = crf_quality.Field(rng.normal(size=table_.shape[1]), rng.normal(size=(2, 2)), table_.mean(axis=0), table_.std(axis=0) + 1)
    together = crf_quality.document_scores(field, texts)
    alone = [crf_quality.document_scores(field, [t])[0] for t in texts]
    assert np.allclose(together, alone)


def test_scores_equal_brute_force():
    """Features of each line recounted, and the score by listing all labellings of a text's lines."""
    rng = np.random.default_rng(2)
    texts = [b"A cat sat. A cat sat.\nthe the dog!\n\n| # x | 12", b"A cat sat. A cat sat.\nlast line?\nlast line?", b"", "\u00e9t\u00e9 a\tb c".encode()]
    table_, first, size = crf_quality.line_features(texts)
    names = {"upper": 4, "digit": 5, "symbol": 6, "shout": 7, "stop": 8, "quote": 9, "other": 10, "high": 11}
    at = 0
    for text in texts:
        lines, every = text.split(b"\n"), text.split()
        triples = [tuple(every[i : i + 3]) for i in range(len(every) - 2)]
        word = 0
        for n, line in enumerate(lines):
            row, own = table_[at, 3:], line.split()
            many, letters = max(len(own), 1), max(sum(65 <= b <= 90 or 97 <= b <= 122 for b in line) + sum(b >= 128 for b in line) / 2, 1)
            kind = lambda test, line=line: sum(map(test, line))
            want = {
                "upper": kind(lambda b: 65 <= b <= 90) / letters,
                "digit": kind(lambda b: 48 <= b <= 57) / max(len(line), 1),
                "symbol": kind(lambda b: b in b"#*$%&|<>") / many,
                "shout": line.count(b"!") / many,
                "stop": kind(lambda b: b in b".,;:?") / many,
                "quote": kind(lambda b: b in b"\"'()-") / many,
                "other": kind(lambda b: b < 128 and not chr(b).isalnum() and b not in b"#*$%&|<>!.,;:?\"'()- \t\n\x0b\x0c\r") / many,
                "high": kind(lambda b: b >= 128) / max(len(line), 1),
            }
            assert all(abs(row[names[k]] - x) < 1e-5 for k, x in want.items())
            assert np.allclose(row[:3], np.log1p([len(line), len(own), len(every)]), atol=1e-5)
            places = range(word, word + len(own))
            flags = [
                sum(w in own[:i] for i, w in enumerate(own)) / many,
                sum(i > 0 and every[i] == every[i - 1] for i in places) / many,
                sum(i < len(triples) and triples.count(triples[i]) > 1 for i in places) / many,
                bool(own) and lines.count(line) > 1,
                bool(own) and line in lines[:n],
                not own,
                bool(own) and line[-1:] in b".!?",
                len(every) < 10,
                len(every) < 20,
            ]
            assert np.allclose(row[12:21], np.array(flags, dtype=float), atol=1e-5)
            word += len(own)
            at += 1
    field = crf_quality.Field(rng.normal(size=table_.shape[1]), rng.normal(size=(2, 2)), table_.mean(axis=0), table_.std(axis=0) + 1)
    potential = field.potential(table_)
    scores = crf_quality.document_scores(field, texts)
    for d, (a, b) in enumerate(zip(first, [*first[1:], len(table_)], strict=True)):
        total, good = 0.0, np.zeros(b - a)
        for y in itertools.product((0, 1), repeat=b - a):
            e = np.exp(sum(potential[a + i] * y[i] for i in range(b - a)) + sum(field.transitions[y[i - 1], y[i]] for i in range(1, b - a)))
            total, good = total + e, good + e * np.array(y)
        assert np.isclose(scores[d], (good / total * size[a:b]).sum() / size[a:b].sum())


def test_the_sample_is_bounded_by_lines(spark, monkeypatch):
    rows = [(i, "a\n" * i) for i in range(50)] + [(3, "other"), (3, "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)] + [(4, 0)], "doc_id long, quality int")
    monkeypatch.setattr(crf_quality, "SAMPLE_LINES", 200)
    taken = crf_quality.sample(docs, labels, F.lit(True), "doc_id", "text", "quality").collect()
    lines = sum(bytes(r["text"]).count(b"\n") + 1 for r in taken)
    assert 150 < lines <= 200 and max(bytes(r["text"]).count(b"\n") for r in taken) > 10
    monkeypatch.setattr(crf_quality, "SAMPLE_LINES", 10_000)
    assert len(crf_quality.sample(docs, labels, F.lit(True), "doc_id", "text", "quality").collect()) == 50


def test_null_ids_are_scored_and_not_held_out(spark):
    docs = table(spark, [(None, "some words here"), (None, None), (2, "some words here")])
    labels = spark.createDataFrame([(2, 1), (None, 0)], "doc_id long, quality int")
    got = crf_quality.classify(docs, labels, lambda column: F.crc32(F.col(column).cast("string").cast("binary")) % 4 == 2).collect()
    assert len(got) == 3 and all(r["held_out"] is False for r in got if r["doc_id"] is None)
    assert all(0 <= r["score"] <= 1 for r in got)
