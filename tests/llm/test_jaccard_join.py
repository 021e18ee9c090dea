from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import pairs, prose, table, words
from tidegrid.llm import jaccard_join, textbytes
from tidegrid.llm.components import components


def sets(rows, width=5):
    out = {}
    for d, t in rows:
        w = words(t)
        out[d] = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()
    return out


def brute(rows):
    s = sets(rows)
    parent = {d: d for d in s}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in s:
        for b in s:
            both = len(s[a] & s[b])
            if a < b and both and 100 * both >= 80 * (len(s[a]) + len(s[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(s[d]), root(d)) for d in s}


def clusters(seed):
    """Groups of near copies around the threshold, chained, and texts that share a passage."""
    rng = random.Random(seed)
    out, passage = [], prose(rng, 60)
    for _ in range(6):
        text = prose(rng, rng.randint(30, 120)).split()
        for _ in range(12):
            text = list(text)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = f"w{rng.randrange(99)}"
            out.append(" ".join(text))
    out += [passage + " " + prose(rng, rng.randint(20, 90)) for _ in range(30)]
    return [(i * 3 % 1000, t) for i, t in enumerate(out)]


def test_cells_of_a_region_equal_brute_force(monkeypatch):
    """Voronoi cells with copied boundaries connect what all pairs connect, in and across ``left``."""
    rng = np.random.default_rng(8)
    for cell, pivots in ((1, 2), (3, 4), (8, 8)):
        monkeypatch.setattr(jaccard_join, "CELL", cell)
        monkeypatch.setattr(jaccard_join, "CELL_PIVOTS", pivots)
        for _ in range(20):
            seeds = [rng.choice(3000, size=rng.integers(5, 60), replace=False) for _ in range(5)]
            held = []
            for _ in range(60):
                s = set(seeds[rng.integers(5)].tolist())
                for x in rng.choice(sorted(s), size=min(len(s) - 1, int(rng.integers(0, 8))), replace=False).tolist():
                    s.discard(x)
                s |= set(rng.integers(0, 3000, size=rng.integers(0, 6)).tolist())
                held.append(np.array(sorted(s), dtype=np.uint64))
            left, boundary = np.arange(45), np.arange(45, 60)
            region = jaccard_join.Region(held)
            found = {(min(a, b), max(a, b)) for a, b in jaccard_join.join_region(region, 80, left, boundary)}
            linked = lambda a, b: 100 * len(np.intersect1d(held[a], held[b])) >= 80 * len(np.union1d(held[a], held[b]))
            want = {(a, b) for a in range(45) for b in range(a + 1, 60) if linked(a, b)}
            assert found <= {(a, b) for a in range(60) for b in range(a + 1, 60) if linked(a, b)}

            def groups(pairs):
                own = list(range(60))
                for a, b in pairs:
                    own = [own[a] if g == own[b] else g for g in own]
                return [own.index(g) for g in own]

            assert groups(found) == groups(want)


def test_equal_sets_fold_whatever_their_number(spark, monkeypatch):
    rows = [(7 * i % 400, "one two three four five six" if i % 3 else f"other {i % 5} text of some few words more") for i in range(300)]
    want = brute(rows)
    for hot in (10_000, 50, 3):
        monkeypatch.setattr(jaccard_join, "HOT", hot)
        found = jaccard_join.near_duplicates(table(spark, rows)).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == want and len(found) == 300


@pytest.mark.parametrize("limit", [2000, 6])
def test_equals_brute_force(spark, limit):
    rows = clusters(limit)
    found = jaccard_join.near_duplicates(table(spark, rows), region_docs=limit).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute(rows)


def test_crowds_at_frequent_marks(spark):
    """Many near copies and a passage in many texts, with a small limit for one task."""
    rng = random.Random(9)
    base, passage, rows = prose(rng, 80).split(), prose(rng, 70), []
    for i in range(60):
        text = list(base)
        text[rng.randrange(80)] = f"w{i}"
        rows.append((i, " ".join(text)))
    rows += [(100 + i, passage + " " + prose(rng, 40)) for i in range(40)]
    found = jaccard_join.near_duplicates(table(spark, rows), region_docs=8).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute(rows)


def test_a_passage_of_many_texts_is_no_meeting_however_large_the_table(spark, monkeypatch):
    """The sample that tells frequent shingles is a share of all texts, not so many of them."""
    rng = random.Random(4)
    passage = prose(rng, 30)
    rows = [(i, (passage + " " if i % 5 == 0 else "") + prose(rng, rng.randint(60, 90))) for i in range(400)]
    rows += [(400 + i, rows[i][1] + " end") for i in range(0, 60, 4)]
    met, saved = [], jaccard_join.saved

    def watched(df, name, *more):
        out = saved(df, name, *more)
        if name == "meetings":
            met.append(out.agg(F.max("n_docs")).first()[0])
        return out

    monkeypatch.setattr(jaccard_join, "saved", watched)
    monkeypatch.setattr(jaccard_join, "SAMPLE", 4)
    found = jaccard_join.near_duplicates(table(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute(rows)
    assert met[0] < 40


def test_awkward_rows(spark):
    df = table(spark)
    rows = [p for p in pairs(df) if p[0] is not None]
    found = jaccard_join.near_duplicates(df).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(d for d, _ in rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute(rows)
    kept = jaccard_join.keep_first(df)
    assert kept.columns == df.columns
    want = {d for d, (_, c) in brute(rows).items() if c == d}
    assert {r["doc_id"] for r in kept.collect()} == want | {None}


def test_region_links_connect_what_links():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**60, 50).astype(np.uint64)
    docs = [np.unique(np.concatenate((base[rng.permutation(50)[:46]], rng.integers(0, 2**60, 3).astype(np.uint64)))) for _ in range(40)]
    region = jaccard_join.Region(docs)
    links = jaccard_join.join_region(region, 80, np.arange(40), np.zeros(0, dtype=np.int64))

    def groups(edges):
        group = list(range(40))
        for a, b in edges:
            group = [group[a] if g == group[b] else g for g in group]
        return [tuple(i for i in range(40) if group[i] == g) for g in group]

    every = [(a, b) for a in range(40) for b in range(a) if 100 * len(np.intersect1d(docs[a], docs[b])) >= 80 * len(np.union1d(docs[a], docs[b]))]
    assert groups(links) == groups(every) and set((max(x), min(x)) for x in links) <= set(every)


def test_counts_never_rule_out_a_link():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 90).astype(np.uint64)
    docs = sorted((np.concatenate((base[: 90 - k], rng.integers(0, 2**63, k // 2).astype(np.uint64))) for k in (0, 3, 6, 9, 12)), key=len)
    n = np.array([len(d) for d in docs])
    counts = [np.bincount((d & np.uint64(int(jaccard_join._levels(len(d))) - 1)).astype(int), minlength=int(jaccard_join._levels(len(d)))).astype(np.uint8) for d in docs]
    pairs_found = jaccard_join.connect_possible(n, counts, 80)
    assert len(pairs_found) == 4  # all five are connected


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(50, 52), (52, 51), (60, 60)] + [(0, 1)] * 3
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == dict.fromkeys(range(41), 0) | {50: 50, 51: 50, 52: 50}


def test_empty_table(spark):
    assert jaccard_join.near_duplicates(table(spark, [])).collect() == []
    assert jaccard_join.keep_first(table(spark, [])).collect() == []


def _thue_morse(bits):
    word = "a"
    for _ in range(bits):
        word += word.translate(str.maketrans("ab", "ba"))
    return word


@pytest.mark.parametrize("n", range(7))
def test_short_texts_alone_and_after_a_long_one(n):
    """0 to 6 words, as the only text of a chunk, and in the chunk after one of over a megabyte."""
    short = " ".join(f"w{i}" for i in range(n)).encode()
    long = b"ab cd " * (textbytes.CHUNK // 6 + 10)
    alone = [s.tolist() for _, s in textbytes.shingles([short], 5)]
    after = [s.tolist() for _, s in textbytes.shingles([long, short, b""], 5)]
    assert alone[0] == after[1] and after[2] == []
    assert len(alone[0]) == (0 if n == 0 else max(1, n - 4))


def test_short_texts_equal_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["a", "b", "c d", "\n"]) for _ in range(rng.randint(0, 8)))) for i in range(120)] + [(500, None)]
    for part in (rows, rows[:1], [(1, "hello world")], [(1, "one two three"), (2, None)], [(1, "One two"), (2, "one TWO")]):
        got = jaccard_join.near_duplicates(table(spark, part)).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute([(d, t) for d, t in part])


def test_structured_words_do_not_link(spark):
    word = _thue_morse(12)
    rows = [(1, word), (2, word.translate(str.maketrans("ab", "ba"))), (3, word)]
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.near_duplicates(table(spark, rows)).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_blocks_of_like_documents_give_a_spanning_forest():
    """Every pair of 2 x 200 documents links; the links found are fewer than the documents."""
    rng = np.random.default_rng(2)
    base = np.arange(100, dtype=np.uint64)
    sets = [np.sort(np.concatenate((base, rng.integers(1000, 2000, 2).astype(np.uint64)))) for _ in range(400)]
    found = jaccard_join.join_across(jaccard_join.Region([np.unique(s) for s in sets]), 80, np.arange(200), np.arange(200, 400))
    assert len(found) == 399


def test_a_column_named_as_the_join_names_its_own(spark):
    docs = table(spark, [(1, "a b c d e f"), (2, "a b c d e f"), (3, "g")]).withColumn("extra__", F.lit(1)).withColumn("extra", F.lit("x"))
    kept = jaccard_join.keep_first(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3]


def test_regions_of_many_shingles_are_cut_as_those_of_many_documents(spark, monkeypatch):
    rows = clusters(5) + clusters(5)[:3]
    want = brute(rows)
    for limit in (1, 300, 2000):
        monkeypatch.setattr(jaccard_join, "REGION_SHINGLES", limit)
        got = jaccard_join.near_duplicates(table(spark, rows, False)).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
