from __future__ import annotations

import random
import time

import numpy as np

from tests.llm.fixtures import pairs, table
from tidegrid.llm import decontaminate
from tidegrid.llm.decontaminate import Items, search


def edits(item, text):
    """Least edits of ``item`` into any substring of ``text``."""
    before = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        now = [i]
        for j, b in enumerate(text, 1):
            now.append(min(before[j - 1] + (a != b), before[j] + 1, now[-1] + 1))
        before = now
    return min(before)


def spoiled(rng, text, n):
    out = list(text)
    for _ in range(n):
        at = rng.randrange(len(out))
        kind = rng.randrange(3)
        if kind == 0:
            out[at] = rng.choice("abcdefgh")
        elif kind == 1:
            out.insert(at, rng.choice("abcdefgh"))
        else:
            out.pop(at)
    return "".join(out)


def test_equals_full_alignment():
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    for _ in range(250):
        item = word(rng.randint(40, 110))
        k = len(item) * decontaminate.EDITS // 100
        text = word(rng.randint(0, 40)) + spoiled(rng, item, rng.randint(0, k + 3)) + word(rng.randint(0, 40))
        found = list(search(Items([(5, item.encode())], decontaminate.EDITS), [text.encode()]))
        least = edits(item, text)
        assert bool(found) == (least <= k)
        if found:
            _, _, start, end, cost = found[0]
            assert cost == least and edits(item, text[start:end]) == least


def test_tables(spark):
    rng = random.Random(2)
    items = [" ".join("".join(rng.choice("abcdefghijk") for _ in range(5)) for _ in range(20)) for _ in range(12)]
    bench = spark.createDataFrame([*[(i, t) for i, t in enumerate(items)], (20, None), (21, "short item"), (22, items[0]), (None, items[1])], "item_id long, text string")
    rows = pairs(table(spark)) + [(5000, f"start {items[0].upper()}! end"), (5001, items[2].replace(" ", "\n, ")), (5002, items[3][: len(items[3]) // 2]), (5003, items[4] + " and " + items[5]), (5003, items[4] + " and " + items[5])]
    df = table(spark, rows)
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_items(df, bench).collect()}
    assert found == {(5000, 0), (5000, 22), (5001, 2), (5003, 4), (5003, 5)}
    kept = decontaminate.drop_contaminated(df, bench)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, _ in rows} - {5000, 5001, 5003}
    # rows are judged each, with and without an id of their own
    mixed = table(spark, [(1, items[3]), (1, "clean"), (None, items[3]), (None, "clean"), (2, None)])
    assert sorted(map(repr, pairs(decontaminate.drop_contaminated(mixed, bench)))) == sorted(map(repr, [(1, "clean"), (None, "clean"), (2, None)]))


def test_positions_are_in_the_text(spark):
    item = "Que sera sera, whatever will be will be; the future's not ours to see"
    text = f"é ñ {item.upper()} é"
    r = decontaminate.find_items(table(spark, [(1, text)]), spark.createDataFrame([(1, item)], "item_id long, text string")).first()
    assert text.encode()[r["start"] : r["end"]].decode() == item.upper() and r["edits"] == 0


def test_shared_openings(monkeypatch):
    """Items that share a phrase are found as alone; a text that repeats the phrase costs little."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijk") for _ in range(5))
    phrase = " ".join(word() for _ in range(12))
    items = [f"{phrase} {' '.join(word() for _ in range(8))}".encode() for _ in range(40)]
    items.append(phrase.encode())
    texts = [(phrase + " ") .encode() * 150, b"x " + items[3] + b" y", spoiled(rng, items[5].decode(), 3).encode() + b" " + items[7], b"no"]
    want = []
    for t, item in enumerate(items):
        alone = search(Items([(t, item)], decontaminate.EDITS), texts)
        want += [(d, t, start, end, cost) for d, _, start, end, cost in alone]
    for hits in (decontaminate.HITS, 500):
        monkeypatch.setattr(decontaminate, "HITS", hits)
        monkeypatch.setattr(decontaminate, "CELLS", 50 if hits == 500 else 1 << 18)
        began = time.process_time()
        got = sorted(search(Items(list(enumerate(items)), decontaminate.EDITS), texts))
        assert hits == 500 or time.process_time() - began < 5
        assert got == sorted(want)
    assert {(1, 3), (2, 5), (2, 7), (0, 40)} <= {(d, t) for d, t, *_ in got}


def test_blocks_of_items(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    whole = sorted(map(tuple, decontaminate.find_items(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "ITEMS", 7)
    assert sorted(map(tuple, decontaminate.find_items(docs, bench).collect())) == whole and whole
    found = {r[0] for r in whole}
    assert sorted(pairs(decontaminate.drop_contaminated(docs, bench))) == sorted(p for p in pairs(docs) if p[0] not in found)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_items(table(spark), none).collect() == []
    assert decontaminate.find_items(table(spark, []), none).collect() == []
    assert decontaminate.drop_contaminated(table(spark), none).count() == table(spark).count()


def test_folding_drops_marks():
    got, at = decontaminate.letters(np.frombuffer("A b-C, é".encode(), dtype=np.uint8))
    assert bytes(got) == "abcé".encode() and at.tolist() == [0, 2, 4, 7, 8]


def test_short_items_as_whole_words(spark):
    items = [(0, "Who wrote the first book of Moses?"), (1, "Oslo"), (2, "ab c"), (3, "?!"), (4, "oslo."), (5, "é x"), (6, "a" * 39), (7, "one two")]
    docs = ["He asked: who wrote - the first BOOK of Moses", "who wrote the first book of Mose", "In Oslo, Oslo", "Oslow and coslo", "a bc", "x AB\nC", "y é x", "a" * 40, "a" * 39, "end one", "two end", "", None, "c"]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = table(spark, list(enumerate(docs)))
    found = decontaminate.find_items(df, bench).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(0, 0), (2, 1), (2, 4), (5, 2), (6, 5), (8, 6)]
    places = {(r["doc_id"], r["item_id"]): docs[r["doc_id"]].encode()[r["start"] : r["end"]].decode() for r in found}
    assert places[0, 0] == "who wrote - the first BOOK of Moses" and places[5, 2] == "AB\nC" and places[6, 5] == "é x"
    assert all(r["edits"] == 0 for r in found) and next(r["start"] for r in found if r["item_id"] == 1) == 3
    assert {r["doc_id"] for r in decontaminate.drop_contaminated(df, bench).collect()} == set(range(14)) - {0, 2, 5, 6, 8}


def test_short_items_equal_word_search():
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice("ab ,C") for _ in range(n))
    split = lambda t: "".join(c if c.isalnum() else " " for c in t.lower()).split()
    for _ in range(200):
        items = [(i, text(rng.randint(1, 6)).encode()) for i in range(5)]
        docs = [text(rng.randint(0, 30)) for _ in range(6)]
        got = {(d, t) for d, t, *_ in search(Items(items, decontaminate.EDITS), [d.encode() for d in docs])}
        want = set()
        for d, doc in enumerate(docs):
            for t, (_, item) in enumerate(items):
                a, b = split(doc), split(item.decode())
                if b and any(a[i : i + len(b)] == b for i in range(len(a))):
                    want.add((d, t))
        assert got == want
