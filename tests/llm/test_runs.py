from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from tests.llm.fixtures import SCHEMA, pairs, prose, raw, table
from tidegrid.llm import runs


def brute(x, least):
    """Maximal runs by every period: stretches where elements a period apart are equal."""
    n, out = len(x), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            if j - i >= q:
                out.append((i, j - i + q, q))
            i = max(j, i) + 1
    # the smallest period only
    return sorted(r for r in out if r[1] >= max(least, 2 * r[2]) and not any(s[0] <= r[0] and s[0] + s[1] >= r[0] + r[1] and s[2] < r[2] for s in out))


def found(x, least):
    codes = np.append(np.array(x, dtype=np.int64), 10**6)
    return list(zip(*(a.tolist() for a in runs.find_runs(codes, least)), strict=True))


def words_of(rng, n, k):
    return [rng.randrange(k) for _ in range(n)]


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("least", [2, 12])
def test_runs_equal_brute_force(least):
    rng = random.Random(least)
    cases = [[], [1], [1, 1], [0] * 200, [0, 1] * 60, fibonacci(150), [0, 0, 1] * 30 + [0, 0], fibonacci(60) * 3]
    cases += [words_of(rng, rng.randint(1, 120), rng.choice([1, 2, 3, 8])) for _ in range(150)]
    for _ in range(60):
        x = words_of(rng, rng.randint(20, 150), 30)
        a = rng.randrange(len(x))
        p = rng.randint(1, max(1, (len(x) - a) // 2))
        cases.append(runs.repeat_tail(x, a, p) + words_of(rng, rng.randint(0, 5), 30))
    for x in cases:
        assert found(x, least) == brute(x, least), x


def test_many_texts_at_once_equal_each_alone():
    rng = random.Random(9)
    texts = [[b"%d" % w for w in words_of(rng, rng.randint(0, 80), 2)] for _ in range(120)]
    together = runs.report(texts)
    assert together == [runs.report([t])[0] for t in texts]


def test_the_pool_of_members_is_renewed():
    rng = random.Random(4)
    x = fibonacci(3000)
    for i in range(0, 3000, 97):
        x[i] = rng.randrange(2)
    classes = runs.Classes(np.append(np.array(x), 9))
    while len(classes.small):
        classes.refine()
        assert classes.filled <= 12 * classes.n
        for c in set(classes.cls[classes.cls >= 0].tolist()):
            members = np.flatnonzero(classes.cls == c)
            assert classes.count[c] == len(members)
            if classes.length in (2, 3, 50):
                assert len({tuple(x[i : i + classes.length]) for i in members.tolist()}) == 1 and (classes.next[members[:-1]] == members[1:]).all()


def expected(doc_id, text):
    w = raw(text).split()
    if doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    rows = brute(w, 12)
    drop = {i for s, n, q in rows for i in range(s + q, s + n)}
    best = min(rows, key=lambda r: (-r[1], r[0], r[2])) if rows else None
    first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in rows)
    return doc_id, len(rows), *first, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in drop)).hexdigest()


def test_documents_equal_brute_force(spark):
    rng = random.Random(12)
    rows = [(i, " ".join(rng.choice(["a", "b", "c", "d\t", "\n"]) for _ in range(rng.randint(0, 90)))) for i in range(-40, 120)]
    rows += [(i, prose(rng, rng.randint(1, 250), 50)) for i in range(1000, 1120)] + [(7, None), (7, ""), (None, "a b " * 20), (7, "x " * 90), (7, "x " * 90)]
    docs = table(spark, rows)
    got = runs.periodic_runs(docs, planted=True, together=500)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(expected(d, t)) for d, t in rows)


def test_standard_rows_empty_table_and_cutting(spark):
    docs = table(spark).where("length(text) < 9000 or text is null")
    assert sorted(map(repr, map(tuple, runs.periodic_runs(docs, planted=True).collect()))) == sorted(repr(expected(d, t)) for d, t in pairs(docs))
    empty = spark.createDataFrame([], SCHEMA)
    assert runs.periodic_runs(empty).columns == [f.name for f in runs._RESULT] and runs.periodic_runs(empty).collect() == []
    cut = runs.without_repeats(table(spark, [(1, "x y z " * 6 + "end"), (2, " as  it is "), (3, None)]))
    assert cut.columns == docs.columns and {r["doc_id"]: r["text"] for r in cut.collect()} == {1: "x y z end", 2: " as  it is ", 3: None}
