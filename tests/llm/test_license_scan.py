from __future__ import annotations

import math
import re

from pyspark.sql import functions as F

from tests.llm.fixtures import table
from tidegrid.llm import license_scan

ROWS = [
    (1, "Licensed under the Apache License, Version 2.0.", "a/b/LICENSE"),
    (2, "x", "a/b/c/d"),
    (3, None, "a/z"),
    (4, "", None),
    (None, "t", "q"),
    (5, "Released under the MIT License.", "LICENSE.txt"),
    (6, "foo bar\nword\nLicensed under CC BY-NC 4.0.\n" + "und so weiter\n" * 30, "a/b/e"),
    (7, "the license of a dog is under the table", "k/y"),
    (8, "This work is licensed under the GNU General Public License, version 3.", "a/COPYING"),
    (2, "x", "a/b/c/d"),
]


def documents(spark):
    return spark.createDataFrame([(*r, 1.0, "w") for r in ROWS], "doc_id long, text string, path string, cosine double, word string")


def brute(texts, threshold):
    """Best licence of each line and whole text, with plain dictionaries."""
    split = lambda t: [w for w in re.split(r"[^\w]+|_", t.lower()) if w]
    counts = license_scan._template_counts()
    vocabulary = {w for c in counts for w in c}
    n = len(texts)
    df = {w: sum(w in split(t) for t in texts.values()) for w in vocabulary}
    weight = {w: math.log((n + 1) / (df[w] + 1)) + 1 for w in vocabulary}
    unseen = math.log(n + 1) + 1
    out = {}
    for d, t in texts.items():
        for line, part in [(-1, t), *enumerate(t.split("\n"))]:
            words = split(part)
            norm = math.sqrt(sum((words.count(w) * weight[w]) ** 2 for w in set(words) & vocabulary) + unseen**2 * sum(w not in vocabulary for w in words))
            best = []
            for (name, _), c in zip(license_scan.TEMPLATES, counts, strict=True):
                dot = sum(words.count(w) * weight[w] * k * weight[w] for w, k in c.items())
                size = math.sqrt(sum((k * weight[w]) ** 2 for w, k in c.items()))
                if dot and dot / norm / size >= threshold:
                    best.append((-round(dot / norm / size, 9), name))
            if best:
                out[d, line] = min(best)
    return out


def test_notices_equal_brute_force(spark):
    texts = {d: t or "" for d, t, _ in ROWS if d is not None}
    df = documents(spark).dropDuplicates(["doc_id", "text"])
    for threshold in (0.6, 0.25):
        want = {k: (name, -c) for k, (c, name) in brute(texts, threshold).items()}
        got = {(r["doc"], r["line"]): (r["license"], round(r["cosine"], 9)) for r in license_scan.notices(df, threshold=threshold).collect()}
        assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-6 for k in want)


def test_inheritance(spark):
    found = license_scan.scan(documents(spark), F.col("path")).collect()
    assert len(found) == len(ROWS)
    got = {r["doc_id"]: (r["license"], r["origin"], r["stated_in"]) for r in found}
    assert got == {
        1: ("Apache-2.0", "file", "a/b/LICENSE"),
        2: ("Apache-2.0", "inherited", "a/b/LICENSE"),
        3: ("GPL-3.0", "inherited", "a/COPYING"),
        4: (None, "none", None),
        None: ("MIT", "inherited", "LICENSE.txt"),
        5: ("MIT", "file", "LICENSE.txt"),
        6: ("CC-BY-NC-4.0", "header", "a/b/e"),
        7: ("MIT", "inherited", "LICENSE.txt"),
        8: ("GPL-3.0", "file", "a/COPYING"),
    }


def test_headers_do_not_license_their_directory(spark):
    gpl = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."
    rows = [(1, f"# {gpl}\nint a;", "src/a.c"), (2, "int b;", "src/b.c"), (3, "int c;", "src/lib/c.c"), (4, gpl, "other/d.c"), (5, "e", "other/e.c"), (6, gpl, "third/COPYING"), (7, "f", "third/x/f.c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, path string")
    got = {r["doc_id"]: (r["license"], r["origin"]) for r in license_scan.scan(df, F.col("path")).collect()}
    assert got == {1: ("GPL-3.0", "header"), 2: (None, "none"), 3: (None, "none"), 4: ("GPL-3.0", "header"), 5: (None, "none"), 6: ("GPL-3.0", "file"), 7: ("GPL-3.0", "inherited")}


def test_no_python_runs(spark):
    plan = license_scan.scan(documents(spark), F.col("path"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_awkward_and_empty_tables(spark):
    df = table(spark)
    assert license_scan.scan(df, F.lit("x/y")).count() == df.count()
    assert license_scan.scan(table(spark, []), F.lit("x/y")).collect() == []


def test_wrapped_notices_titles_and_identifiers(spark):
    code = "\n".join(f"value{i} = compute(other{i}, {i})" for i in range(60))
    bsd = "# Redistribution and use in source and binary\n# forms, with or without modification, are\n# permitted provided that the following\n#\n# conditions are met. Neither the name of the\n# copyright holder nor the names of its\n# contributors may be used to endorse\n"
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    rows = [
        (1, bsd + code, "a/x.py"),
        (2, "MIT License\n\nCopyright someone", "b/LICENSE"),
        (3, "x", "b/c/y"),
        (4, "// SPDX-License-Identifier: GPL-2.0-only\n" + code, "d/z"),
        (5, "// SPDX-License-Identifier: Zlib\n" + code, "e/z"),
        (6, "          Apache License\n   Version 2.0, January 2004\n" + code, "f/COPYING"),
        (7, "License\n" + code, "g/z"),
        (8, "Copyright (c) 2020 A. Person\n\n" + mit.replace(", ", ",\n"), "h/LICENSE.md"),
        (9, "the dog ran\nand a license\nof the cat", "i/z"),
        (10, "# SPDX-License-Identifier: CC-BY-4.0x", "j/z"),
    ] + [(100 + i, f"free use of the source software is in any form the word {i}", f"k/{i}") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string, path string")
    got = {r["doc_id"]: (r["license"], r["origin"]) for r in license_scan.scan(df, F.col("path")).collect() if r["doc_id"] < 100}
    assert got == {
        1: ("BSD-3-Clause", "header"),
        2: ("MIT", "file"),
        3: ("MIT", "inherited"),
        4: ("GPL-2.0", "header"),
        5: (None, "none"),
        6: ("Apache-2.0", "file"),
        7: (None, "none"),
        8: ("MIT", "file"),
        9: (None, "none"),
        10: (None, "none"),
    }
