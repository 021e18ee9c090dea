"""Licences of files: from their own notices, or from the nearest directory that states one.

Each line of a text, each run of up to ``RUN`` lines that are not blank, and each text as a whole, is
a sparse TF-IDF vector; its cosine to every template tells the licence.  A run starts and ends
at a line with a word of the templates, as other lines at its ends only lower the cosine, and has at
most twice the words of the longest notice.  Document frequencies of the templates' words are counted
over all texts; all other words weigh as much as a word that no text has.  By the Cauchy-Schwarz
inequality a vector without any of the heaviest template words stays under the threshold, so
only texts and lines that have one are compared, without loss.

Titles and SPDX identifiers are too short for a cosine: one that has a line, or the lines of a wrapped
title, to itself counts as a notice of cosine 1.  A licence's full text is known by its title or by
the run of its opening sentence.

A file whose name is that of a licence file licenses its directory; any other notice licenses its
own file only, however much of the file it is.  A file with no notice of its own inherits from its nearest ancestor
directory with a licence, by joins of path prefixes.

Only DataFrame and SQL functions are used.  Null texts have no notice; a null path is in no
directory.  The best cosine wins, then the earliest line, then the first name.  Rows that share
an id share their notices; each row is returned.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, small_side

# fixed values: notices by which files state public licences
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license. See the LICENSE file in the project root for full license information."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License version 2.1"),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met. Neither the name of the copyright holder nor the names of its contributors may be used to endorse"),
    ("BSD-2-Clause", "Use of this source code is governed by a BSD 2-Clause license that can be found in the LICENSE file."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, ISC license"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0 Universal."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
]
#: Words of the longest notice.
_LONGEST = max(len(re.findall("[a-z0-9]+", t.lower())) for _, t in TEMPLATES)
#: Words of titles, which a licence's text starts with.
TITLES = [
    ("MIT", "MIT License"),
    ("Apache-2.0", "Apache License"),
    ("Apache-2.0", "Apache License Version 2.0"),
    ("Apache-2.0", "Apache License Version 2.0 January 2004"),
    ("GPL-3.0", "GNU General Public License Version 3"),
    ("GPL-3.0", "GNU General Public License Version 3 29 June 2007"),
    ("GPL-2.0", "GNU General Public License Version 2"),
    ("GPL-2.0", "GNU General Public License Version 2 June 1991"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1"),
    ("LGPL-2.1", "GNU Lesser General Public License Version 2.1 February 1999"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3"),
    ("AGPL-3.0", "GNU Affero General Public License Version 3 19 November 2007"),
    ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-2-Clause", "BSD 2-Clause License"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("ISC", "ISC License"),
    ("CC-BY-4.0", "Creative Commons Attribution 4.0 International"),
    ("CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International"),
    ("CC-BY-SA-4.0", "Creative Commons Attribution-ShareAlike 4.0 International"),
    ("CC0-1.0", "CC0 1.0 Universal"),
]
#: Lines of a run, at most.
RUN = 12
#: Least cosine of a notice.
THRESHOLD = 0.6
#: Base names of files that license their directory.
LICENSE_FILE = r"(?i)^(un)?licen[cs]e(\..*)?$|^copying(\..*)?$|^notice(\..*)?$"

_SPLIT = r"[^\p{L}\p{N}]+"


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _SPLIT), lambda w: w != "")


def _template_counts() -> list[dict[str, int]]:
    out = []
    for _, text in TEMPLATES:
        counts: dict[str, int] = {}
        for w in re.split("[^a-z0-9]+", text.lower()):
            if w:
                counts[w] = counts.get(w, 0) + 1
        out.append(counts)
    return out


def key_words(vectors: list[dict[str, float]], threshold: float) -> list[str]:
    """The heaviest words such that any vector without them has a cosine under the threshold to all templates."""
    heaviest = sorted({w for v in vectors for w in v}, key=lambda w: (-max(v.get(w, 0.0) / _norm(v) for v in vectors), w))
    keys: set[str] = set()
    for w in heaviest:
        rest = max(math.sqrt(sum(x * x for u, x in v.items() if u not in keys)) / _norm(v) for v in vectors)
        if rest < threshold - 1e-9:
            break
        keys.add(w)
    return sorted(keys)


def _norm(vector: dict[str, float]) -> float:
    return math.sqrt(sum(x * x for x in vector.values()))


def _runs(near: DataFrame, known: Column, keys: Column) -> DataFrame:
    """Runs of two lines or more, each with its first line and its words."""
    lines = F.filter(F.transform(F.split("text", "\n"), lambda t, i: F.struct(i.alias("line"), _words(t).alias("words"))), lambda x: F.size(x["words"]) > 0)
    told = near.select("doc", F.transform(lines, lambda x: F.struct(x["line"].alias("line"), x["words"].alias("words"), F.arrays_overlap(x["words"], known).alias("told"))).alias("lines"))
    # filled first, so that the splitting is not done again for each start
    starts = F.transform("lines", lambda x, i: F.when(x["told"], F.slice("lines", i + 1, RUN)))
    block = told.select("doc", F.explode(F.filter(starts, lambda b: F.size(b) > 1)).alias("block"))
    block = block.where(F.arrays_overlap(F.flatten("block.words"), keys))
    ends = F.filter(F.sequence(F.lit(2), F.size("block")), lambda n: F.element_at("block", n)["told"])
    runs = block.select("doc", F.col("block")[0]["line"].alias("line"), "block", F.explode(ends).alias("n"))
    return runs.select("doc", "line", F.flatten(F.slice("block.words", F.lit(1), F.col("n"))).alias("words")).where(F.size("words") <= 2 * _LONGEST)


def stated_names(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Titles and SPDX identifiers, as rows like those of ``notices``, with a cosine of 1."""
    edge, gap = r"[^\p{L}\p{N}\n]*", r"[^\p{L}\p{N}]+"
    forms = [(name, rf"(?im)^{edge}(?:the )?{gap.join(re.findall('[A-Za-z0-9]+', title))}{edge}$") for name, title in TITLES]
    forms += [(name, rf"(?im)SPDX-License-Identifier:[ \t(]*{re.escape(name)}(?:-only|-or-later|\+)?(?![\p{{L}}\p{{N}}+.-])") for name in sorted({n for n, _ in TEMPLATES})]
    plain = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).where("doc is not null").where(F.col("text").rlike("(?i)licen[cs]e|creative commons|cc0"))
    found = F.array(*[F.struct(F.lit(name).alias("license"), F.regexp_instr("text", F.lit(form)).alias("at")) for name, form in forms])
    each = plain.select("doc", "text", F.explode(F.filter(found, lambda x: x["at"] > 0)).alias("f"))
    line = F.size(F.split(F.expr("substring(text, 1, f.at - 1)"), "\n")) - 1
    return each.select("doc", line.alias("line"), "f.license", F.lit(1.0).alias("cosine"))


def notices(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, runs: bool = False) -> DataFrame:
    """Per id and unit its best licence: ``doc``, ``line`` (-1 for the whole text), license, cosine.

    Only units at or above the threshold have a row.  With ``runs`` a line also stands for the runs
    of lines that start there.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where("doc is not null")
    counts = _template_counts()
    vocabulary = sorted({w for c in counts for w in c})
    known = F.array(*[F.lit(w) for w in vocabulary])
    spread = plain.select(F.explode(F.array_append(F.array_intersect(_words(F.col("text")), known), F.lit(""))).alias("word"))
    df = {r["word"]: r["n"] for r in spread.groupBy("word").agg(F.count("*").alias("n")).collect()}
    n = df.pop("", 0)
    weight = {w: math.log((n + 1) / (df.get(w, 0) + 1)) + 1 for w in vocabulary}
    unseen = math.log(n + 1) + 1
    vectors = [{w: k * weight[w] for w, k in c.items()} for c in counts]
    keys = F.array(*[F.lit(w) for w in key_words(vectors, threshold)])

    near = plain.where(F.arrays_overlap(_words(F.col("text")), keys))
    near = saved(near.dropDuplicates(["doc", "text"]), "near")
    lines = near.select("doc", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    units = lines.unionByName(near.select("doc", F.lit(-1).alias("line"), "text"))
    units = units.select("doc", "line", _words(F.col("text")).alias("words"))
    if runs:
        units = units.unionByName(_runs(near, known, keys))
    units = units.where(F.arrays_overlap("words", keys))
    # an id that comes with several texts has its units apart
    unit = ["doc", "line", "unit", "n_words"]
    units = units.select("doc", "line", F.xxhash64("words").alias("unit"), F.size("words").alias("n_words"), F.explode("words").alias("word"))
    idf = F.broadcast(spark.createDataFrame([(w, weight[w]) for w in vocabulary], "word string, idf double"))
    entries = [(t, TEMPLATES[t][0], w, x / _norm(v)) for t, v in enumerate(vectors) for w, x in v.items()]
    templates = F.broadcast(spark.createDataFrame(entries, "template int, license string, word string, share double"))
    # only the templates' words are counted and shuffled; all others add to the norm by their number
    counted = saved(units.join(idf, "word").groupBy(*unit, "word", "idf").agg(F.count("*").alias("k")), "counted")
    square = F.sum((F.col("k") * F.col("idf")) ** 2) + (F.col("n_words") - F.sum("k")) * unseen * unseen
    norm = counted.groupBy(*unit).agg(F.sqrt(square).alias("norm"))
    dot = counted.join(templates, "word").groupBy(*unit, "template", "license").agg(F.sum(F.col("k") * F.col("idf") * F.col("share")).alias("dot"))
    found = dot.join(norm, unit).select("doc", "line", "license", F.round(F.col("dot") / F.col("norm"), 9).alias("cosine")).where(F.col("cosine") >= threshold)
    return found.groupBy("doc", "line").agg(F.min(F.struct(-F.col("cosine"), "license")).alias("best")).select("doc", "line", "best.license", (-F.col("best.col1")).alias("cosine"))


def scan(docs: DataFrame, path: Column, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, path, license, cosine, origin (header, file, inherited or none) and the stating path."""
    own = notices(docs, id_col, text_col, threshold, runs=True).unionByName(stated_names(docs, id_col, text_col))
    best = own.groupBy("doc").agg(F.min(F.struct(-F.col("cosine"), F.col("line"), F.col("license"))).alias("b"))
    best = small_side(saved(best.select("doc", F.col("b.license").alias("license"), (-F.col("b.col1")).alias("cosine")), "best"))
    files = docs.select(F.col(id_col).alias("doc_id"), path.alias("path"))
    files = files.withColumns({"dir": F.regexp_extract("path", "^(.*)/[^/]*$", 1), "name": F.regexp_extract("path", "([^/]*)$", 1)})
    stated = saved(files.join(best, files["doc_id"] == best["doc"], "left").drop("doc"), "stated")

    licensing = stated.where(F.col("license").isNotNull() & F.col("path").isNotNull() & F.col("name").rlike(LICENSE_FILE))
    directories = licensing.groupBy("dir").agg(F.min(F.struct(-F.col("cosine"), F.col("license"), F.col("path"))).alias("b"))
    directories = directories.select(F.col("dir").alias("ancestor"), F.col("b.license").alias("given"), (-F.col("b.col1")).alias("given_cosine"), F.col("b.path").alias("given_path"))
    directories = small_side(saved(directories, "directories"))
    # each directory once, so that its files do not repeat the walk up
    parts = F.split("dir", "/")
    up = F.explode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(parts, F.lit(1), k), "/").alias("ancestor"))))
    walk = stated.where("license is null and path is not null").select("dir").distinct().select("dir", up.alias("u")).select("dir", "u.depth", "u.ancestor")
    nearest = walk.join(directories, "ancestor").groupBy("dir").agg(F.max_by(F.struct("given", "given_cosine", "given_path"), "depth").alias("g"))
    nearest = nearest.select(F.col("dir").alias("in_dir"), "g.given", "g.given_cosine", "g.given_path")
    joined = stated.join(small_side(saved(nearest, "nearest")), (F.col("dir") == F.col("in_dir")) & F.col("license").isNull() & F.col("path").isNotNull(), "left")
    origin = (
        F.when(F.col("license").isNotNull() & F.col("name").rlike(LICENSE_FILE), "file")
        .when(F.col("license").isNotNull(), "header")
        .when(F.col("given").isNotNull(), "inherited")
        .otherwise("none")
    )
    return joined.select(
        "doc_id",
        "path",
        F.coalesce("license", "given").alias("license"),
        F.coalesce("cosine", "given_cosine").alias("cosine"),
        origin.alias("origin"),
        F.when(F.col("license").isNotNull(), F.col("path")).otherwise(F.col("given_path")).alias("stated_in"),
    )
