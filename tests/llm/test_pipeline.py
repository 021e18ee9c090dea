from __future__ import annotations

import numpy as np

import corpus_pipeline
from tests.llm.fixtures import table
from tests.llm.test_jaccard_join import brute as groups
from tests.llm.test_packing import check
from tests.llm.test_suffix_dedup import brute as repeats
from tests.oracle import TABLES, connect
from tidegrid.llm import queries
from tidegrid.llm.common import saved

FOLDER = TABLES


def _pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def contaminated(rows, items, percent=5):
    """Ids of texts that hold an item with at most ``percent`` edits in a hundred letters, by full alignment of each."""
    folded = lambda t: np.frombuffer(bytes(b for b in (t or "").encode().lower() if b >= 128 or chr(b).isalnum()), dtype=np.uint8)
    # all texts in a row, farther from each other than any number of edits
    parts, owner = [], []
    for i, (_, t) in enumerate(rows):
        parts += [folded(t), np.zeros(40, dtype=np.uint8)]
        owner += [np.full(len(parts[-2]), i), np.full(40, i)]
    text, owner = np.concatenate(parts), np.concatenate(owner)
    place, found = np.arange(len(text) + 1, dtype=np.int32), set()
    for item in map(folded, items):
        cost = np.zeros(len(text) + 1, dtype=np.int32)
        for symbol in item.tolist():
            new = np.empty_like(cost)
            new[0] = cost[0] + 1
            new[1:] = np.minimum(cost[:-1] + (text != symbol), cost[1:] + 1)
            cost = np.minimum.accumulate(new - place) + place
        found |= set(owner[np.flatnonzero(cost[1:] <= len(item) * percent // 100)].tolist())
    return {rows[i][0] for i in found}


def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = saved(stage(spark, docs, FOLDER), "stage")
        before = _pairs(docs)
        if name != "packing":
            assert out.columns == docs.columns
            after = _pairs(out)
        if name == "near duplicates":
            assert sorted(after) == sorted((d, t) for d, t in before if groups(before)[d][1] == d)
        elif name == "repeated strings":
            cut = repeats(before)
            # partly covered characters stay whole, so a few bytes more may be left
            for d, t in after:
                n, removed, spans, _ = cut[d]
                assert n - removed <= len((t or "").encode()) <= n - removed + 2 * spans
            assert all(r["n_chars"] == len(r["text"]) for r in out.collect())
        elif name == "decontamination":
            items = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
            assert min(map(len, items)) > 60
            leaked = contaminated(before, items)
            assert leaked and sorted(after) == sorted(p for p in before if p[0] not in leaked)
        elif name == "packing":
            check(out.collect(), before, 2048)
        else:
            kept = {d for d, k in connect().execute(f"SELECT doc_id, kept FROM ({queries.ORACLE['op7_quality_rules']})").fetchall() if k}
            assert 0 < len(after) < len(before) and sorted(after) == sorted(p for p in before if p[0] in kept)
        docs = out


def test_run_and_awkward_tables(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 100
    for rows in (None, []):
        docs = table(spark, rows)
        for _, stage in corpus_pipeline.STAGES:
            docs = saved(stage(spark, docs, FOLDER), "stage")
        assert (docs.count() > 0) == (rows is None)


def test_rows_without_id_stay_in_repeated_strings(spark):
    docs = table(spark)
    out = corpus_pipeline.repeated_strings(spark, docs, FOLDER)
    assert out.columns == docs.columns
    lost = lambda df: sorted(map(repr, df.where("doc_id is null").collect()))
    assert lost(out) == lost(docs) and lost(docs)
    assert out.count() == docs.count()
