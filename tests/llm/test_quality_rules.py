from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import functions as F

from tests.llm.fixtures import pairs, table
from tests.oracle import TABLES, same
from tidegrid.llm import queries, quality_rules


def counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    times, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if times[g] > 1:
            covered |= set(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_counts_equal_brute_force(spark):
    df = table(spark).unionByName(table(spark, [(900, "a b c d e f g h " * 3), (901, "# *|\n\n \n# *|\nx")]))
    want = {d: counts(t) for d, t in pairs(df)}
    found = quality_rules.judge(df).collect()
    assert len(found) == df.count()
    for r in found:
        assert tuple(r)[1:6] == want[r["doc_id"]]
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_verdict_equals_sql(spark):
    same(queries.op7_quality_rules(spark, TABLES), queries.ORACLE["op7_quality_rules"])


def test_fences_follow_the_group(spark):
    """The same text is normal in one source and an outlier in the other."""
    plain = " ".join(f"word{i}" for i in range(60))
    marked = " ".join(f"word{i}#" for i in range(60))
    rows = [(i, f"{plain} {i}", "en", "calm") for i in range(150)] + [(1000 + i, f"{marked} {i}", "en", "noisy") for i in range(150)] + [(5000, marked, "en", "calm"), (5001, marked, "en", "noisy")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.judge(df).where(F.col("doc_id") >= 5000).collect()}
    assert kept == {5000: False, 5001: True}


def test_verdicts_follow_the_tails_of_two_groups(spark):
    """One rate of marks, within the tail of one source and beyond that of the other; no cutoff is common to both."""
    text = lambda marks, i: " ".join(f"word{j}" + "#" * (j < marks) for j in range(100)) + f" {i}"
    rows = [(i, text(i % 6, i), "en", "low") for i in range(200)] + [(1000 + i, text(10 * (i % 6), i), "en", "high") for i in range(200)]
    for k, marks in enumerate((4, 15, 30, 90)):
        rows += [(5000 + k, text(marks, k), "en", "low"), (6000 + k, text(marks, k), "en", "high")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.judge(df).where(F.col("doc_id") >= 5000).collect()}
    assert [kept[5000 + k] for k in range(4)] == [True, True, False, False] and all(kept[6000 + k] for k in range(4))


def test_few_events_and_groups_of_copies_do_not_reject(spark):
    """A repeated line in a short text is no pattern; a source of copies does not reject what differs a little."""
    plain = lambda i: " ".join(f"word{(i * 7 + j) % 90}" for j in range(60))
    rows = [(i, plain(1), "en", "copies") for i in range(300)] + [(500 + i, plain(i), "en", "copies") for i in range(20)]
    rows += [(900, "a line that comes again\n" * 2 + plain(3), "en", "copies"), (901, plain(4) + " #!", "en", "copies")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert [r["doc_id"] for r in quality_rules.judge(df).collect() if not r["kept"]] == []


def test_rows_that_share_an_id_are_judged_each(spark):
    good, rows = " ".join(f"word{i}" for i in range(60)), []
    rows = [(1, good), (1, "bad"), (None, "bad"), (None, good)]
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string")
    assert sorted(map(repr, pairs(quality_rules.keep_good(df)))) == sorted(map(repr, [(1, good), (None, good)]))


def test_no_python_runs(spark):
    plan = quality_rules.judge(table(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_filter_keeps_columns_and_empty_tables(spark):
    df = table(spark)
    out = quality_rules.keep_good(df)
    assert out.columns == df.columns
    # rows are judged by their own text: repeated and null ids too
    verdicts = {(r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"]): r["kept"] for r in quality_rules.judge(df).collect()}
    keep = lambda p: verdicts[p[0], *counts(p[1])[:3]]
    assert sorted(map(repr, pairs(out))) == sorted(repr(p) for p in pairs(df) if keep(p))
    assert quality_rules.judge(table(spark, [])).collect() == [] and quality_rules.keep_good(table(spark, [])).collect() == []
