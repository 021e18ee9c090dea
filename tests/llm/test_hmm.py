from __future__ import annotations

import itertools
import math
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.fixtures import pairs, table, words
from tests.oracle import TABLES
from tidegrid.llm import hmm

RNG = np.random.default_rng(0)
MODEL = hmm.Model(np.array([0.3, 0.5, 0.2]), np.array([[0.5, 0.3, 0.2], [0.1, 0.6, 0.3]]), RNG.dirichlet(np.ones(5), 2).T)
TEXTS = [RNG.integers(0, 5, n).astype(np.uint16) for n in (0, 1, 3, 6, 6, 2, 0)]


def paths(text):
    for z in itertools.product(range(2), repeat=len(text)):
        p = MODEL.start[z[0]] * MODEL.emit[text[0], z[0]]
        for i in range(1, len(text)):
            p *= MODEL.step[z[i - 1], z[i]] * MODEL.emit[text[i], z[i]]
        yield z, p * MODEL.step[z[-1], 2]


def test_forward_is_exact():
    want = [math.log(sum(p for _, p in paths(t))) if len(t) else math.log(0.2) for t in TEXTS]
    assert np.allclose(hmm.log_likelihood(MODEL, TEXTS), want, atol=1e-12)


def test_expected_counts_are_exact():
    starts, steps, emits = np.zeros(3), np.zeros((2, 3)), np.zeros((2, 5))
    for t in TEXTS:
        if not len(t):
            starts[2] += 1
            continue
        total = sum(p for _, p in paths(t))
        for z, p in paths(t):
            starts[z[0]] += p / total
            steps[z[-1], 2] += p / total
            for i, s in enumerate(z):
                emits[s, t[i]] += p / total
                if i:
                    steps[z[i - 1], s] += p / total
    for ours, want in zip(hmm.expected(MODEL, TEXTS), (starts, steps, emits), strict=True):
        assert np.allclose(ours, want)


def test_long_stretches_and_scaling(monkeypatch):
    long = RNG.integers(0, 5, 5000).astype(np.uint16)
    parts = hmm.log_likelihood(MODEL, [long, long[:10]])
    assert np.isfinite(parts).all() and parts[1] == pytest.approx(hmm.log_likelihood(MODEL, [long[:10]])[0])
    monkeypatch.setattr(hmm, "STRETCH", 100)
    assert hmm.expected(MODEL, [long])[2].sum() == pytest.approx(5000)


def base(rows, held):
    counts, n = Counter(), 0
    for d, t in rows:
        if not held(d):
            counts.update(words(t))
            n += 1
    total, distinct = sum(counts.values()) + n, len(counts) + (n > 0)
    score = lambda c: math.log10((c + 1) / (total + distinct + 1))
    return {d: (len(words(t)) + 1, sum(counts[w] > 0 for w in words(t)) + (n > 0), total, sum(score(counts[w]) for w in words(t)) + score(n)) for d, t in rows}


@pytest.mark.parametrize("known", [200_000, 40])
def test_base_scores_equal_brute_force(spark, monkeypatch, known):
    monkeypatch.setattr(hmm, "KNOWN_WORDS", known)
    monkeypatch.setattr(hmm, "OWN_SYMBOLS", 20)
    df = table(spark)
    want = base(pairs(df), lambda d: d is not None and d % 3 == 0)
    found = hmm.score_texts(df, F.col("doc_id") % 3 == 0).collect()
    assert len(found) == df.count()
    for r in found:
        tokens, known_n, total, score = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (tokens, known_n, total)
        assert r["base_score"] == pytest.approx(score, rel=1e-9) and r["score"] < 0


def test_better_than_word_counts_on_held_out_texts(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    found = hmm.score_texts(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2)
    held = found.where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]


def test_all_words_of_a_tiny_language_sum_to_one(spark):
    """Texts of up to two words over known words: their scores sum to less than one, and to much of it."""
    rows = [(i, t) for i, t in enumerate(["a", "b", "a b", "b a", "a a", "b b", None, ""])]
    found = hmm.score_texts(table(spark, rows), F.lit(False)).dropDuplicates(["score"]).collect()
    total = sum(10 ** r["score"] for r in hmm.score_texts(table(spark, rows[:-1]), F.lit(False)).collect())
    assert 0.1 < total < 1 and found


def test_empty_table(spark):
    assert hmm.score_texts(table(spark, []), F.lit(False)).collect() == []
    assert hmm.score_texts(table(spark, [(1, "a b")]), F.lit(True)).count() == 1


@pytest.mark.parametrize("known", [200_000, 6])
def test_whole_scores_equal_brute_force(spark, monkeypatch, known):
    """Own words, classes of other words, unknown words and the end, by a plain forward recursion."""
    monkeypatch.setattr(hmm, "OWN_SYMBOLS", 3)
    monkeypatch.setattr(hmm, "KNOWN_WORDS", known)
    made = []

    def begun(coded, unigram, n_words, n_texts):
        made.append(hmm.Model.begin(unigram, hmm.STATES, n_words / n_texts))
        return made[-1]

    monkeypatch.setattr(hmm, "_train", begun)
    texts = ["The a the b", "a a a c the d", "b sing ring", "ring e the a", "", None, "the a new words here ring", "unseen a", "a"]
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["score"] for r in hmm.score_texts(df, F.col("doc_id") >= 6).collect()}
    words = {i: (t or "").encode().lower().split() for i, t in rows}
    counts = Counter(w for i in range(6) for w in words[i])
    common = sorted(counts, key=lambda w: (-counts[w], w))
    if known == 6:  # as many of the greatest counts as fit
        common = [w for w in common if sum(c >= counts[w] for c in counts.values()) <= 6]
    own, model = common[:3], made[0]
    mass = Counter()
    for w, c in counts.items():
        if w not in own:
            mass[hmm.word_class(w)] += c + 1
    for i, text in words.items():
        alpha = None
        for w in text:
            symbol = own.index(w) if w in own else len(own) + hmm.word_class(w)
            share = 1.0 if w in own else (counts[w] + 1) / (mass[hmm.word_class(w)] + 1)
            emit = model.emit[symbol] * share
            alpha = (model.start[:-1] if alpha is None else alpha @ model.step[:, :-1]) * emit
        chance = model.start[-1] if alpha is None else alpha @ model.step[:, -1]
        assert abs(found[i] - math.log10(chance)) < 1e-6


def test_training_takes_all_texts_in_every_round(spark, monkeypatch):
    """The model is that of plain rounds over every training text, ended by the gain in their log-probability."""
    monkeypatch.setattr(hmm, "TOLERANCE", 0.02, raising=False)
    monkeypatch.setattr(hmm, "SAMPLE_WORDS", 50, raising=False)
    rng = np.random.default_rng(3)
    texts = [rng.choice(12, n, p=rng.dirichlet(np.ones(12) / 3)).astype(np.uint16) for n in [*rng.integers(1, 60, 50), 0, 700]]
    rows = [(i % 5 == 0, t.tobytes(), i) for i, t in enumerate(texts)]
    training = [t for i, t in enumerate(texts) if i % 5]
    unigram = np.bincount(np.concatenate(training), minlength=12) + 1.0
    unigram /= unigram.sum()
    words = sum(map(len, training))
    found = hmm._train(spark.createDataFrame(rows, "held_out boolean, symbols binary, row long").repartition(3), unigram, words, len(training))
    want, last, rounds = hmm.Model.begin(unigram, hmm.STATES, words / len(training)), -math.inf, 0
    while True:
        chance = hmm.log_likelihood(want, training).sum()
        starts, steps, emits = hmm.expected(want, training)
        want, rounds = hmm.Model.fit(starts, steps, emits.T, unigram), rounds + 1
        if chance - last <= 0.02 * (words + len(training)):
            break
        last = chance
    assert rounds > 3
    for ours, theirs in ((found.start, want.start), (found.step, want.step), (found.emit, want.emit)):
        assert np.allclose(ours, theirs, rtol=1e-8, atol=1e-12)


def test_scaled_recursions_equal_plain_ones():
    """Texts over several scalings, of many lengths, against forward and backward sums normalised at each word."""
    texts = [RNG.integers(0, 5, n).astype(np.uint16) for n in (15, 16, 17, 18, 33, 33, 48, 70, 150, 0, 1)]
    step, end = MODEL.step[:, :2], MODEL.step[:, 2]
    starts, steps, emits, chances = np.zeros(3), np.zeros((2, 3)), np.zeros((2, 5)), []
    for t in texts:
        if not len(t):
            starts[2] += 1
            chances.append(math.log(MODEL.start[2]))
            continue
        alpha, sizes, beta = [], [], [end]
        for i, s in enumerate(t.tolist()):
            now = (alpha[-1] @ step if i else MODEL.start[:2]) * MODEL.emit[s]
            sizes.append(now.sum())
            alpha.append(now / now.sum())
        chances.append(math.log(alpha[-1] @ end) + np.log(sizes).sum())
        for s in t.tolist()[:0:-1]:
            now = step @ (MODEL.emit[s] * beta[-1])
            beta.append(now / now.sum())
        beta.reverse()
        for i, s in enumerate(t.tolist()):
            gamma = alpha[i] * beta[i]
            emits[:, s] += gamma / gamma.sum()
            if i:
                pair = alpha[i - 1][:, None] * step * (MODEL.emit[s] * beta[i])
                steps[:, :2] += pair / pair.sum()
            else:
                starts[:2] += gamma / gamma.sum()
        steps[:, 2] += gamma / gamma.sum()
    for ours, want in zip(hmm._expected(MODEL, texts), (starts, steps, emits, sum(chances)), strict=True):
        assert np.allclose(ours, want, rtol=1e-10)
    assert np.allclose(hmm.log_likelihood(MODEL, texts), chances, rtol=1e-10)


def test_a_round_and_scoring_hold_few_tables():
    """A round works in three tables of a row for each word, and scoring in two, which serve all blocks."""
    model = hmm.Model.begin(np.full(50, 0.02), 8, 300.0)
    texts = [RNG.integers(0, 50, 300 - i % 40).astype(np.uint16) for i in range(512)]
    cells = sum(map(len, texts))
    for work, tables in ((hmm._expected, 3), (hmm.log_likelihood, 2)):
        work(model, texts[:2])
        tracemalloc.start()
        work(model, texts)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < (tables + 0.5) * 64 * cells
