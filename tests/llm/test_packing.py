from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.fixtures import pairs, table
from tidegrid.llm import packing
from tidegrid.llm.packing import BestFit, pack_documents
from tidegrid.llm.wordtokens import WordTokens

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["a\x02end\x02 b", "\x02end\x02", "x <|endoftext|> y The, THE. 'S it's, don't. <|ENDOFTEXT|>", "", "  ", "É, é. Ñ, a.b, a,. ,,  é́ ẞ, 12. 3,4 a\xa0b, \x01 z", " a,", "a,", "x.\n", ".", "a. ", "ﬁ ǅ ΑΣ Σ."]


@pytest.mark.parametrize("end", [None, 0, 7])
def test_ids_equal_the_tokenizer(end):
    plain, ours = Tokenizer.from_file(PATH), WordTokens(PATH)
    for group in (ODD, *[[t] for t in ODD]):
        ids, starts = ours.encode([t.encode() for t in group], end)
        for i, t in enumerate(group):
            assert ids[starts[i] : starts[i + 1]].tolist() == plain.encode(t, add_special_tokens=False).ids + ([] if end is None else [end])


def test_memory_of_words_is_bounded(monkeypatch):
    from tidegrid.llm import wordtokens

    monkeypatch.setattr(wordtokens, "REMEMBERED", 50)
    plain, ours, rng = Tokenizer.from_file(PATH), WordTokens(PATH), random.Random(4)
    for _ in range(20):
        texts = [" ".join(f"w{rng.randrange(90)}" for _ in range(30)) for _ in range(3)]
        ids, starts = ours.encode([t.encode() for t in texts], 0)
        assert all(ids[starts[i] : starts[i + 1]].tolist() == plain.encode(t, add_special_tokens=False).ids + [0] for i, t in enumerate(texts))
        ours.rest()


def test_best_fit_rules():
    fit = BestFit(10, open_bins=2)
    assert fit.place(6) == (0, 0) and fit.place(7) == (1, 0)
    assert fit.place(3) == (1, 7)  # the fuller of two that fit
    assert fit.place(8) == (2, 0) and fit.place(9) == (3, 0)  # the fullest, bin 2, closed
    assert fit.place(2) == (0, 6) and fit.place(10) == (4, 0)


def check(rows, docs, size):
    plain = Tokenizer.from_file(PATH)
    expected = Counter()
    for d, t in docs:
        ids = plain.encode(t or "", add_special_tokens=False).ids + [0]
        for piece, a in enumerate(range(0, len(ids), size)):
            part = ids[a : a + size]
            expected[d, piece, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return bins


@pytest.mark.parametrize("size", [2048, 64])
def test_packs_everything(spark, size):
    df = table(spark)
    rows = pack_documents(df, PATH, size=size).collect()
    bins = check(rows, pairs(df), size)
    total = sum(r["length"] for r in rows)
    assert len(bins) <= 1.1 * total / size + 1


def test_ids_and_empty_table(spark):
    rows = pack_documents(table(spark, [(1, "a b"), (2, None)]), PATH, with_ids=True).orderBy("doc_id").collect()
    assert np.frombuffer(rows[1]["ids"], "<u4").tolist() == [0] and len(rows[0]["ids"]) == 12
    assert pack_documents(table(spark, []), PATH).collect() == []


def naive(lengths, size, most):
    """The same rules, over a plain list of open bins."""
    free, order, out, made = {}, {}, [], 0
    for turn, n in enumerate(lengths):
        fitting = [b for b in free if free[b] >= n]
        if fitting:
            # the tightest; of equally tight ones that which was filled last
            at = min(fitting, key=lambda b: (free[b], -order[b]))
        else:
            at, made = made, made + 1
            if len(free) >= most and n < size:
                closed = min(free, key=lambda b: (free[b], -order[b]))
                del free[closed]
            free[at] = size
        out.append((at, size - free[at]))
        free[at] -= n
        order[at] = turn
        if not free[at]:
            del free[at]
    return out


def test_best_fit_equals_a_naive_packer():
    rng = random.Random(6)
    for size, most in ((8, 1), (8, 3), (20, 2), (64, 5), (64, 1000)):
        for _ in range(60):
            lengths = [rng.randint(1, size) if rng.random() < 0.5 else rng.randint(1, max(1, size // 5)) for _ in range(rng.randint(1, 120))]
            fit = packing.BestFit(size, most)
            assert [fit.place(n) for n in lengths] == naive(lengths, size, most)


def test_rows_of_one_id_spread_over_packers(spark, monkeypatch):
    monkeypatch.setattr(packing, "PIECES_PER_PACKER", 40)
    for doc_id in (None, 7):
        out = packing.pack_documents(table(spark, [(doc_id, "the same words")] * 400), PATH, size=64).collect()
        each = Counter(r["sequence_id"] >> 33 for r in out)
        assert len(out) == 400 and len(each) >= 8 and max(each.values()) < 150


def test_a_worker_drops_what_another_operator_kept():
    from tidegrid.llm import common, wordtokens

    wordtokens.word_tokens(PATH)

    def own(batches):
        yield from batches

    own.__module__ = packing.__name__
    assert list(common.tidy_after(own)(iter([1]))) == [1] and wordtokens._loaded
    own.__module__ = "tidegrid.llm.decontaminate"
    assert list(common.tidy_after(own)(iter([1]))) == [1] and not wordtokens._loaded
