from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.fixtures import SCHEMA, pairs, table
from tidegrid.llm import bpe_tree

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


def stretch(rng, n):
    """Text without a safe cut: letters, digits, signs, wide characters, each for long."""
    kinds = ["a", "ab", "etaoinsh", "0123456789", "=-", "é日本語ü", "'ll've", "\n \t", "<|endoftext|>"]
    out = ""
    while len(out) < n:
        kind = rng.choice(kinds)
        out += kind if kind[0] == "<" else "".join(rng.choice(kind) for _ in range(rng.randint(1, n)))
    return out


def odd_texts():
    rng = random.Random(5)
    return [stretch(rng, rng.randint(1, 400)) for _ in range(60)] + ["word's it'll  \n\n x" * 30, " " * 333 + "x", "'" * 99 + "re", "a" * 700, "<|endoftext|>" * 40, "𞤀ꟲ̃\U000323b0" * 50]


def test_joins_of_any_tree_equal_the_whole():
    bpe, rng = bpe_tree.byte_bpe(PATH), random.Random(1)

    def tree(raw, least, window):
        if len(raw) <= least:
            return bpe.unsplit(raw)
        at = rng.randint(1, len(raw) - 1)
        return bpe.join(tree(raw[:at], least, window), tree(raw[at:], least, window), window)

    for _ in range(1500):
        kind = rng.choice(["a", "ab", "abc", "ethns", "01", "-=", "é日a", "*#"])
        raw = "".join(rng.choice(kind) for _ in range(rng.randint(2, 250))).encode()
        assert tree(raw, rng.choice([1, 3, 20]), rng.choice([1, 2, 8])).tolist() == bpe.unsplit(raw).tolist()
    assert bpe.join(np.zeros(0, np.uint32), bpe.unsplit(b"x")).tolist() == bpe.unsplit(b"x").tolist()


def test_every_token_is_its_own_encoding():
    bpe = bpe_tree.byte_bpe(PATH)
    assert [i for i, raw in enumerate(bpe.table) if i not in bpe.special.values() and bpe.unsplit(raw).tolist() != [i]] == []


def test_leaves_are_the_text_and_encode_as_it_does(plain):
    bpe = bpe_tree.byte_bpe(PATH)
    for text in odd_texts():
        for size in (1, 2, 5, 16):
            cut = list(bpe_tree.leaves(bpe, text, size))
            assert "".join(x for x, _ in cut) == text
            ids: list[int] = []
            held = np.zeros(0, np.uint32)
            for piece, part in cut:
                if part == 0:
                    ids += held.tolist()
                    held = bpe.encode(piece)
                else:
                    held = bpe.join(held, bpe.encode(piece))
            assert ids + held.tolist() == plain.encode(text, add_special_tokens=False).ids, (text, size)


def expected(plain, text):
    ids = plain.encode(text or "", add_special_tokens=False).ids
    back = plain.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


@pytest.mark.parametrize(("long", "leaf"), [(bpe_tree.LONG, bpe_tree.LEAF), (40, 7), (0, 1)])
def test_documents_equal_the_library(spark, plain, long, leaf):
    docs = table(spark) if long else table(spark, [(i, t) for i, t in enumerate(["", None, "aaaaaaaaaaa bb", "it'll <|endoftext|>x", "é日"])])
    got = bpe_tree.encode_documents(docs, PATH, long=long, leaf=leaf).collect()
    want = sorted(((d is None, d or 0), *expected(plain, t)) for d, t in pairs(docs))
    assert sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == want


def test_unsplit_texts_join_over_many_levels(spark, plain):
    rows = list(enumerate(odd_texts() * 2))
    got = bpe_tree.encode_documents(table(spark, rows), PATH, long=30, leaf=3).collect()
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == sorted((d, *expected(plain, t)) for d, t in rows)


def test_empty_table_and_decoding(spark, plain):
    assert bpe_tree.encode_documents(spark.createDataFrame([], SCHEMA), PATH).collect() == []
    text = "it'll do: é日 <|endoftext|>\n"
    tokens = spark.createDataFrame([(1, plain.encode(text).ids), (2, []), (3, None)], "k long, ids array<long>")
    assert [r["text"] for r in bpe_tree.decode_ids(tokens, PATH).orderBy("k").collect()] == [text, "", None]
