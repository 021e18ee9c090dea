"""Small awkward tables: nulls, empty and long texts, ties, repeated rows, extra columns."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, doc string, key long, ranges string, n long"


def prose(rng: random.Random, n: int, words: int = 400) -> str:
    stock = ["".join(rng.choice("abcdeéñ") for _ in range(rng.randint(2, 7))) for _ in range(words)]
    out = " ".join(rng.choice(stock) for _ in range(n))
    return out.replace(" a", "\nA", 3)


def texts(seed: int = 1) -> list[str | None]:
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(1, 300)) for _ in range(30)]
    passage = prose(rng, 40)
    out: list[str | None] = [None, "", " \t\n", "one", "two words", "\x00\x01 \x02end\x02", "the " * 300, "a" * 1500, "line\n" * 50]
    out += base + base[:6]  # exact copies
    for text in base[6:14]:  # near copies
        words = text.split(" ")
        words[rng.randrange(len(words))] = "changed"
        out.append(" ".join(words))
    out += [f"{b}\n{passage}\n{prose(rng, 30)}" for b in base[14:20]]  # a shared passage
    out.append(prose(rng, 20_000))  # very long
    out += [base[0].upper(), "x" * 99, "x" * 100, "é" * 60, "é" * 60]
    return out


def table(spark, rows: list[tuple[int | None, str | None]] | None = None, repeat: bool = True):
    """Documents with columns whose names operators use themselves."""
    if rows is None:
        rows = [(7 * i % 1009, t) for i, t in enumerate(texts())]
        if repeat:
            rows += rows[3:6] + rows[12:14]  # repeated rows
            rows.append((None, "no id"))
    full = [(i, t, None if k % 5 == 0 else "en", None if k % 7 == 0 else f"s{k % 2}", None if t is None else len(t), "x", 1, "y", 2) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def pairs(df) -> list[tuple[int | None, str | None]]:
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def raw(text: str | None) -> bytes:
    return (text or "").encode()


def words(text: str | None) -> list[bytes]:
    return raw(text).lower().split()
