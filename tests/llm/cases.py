"""Small tables with everything that may go wrong in them."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def awkward_rows() -> list[tuple]:
    """Nulls, empty and very long texts, ties, repeated rows, near and exact copies."""
    base = words(1, 60)
    rows = [
        (1, base, "en", "a"),
        (2, base.upper(), "en", "b"),
        (3, base, "en", None),
        (3, base, "en", None),
        (4, None, None, "a"),
        (5, "", "en", "b"),
        (6, " \n\t ", "en", "c"),
        (None, words(2, 30), "en", "a"),
        (None, words(2, 30), "en", "a"),
        (7, words(2, 30), "fr", "b"),
        (8, "É é Ünïcode   text \U0001f600 É", "fr", ""),
        (9, "é é ünïcode   text \U0001f600 é", "fr", ""),
        (10, words(3, 20_000), "en", "a"),
        (11, words(3, 20_000), "en", "d"),
        (12, "x" * 50_000, "en", "d"),
        (13, "one", "en", "d"),
        (14, "one two", "en", "d"),
        (15, "ONE TWO", "en", None),
    ]
    rows += [(100 + i, words(50, 200).replace(" w7 ", f" v{i} ", 1), "en", "a") for i in range(30)]
    rows += [(200 + i, words(60 + i, 80), "en", "abcd"[i % 4]) for i in range(40)]
    return [(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows]


def awkward(spark):
    return spark.createDataFrame(awkward_rows(), DOCS).repartition(5)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def clashing(docs):
    """The same rows with more columns, some of whose names differ in case only,
    repeat, or are those the operators use themselves."""
    names = ["TEXT", "kept", "size", "fp", "_hash", "key", "hash", "position", "a.b", "size"]
    wide = docs.select("*", *[docs.lang.alias(n) for n in names])
    return wide
