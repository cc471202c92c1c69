from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from cases import awkward_rows, awkward, clashing, empty
from statewatt.llm import decontaminate
from statewatt.session import stored

ITEMS = "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, length=10):
    out = []
    for doc_id, text in docs:
        words, hit, names = terms(text), set(), set()
        for item_id, own in items:
            w = terms(own)
            n = min(length, len(w))
            windows = {tuple(w[s : s + n]) for s in range(len(w) - n + 1)} if n else set()
            for s in range(len(words) - n + 1):
                if n and tuple(words[s : s + n]) in windows:
                    hit.update(range(s, s + n))
                    names.add("" if item_id is None else str(item_id))
        out.append((doc_id, len(words), len(hit), sorted(names)))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in df.collect()), key=repr)


def noise(rng, n, vocabulary):
    return " ".join(rng.choice(vocabulary) for _ in range(n))


@pytest.mark.parametrize("seed,vocabulary", [(1, "a b c d".split()), (2, [f"w{i}" for i in range(60)]), (3, ["x"])])
def test_equals_a_plain_search(spark, seed, vocabulary):
    rng = random.Random(seed)
    items = [(i, noise(rng, rng.choice([0, 1, 2, 5, 9, 10, 11, 25]), vocabulary)) for i in range(25)]
    docs = []
    for i in range(60):
        parts = [noise(rng, rng.randrange(0, 30), vocabulary)]
        for _ in range(rng.randrange(3)):
            w = rng.choice(items)[1].split()
            a = rng.randrange(len(w) + 1)
            parts += [" ".join(w[a : a + rng.randrange(5, 30)]).upper() + ".", noise(rng, 8, vocabulary)]
        docs.append((i, " - ".join(parts)))
    for sent in (decontaminate.SENT_TERMS, 0):
        decontaminate.SENT_TERMS, kept = sent, decontaminate.SENT_TERMS
        got = decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, ITEMS))
        decontaminate.SENT_TERMS = kept
        assert found(got) == brute(docs, items)


def test_awkward_rows(spark):
    rows = [(r[0], r[1]) for r in awkward_rows()]
    items = [(1, rows[0][1]), (1, "one two"), (None, "É é Ünïcode text"), (None, None), (3, ""), (4, "..."), (5, "ONE"), (11, " ".join(rows[10][1].split()[500:600])), (6, "x" * 50_000)]
    frame = spark.createDataFrame(items, ITEMS)
    for docs in (awkward(spark), clashing(awkward(spark))):
        assert found(decontaminate.contamination(docs, frame.select("*", F.lit(1).alias("TEXT")))) == brute(rows, items)
    assert decontaminate.contamination(empty(spark), frame).count() == 0
    assert found(decontaminate.contamination(awkward(spark), spark.createDataFrame([], ITEMS))) == brute(rows, [])


@pytest.mark.parametrize("within", [0, 1, 3, 7])
def test_proximity_equals_a_plain_search(spark, within):
    rng = random.Random(within)
    vocabulary = [c for i, c in enumerate("abcdefgh") for _ in range(1 + i * i)]
    docs = [(i, noise(rng, rng.randrange(0, 60), vocabulary)) for i in range(40)]
    phrases = [(k, noise(rng, rng.randrange(1, 5), vocabulary).split()) for k in range(20)] + [(99, ["a", "nowhere"])]
    words = stored(decontaminate.training_words(spark.createDataFrame(docs, "doc_id long, text string")))
    got = decontaminate.proximity_matches(words, spark.createDataFrame(phrases, "phrase long, words array<string>"), within)
    got = sorted(tuple(r) for r in got.join(words.select("row", "doc_id"), "row").select("phrase", "doc_id", "at", "first", "last").collect())
    count = {t: sum(d.split().count(t) for _, d in docs) for t in set(vocabulary)}
    want = []
    for k, own in phrases:
        own = list(dict.fromkeys(own))
        if any(not count.get(t) for t in own):
            continue
        rare = min(own, key=lambda t: (count[t], own.index(t)))
        for i, text in docs:
            w = text.split()
            for at in (p for p, t in enumerate(w) if t == rare):
                near = [min(((abs(p - at), p) for p, x in enumerate(w) if x == t and abs(p - at) <= within), default=None) for t in own if t != rare]
                if all(near):
                    span = [at] + [p for _, p in near]
                    want.append((k, i, at, min(span), max(span)))
    assert got == sorted(want) and (want or not within)


def test_no_python_in_the_plan(spark):
    plan = decontaminate.contamination(awkward(spark), spark.createDataFrame([(1, "one two")], ITEMS))._jdf.queryExecution().toString()
    assert "Arrow" not in plan and "Python" not in plan
