from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from cases import awkward, awkward_rows, clashing, empty
from statewatt.llm import toxicity

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=1800, seed=8):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.15
        own = [f"w{int(rng.paretovariate(0.7)) % 3000}" for _ in range(rng.randrange(20, 200))]
        if toxic:
            for _ in range(1 + len(own) // 30):
                own.insert(rng.randrange(len(own)), rng.choice(["vile", "FOUL!", "horrid,", "grimm" + rng.choice("abcdefgh")]))
        docs.append((i, " ".join(own), "en", "s", 0))
        if rng.random() < 0.6:
            labels.append((i, 1, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def learnt(spark):
    docs, labels = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    return d, labels, toxicity.fit(d, spark.createDataFrame(labels, LABELS))


def test_held_out_accuracy(learnt):
    docs, labels, model = learnt
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores.values())
    held = [(i, t) for i, _, t in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    hit = sum(scores[i] >= 0.5 for i, t in held if t)
    assert hit / sum(t for _, t in held) > 0.9
    assert sum(scores[i] >= 0.5 for i, t in held if not t) <= 0.02 * len(held)


def test_labels_of_the_held_out_fifth_are_not_learnt(spark, learnt):
    docs, labels, model = learnt
    other = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    again = toxicity.fit(docs, spark.createDataFrame(other, LABELS))
    assert again.weights == pytest.approx(model.weights) and again.offset == pytest.approx(model.offset)


def test_only_the_text_decides(learnt, spark):
    docs, _, model = learnt
    moved = docs.selectExpr("doc_id + 7 as doc_id", "text", "'xx' as lang", "'t' as source", "n_chars")
    a = {r["doc_id"] + 7: r["score"] for r in toxicity.score(docs, model).collect()}
    assert a == {r["doc_id"]: r["score"] for r in toxicity.score(moved, model).collect()}


def test_awkward_rows_and_labels(spark, learnt):
    *_, model = learnt
    docs = clashing(awkward(spark))
    found = [r["score"] for r in toxicity.score(docs, model).collect()]
    assert len(found) == len(awkward_rows()) and all(0 <= s <= 1 for s in found)
    kept = toxicity.clean(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(s < 0.5 for s in found)
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (None, 1, 1), (3, None, None), (4, 1, 1), (5, 1, 0), (99999, 1, 1)], LABELS)
    assert toxicity.score(docs, toxicity.fit(docs, labels)).count() == len(awkward_rows())


def test_empty_tables(spark, learnt):
    docs, labels, model = learnt
    none = spark.createDataFrame([], LABELS)
    assert toxicity.score(empty(spark), model).count() == 0 and toxicity.clean(empty(spark), model).count() == 0
    assert toxicity.fit(docs, none) == toxicity.Model({}, -1.0)
    assert toxicity.fit(empty(spark), none).weights == {}


def test_the_unlabelled_risk_is_not_negative():
    """Few positives that a model could learn by heart: with the correction
    plain rows that look like them keep a middling score."""
    toxic = toxicity.Rows.of([np.array([0, 5 + i]) for i in range(10)])
    plain = toxicity.Rows.of([np.array([0, 20 + i]) if i % 5 == 0 else np.array([1, 20 + i]) for i in range(200)])
    w = toxicity.fit_nnpu(toxic, plain, 0.2, 300)
    assert (toxic.dot(w[:-1]) + w[-1] > 0).all()
    z = plain.dot(w[:-1]) + w[-1]
    assert (z[::5] > 0).mean() > 0.9 and (z[1::5] < 0).all()
