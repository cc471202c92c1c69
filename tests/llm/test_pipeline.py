"""The stages one after the other against plain Python on a small table."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from cases import DOCS, awkward_rows, empty
from statewatt.llm import mixing, toxicity
from test_packing import check
from test_simhash import brute_fp, brute_roots

pipeline = pytest.importorskip("corpus_pipeline", reason="deleted with the operators")


def corpus():
    rng, rows, labels = random.Random(9), awkward_rows(), []
    for i in range(1000, 1300):
        own = [f"w{rng.randrange(900)}" for _ in range(rng.randrange(20, 120))]
        toxic = rng.random() < 0.2
        if toxic:
            own[3:3] = ["vile", "foul", "horrid"]
        rows.append((i, " ".join(own), "en", f"s{i % 4}", 0))
        labels.append((i, 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("corpus"))
    rows, labels = corpus()
    spark.createDataFrame(rows, DOCS).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


def norm(t):
    return (t or "").encode().lower()


def test_each_stage_against_plain_python(spark, folder, tmp_path):
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "exact dedup", "simhash near-dedup", "source mixing", "packing"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, docs.collect()
    for k, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, folder)
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        after = docs.collect()
        if name != "packing":
            assert docs.columns == columns
        if name == "toxicity":
            rate = toxicity.fit(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")).scorer()
            assert Counter(after) == Counter(r for r in before if rate(r["text"]) < 0.5)
            gone = {r["doc_id"] for r in before} - {r["doc_id"] for r in after}
            assert gone == {i for i, _, t in corpus()[1] if t}
        elif name == "exact dedup":
            best = {}
            for r in before:
                if norm(r["text"]) not in best or (r["doc_id"] is not None and (best[norm(r["text"])] is None or r["doc_id"] > best[norm(r["text"])])):
                    best[norm(r["text"])] = r["doc_id"]
            assert {norm(r["text"]): r["doc_id"] for r in after} == best and len(after) == len(best)
        elif name == "simhash near-dedup":
            roots = brute_roots({brute_fp(r["text"]) for r in before}, 3)
            least = {}
            for r in before:
                least.setdefault(roots[brute_fp(r["text"])], []).append(r["doc_id"])
            want = sorted((min((i for i in ids if i is not None), default=-1) for ids in least.values()))
            assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in after) == want
        elif name == "source mixing":
            want = Counter()
            for r in mixing.mix(spark.read.parquet(f"{tmp_path}/{k - 1}")).where("size > 0").collect():
                whole, part = divmod(r["taken"], r["size"])
                want[r["doc_id"]] += whole + (2 * part >= r["size"] if part else 0)
            assert Counter(r["doc_id"] for r in after) == +want
        else:
            check(after, before, 4096)
        before = after
    assert Counter(r["doc_id"] for r in pipeline.run(spark, folder).collect()) == Counter(r["doc_id"] for r in after)


def test_stages_take_empty_and_odd_tables(spark, folder, tmp_path):
    for n, docs in enumerate((empty(spark), spark.createDataFrame([(None, None, None, None, None)] * 3 + [(1, "", None, None, 0)], DOCS))):
        for k, (_, stage) in enumerate(pipeline.STAGES):
            out = stage(spark, docs, folder)
            out.write.parquet(f"{tmp_path}/{n}-{k}")
            docs = spark.read.parquet(f"{tmp_path}/{n}-{k}")
        assert docs.count() == 0
