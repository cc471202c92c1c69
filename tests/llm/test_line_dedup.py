from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest

from cases import awkward, awkward_rows, clashing, empty
from statewatt.llm import line_dedup

DOCS = "doc_id long, text string, source string"


def norm(line):
    return re.sub(r"[\x09-\x0D\x20]+", " ", re.sub("[A-Z]+", lambda m: m[0].lower(), line)).strip(" ")


def brute(rows, min_sites):
    sites = defaultdict(set)
    for _, text, site in rows:
        for line in (text or "").split("\n"):
            if norm(line) and site is not None:
                sites[norm(line)].add(site)
    out = Counter()
    for i, text, _ in rows:
        lines = [] if text is None else text.split("\n")
        kept = [x for x in lines if not norm(x) or len(sites[norm(x)]) < min_sites]
        out[i, len(lines), len(lines) - len(kept), None if text is None else "\n".join(kept)] += 1
    return out


def lines_table():
    rows = []
    for i in range(60):
        site = f"s{i % 15}" if i % 7 else None
        own = [f"only in {i}", "Everywhere,  the\tsame ", f"on some {i % 4}", "", "  ", "x" * 5000 if i == 3 else "all Rights"]
        rows.append((i if i % 11 else None, "\n".join(own[: 2 + i % 5]), site))
    return rows + rows[:3] + [(900, None, "s1"), (901, "", "s2"), (902, "\n\n", "s3"), (903, "Everywhere, the same", "s4")]


@pytest.mark.parametrize("min_sites", [1, 3, 10])
def test_is_brute_force(spark, min_sites):
    docs = spark.createDataFrame(lines_table(), DOCS).repartition(4)
    assert Counter(map(tuple, line_dedup.drop_boilerplate(docs, min_sites=min_sites).collect())) == brute(lines_table(), min_sites)


def test_awkward_rows(spark):
    rows = [(i, t, s) for i, t, _, s, _ in awkward_rows()]
    assert Counter(map(tuple, line_dedup.drop_boilerplate(clashing(awkward(spark)), min_sites=2).collect())) == brute(rows, 2)


def test_estimates_decide_far_from_the_threshold(spark):
    rows = [("a", f"s{i}") for i in range(5000)] + [("b", f"s{i % 950}") for i in range(3000)] + [("c", f"s{i}") for i in range(700)]
    lines = spark.createDataFrame(rows, "hash string, site string")
    found = {r["hash"]: r["sites"] for r in line_dedup.line_spread(lines, 1000).collect()}
    assert set(found) == {"a"} and abs(found["a"] - 5000) < 400
    found = {r["hash"]: r["sites"] for r in line_dedup.line_spread(lines, 950).collect()}
    assert found["b"] == 950


def test_empty_table(spark):
    assert line_dedup.drop_boilerplate(empty(spark)).count() == 0


def test_no_python_on_the_path(spark):
    plan = line_dedup.drop_boilerplate(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|InArrow|UDF", plan)
