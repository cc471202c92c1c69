from __future__ import annotations

import random

import pytest

from statewatt import operators as op
from statewatt.functions import token_sorted
from statewatt.functions.similarity import ChoiceBlock, lcs_length, similarity
from statewatt.operators import fuzzy


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def plain_sorted(text):
    return " ".join(sorted(text.upper().strip().split()))


def test_lcs():
    assert lcs_length("ABCBDAB", "BDCABA") == 4
    rnd = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rnd.choices("abcd é", k=rnd.randint(0, 90))) for _ in range(2))
        assert lcs_length(a, b) == plain_lcs(a, b)
    assert similarity("", "") == 100.0 and similarity("a", "") == 0.0


def test_long_and_empty_choices():
    rnd = random.Random(4)
    texts = ["".join(rnd.choices("abc de", k=n)) for n in (0, 1, 63, 64, 65, 64, 130, 200, 65)]
    ordinals = [8, 7, 6, 5, 4, 3, 2, 1, 0]
    block = ChoiceBlock(texts, ordinals)
    for name in ["", "a", *texts, *("".join(rnd.choices("abc dez", k=rnd.randint(1, 150))) for _ in range(60))]:
        scores = [similarity(name, t) for t in texts]
        expected = min((o, i) for i, o in enumerate(ordinals) if scores[i] == max(scores))[1]
        assert block.best(name, 0.0) == (expected, max(scores))


def test_block_choice_equals_a_full_scan():
    rnd = random.Random(2)
    words = ["".join(rnd.choices("abcdefgh", k=rnd.randint(2, 7))) for _ in range(30)]
    choices = [" ".join(sorted(rnd.choices(words, k=rnd.randint(1, 4)))) for _ in range(200)]
    ordinals = list(range(200))
    rnd.shuffle(ordinals)
    block = ChoiceBlock(choices, ordinals)
    for _ in range(200):
        name = " ".join(sorted(rnd.choices(words, k=rnd.randint(1, 4))))
        scores = [similarity(name, c) for c in choices]
        best = max(scores)
        expected = None if best < 60 else min((o, i) for i, o in enumerate(ordinals) if scores[i] == best)[1]
        got = block.best(name, 60)
        assert (got and got[0]) == expected and (got is None or got[1] == best)


def test_token_sort(spark):
    df = spark.createDataFrame([("  b \t a  c",), ("one",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(token_sorted("t")).collect()] == ["a b c", "one", "", None]


@pytest.fixture
def choices(spark):
    data = [("Coop Electric Texas", 2), (" electric coop texas ", 1), ("abcdef", 3), ("UVWXYZ power", 4), (None, 0)]
    return spark.createDataFrame(data, "firm string, place long")


def test_ties_threshold_and_cleaning(spark, choices):
    left = spark.createDataFrame([("Texas  Electric Coop",), ("abcxyz",), ("abcdxyz",), ("qqq",), (None,), ("TEXAS ELECTRIC COOP",)], "name string")
    got = {r.name: (r.match, r.score) for r in op.fuzzy_best_match(left, "name", choices, "firm", "place").collect()}
    # both Texas firms score 100: the earlier place wins
    assert got["Texas  Electric Coop"] == ("ELECTRIC COOP TEXAS", 100.0) == got["TEXAS ELECTRIC COOP"]
    assert got["abcxyz"] == (None, None)  # 3 of 6 letters: 50
    assert got["abcdxyz"] == ("ABCDEF", pytest.approx(200 * 4 / 13))
    assert got["qqq"] == (None, None) and got[None] == (None, None)


def test_a_score_exactly_at_the_threshold_matches(spark):
    left = spark.createDataFrame([("abcqq",), ("abqqq",)], "name string")
    choices = spark.createDataFrame([("abczz", 1)], "firm string, place long")
    got = {r.name: r.score for r in op.fuzzy_best_match(left, "name", choices, "firm", "place", 60.0).collect()}
    assert got == {"abcqq": 60.0, "abqqq": None}


def test_punctuation_option(spark):
    left = spark.createDataFrame([("A.B-C, Inc.",)], "name string")
    choices = spark.createDataFrame([("inc c b a", 1)], "firm string, place long")
    assert op.fuzzy_best_match(left, "name", choices, "firm", "place", 95.0).first().match is None
    assert op.fuzzy_best_match(left, "name", choices, "firm", "place", 95.0, strip_punct=True).first().match == "INC C B A"


def test_blocks_do_not_change_the_result(spark, monkeypatch, rows):
    rnd = random.Random(3)
    words = ["".join(rnd.choices("abcdef", k=5)) for _ in range(20)]
    names = [(" ".join(rnd.choices(words, k=3)),) for _ in range(120)] + [("hot name here",)] * 60
    firms = [(" ".join(rnd.choices(words, k=3)), i) for i in range(90)]
    left = spark.createDataFrame(names, "name string")
    choices = spark.createDataFrame(firms, "firm string, place long")
    whole = rows(op.fuzzy_best_match(left, "name", choices, "firm", "place"))
    assert len(whole) == 180
    for name, match, score in whole:
        scored = [(similarity(plain_sorted(name), plain_sorted(f)), -p, f) for f, p in firms]
        best = max(scored)
        assert (match, score) == ((best[2].upper(), best[0]) if best[0] >= 60 else (None, None))
    monkeypatch.setattr(fuzzy, "NAMES_PER_TASK", 17)
    monkeypatch.setattr(fuzzy, "CHOICES_PER_TASK", 11)
    assert rows(op.fuzzy_best_match(left, "name", choices, "firm", "place")) == whole


def random_names(rnd, n, words):
    names = []
    for _ in range(n):
        text = list(" ".join(rnd.choices(words, k=rnd.choice([1, 2, 3, 3, 4]))))
        for _ in range(rnd.choice([0, 0, 1, 3])):
            text[rnd.randrange(len(text))] = rnd.choice("abcdefghijklmnopqrstuvwxyz ")
        names.append("".join(text))
    return names


@pytest.mark.parametrize("threshold", [60.0, 80.0, 92.5, 100.0, 101.0])
def test_signatures_lose_no_match(spark, threshold, rows):
    rnd = random.Random(int(threshold))
    words = ["".join(rnd.choices("aaeeiioobcdfghklmnprstuvwxyz", k=rnd.randrange(1, 9))) for _ in range(40)]
    names = random_names(rnd, 150, words) + ["a", "b", "ab", "", " ", "x" * 300, "xy" * 40, "ab " * 30]
    firms = random_names(rnd, 200, words) + ["a", "ba", "abc", "c", "", "x" * 290, "xy" * 41, "yx" * 30, "ba " * 25]
    left = spark.createDataFrame([(n,) for n in names], "name string")
    choices = spark.createDataFrame([(f, i) for i, f in enumerate(firms)], "firm string, place long")
    for name, match, score in rows(op.fuzzy_best_match(left, "name", choices, "firm", "place", threshold)):
        best = max((similarity(plain_sorted(name), plain_sorted(f)), -i, f) for i, f in enumerate(firms))
        want = (best[2].strip().upper(), best[0]) if best[0] >= threshold else (None, None)
        assert (match, score) == want, name


def test_few_pairs_meet(spark):
    """At 80 the pairs that are looked at are a small share of names times choices."""
    rnd = random.Random(11)
    words = ["".join(rnd.choices("eeeeaaaiiooottnnssrrhhlldcumfpgwybvkxjqz", k=rnd.randrange(3, 10))) for _ in range(4000)]
    looked = {}
    for n in (400, 1600):
        sides = []
        for column in ("name", "choice"):
            texts = [(" ".join(sorted(rnd.choices(words, k=3))).upper(),) for _ in range(n)]
            sides.append(spark.createDataFrame(texts, f"{column} string").selectExpr("*", f"{column} AS sorted"))
        looked[n] = fuzzy.candidate_pairs(*sides, 80.0)[0].count() / n**2
    assert max(looked.values()) < 0.1


def test_report_and_attachment(spark, rows):
    matched = spark.createDataFrame([("a", "X", 3, 7.9), ("b", "X", 1, None), ("c", None, 9, 9.0)], "name string, match string, n long, area double")
    assert rows(op.match_report(matched, "name", "match")) == sorted(
        [("a", "X", "matched", 2), ("b", "X", "matched", 2), ("c", None, "unmatched", 0)], key=lambda t: t[0]
    )
    master = spark.createDataFrame([(1, " x"), (2, "y"), (3, "X")], "id int, firm string")
    got = rows(op.attach_matches(master, "firm", matched, "match", ["n", "area"]), "id", "n", "area")
    assert got == [(1, 1, 0), (1, 3, 7), (2, 0, 0), (3, 1, 0), (3, 3, 7)]
