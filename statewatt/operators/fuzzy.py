"""Best fuzzy match of names against a list of choices."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statewatt.functions import normalised_text, token_sorted
from statewatt.functions.similarity import WORD, ChoiceBlock, similarity
from statewatt.session import stored

NAMES_PER_TASK = 2_000
CHOICES_PER_TASK = 20_000
_MATCH_SCHEMA = "name string, match string, score double, ordinal long"


#: From this score on, names meet the choices they share rare pairs of characters with;
#: a lower threshold scans choices for the names that are left.
SIGNED_FROM = 80.0
#: Longest text that is keyed by two such pairs at once; longer ones are keyed by one.
PAIRED = 48

#: Names and choices are banded by length; a band's longest is at most this
#: many times its shortest.
BAND = 1.15


def _banded(df: DataFrame) -> DataFrame:
    n = F.length("sorted")
    return df.withColumns({"_n": n, "_band": F.floor(F.log(n + F.lit(1.0)) / math.log(BAND)).cast("int")})


def _bands(df: DataFrame) -> list:
    """(band, rows, shortest, longest); as many rows as lengths have bands."""
    counts = df.groupBy("_band").agg(F.count(F.lit(1)).alias("rows"), F.min("_n").alias("low"), F.max("_n").alias("high"))
    return sorted(counts.collect(), key=lambda r: r["_band"])


def _blocks_of(bands: list, size: int) -> dict[int, range]:
    """Block numbers of each band: blocks of at most ``size`` machine words."""
    out, at = {}, 0
    for r in bands:
        n = max(1, math.ceil(r["rows"] * max(1, math.ceil(r["high"] / WORD)) / size))
        out[r["_band"]] = range(at, at + n)
        at += n
    return out


def _reach(a, b) -> float:
    """The highest score that lengths of the two bands allow."""
    if a["high"] >= b["low"] and b["high"] >= a["low"]:
        return 100.0
    short, long = (a["high"], b["low"]) if a["high"] < b["low"] else (b["high"], a["low"])
    return 200 * short / (short + long)


def _dealt(df: DataFrame, own: str, other: str, blocks: dict[int, range], partners: dict[int, list[range]]) -> DataFrame:
    """Each row in its own block, once for every block it is to meet."""
    rows = [(band, r.start, len(r), [(p.start, p.stop - 1) for p in partners[band]]) for band, r in blocks.items() if partners[band]]
    shape = "_band int, _first int, _count int, _meets array<struct<low: int, high: int>>"
    table = F.broadcast(df.sparkSession.createDataFrame(rows, shape))  # a row for each band
    met = F.flatten(F.transform("_meets", lambda p: F.sequence(p["low"], p["high"])))
    place = F.col("_first") + F.pmod(F.xxhash64("sorted"), F.col("_count")).cast("int")
    return df.join(table, "_band").select(*[c for c in df.columns if c not in ("_n", "_band")], place.alias(own), F.explode(met).alias(other))


def _best_in_block(threshold: float):
    def best(names: pd.DataFrame, choices: pd.DataFrame) -> pd.DataFrame:
        if names.empty or choices.empty:
            return pd.DataFrame({"name": [], "match": [], "score": [], "ordinal": []})
        block = ChoiceBlock(choices["sorted"].tolist(), choices["ordinal"].tolist())
        rows = []
        for name, text in zip(names["name"], names["sorted"]):
            hit = block.best(text, threshold)
            if hit is not None:
                i, score = hit
                rows.append((name, choices["choice"].iat[i], score, int(choices["ordinal"].iat[i])))
        return pd.DataFrame(rows, columns=["name", "match", "score", "ordinal"])

    return best


def _numbered(pieces: Sequence[str]) -> list[str]:
    """A multiset as a set: each piece with its occurrence."""
    seen: dict[str, int] = {}
    out = []
    for piece in pieces:
        seen[piece] = seen.get(piece, 0) + 1
        out.append(f"{piece}{seen[piece]}")
    return out


@F.pandas_udf(T.ArrayType(T.StringType()))
def _characters(texts: pd.Series) -> pd.Series:
    return texts.map(_numbered)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _neighbours(texts: pd.Series) -> pd.Series:
    """Adjacent characters, the ends of the text included."""
    return texts.map(lambda t: _numbered([x + y for x, y in zip("\x02" + t, t + "\x03")]))


@F.pandas_udf(T.DoubleType())
def _similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([similarity(x, y) for x, y in zip(a, b)], dtype=float)


def _with_rarity(texts: DataFrame, counts: DataFrame) -> DataFrame:
    """``texts`` with the neighbours that ``counts`` knows, the rarest first."""
    known = texts.select("id", F.explode("pairs").alias("pair")).join(counts, "pair")
    ranked = known.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "pair"))), lambda e: e["pair"]).alias("ranked"))
    return texts.select("id", "size").join(ranked, "id")


def _signed(texts: DataFrame, t: float) -> DataFrame:
    """(id, size, key): what any two texts that score t have in common.

    Let s be the length of both together. If they score t, their longest common
    subsequence holds t * s / 2 characters or more, and only the others, (1 - t) * s
    at most, can part two that are neighbours in it. So, ends counted, they share
    (1.5 * t - 1) * s + 1 pairs of neighbours, ``least`` for the shortest partner.
    Of a text's pairs, rarest first, one that is shared stands among the first
    (known - least + 1), and two stand among one more. Texts that may share one pair
    only, or with a partner longer than ``PAIRED``, are keyed by one, all up to
    ``PAIRED`` by two.
    """
    least = F.ceil(F.col("size") * ((1.5 * t - 1) * 2 / (2 - t)) + 1 - 1e-9)
    spare = F.size("ranked") - least  # below zero: no partner at all
    ones = F.transform(F.slice("ranked", 1, F.greatest(spare + 1, F.lit(0)).cast("int")), lambda c: F.xxhash64(c))
    first = F.slice("ranked", 1, F.greatest(spare + 2, F.lit(0)).cast("int"))
    twos = F.flatten(F.transform(first, lambda c, i: F.transform(F.slice(first, i + 2, F.size(first)), lambda d: F.xxhash64(c, d))))
    none = F.array().cast("array<bigint>")
    single = F.when((least < 2) | (F.col("size") > math.floor(PAIRED * t / (2 - t))), ones).otherwise(none)
    double = F.when(F.col("size") <= PAIRED, twos).otherwise(none)
    return texts.select("id", "size", F.explode(F.array_distinct(F.concat(single, double))).alias("key"))


def candidate_pairs(names: DataFrame, options: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs (name_id, option_id) that may reach ``threshold``, each once, and the
    two tables with their ids and pieces; both come with ``sorted``.

    No pair that reaches the threshold is missing, which must be above 67.
    """
    t = min(threshold, 100.0) / 100
    sides = []
    for df in (names, options):
        numbered = df.select("*", F.monotonically_increasing_id().alias("id"), F.length("sorted").alias("size"), _characters("sorted").alias("chars"), _neighbours("sorted").alias("pairs"))
        sides.append(stored(numbered.filter("size > 0")))
    counts = sides[1].select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    signed = [_signed(_with_rarity(side, counts), t) for side in sides]
    a, b = (s.select(F.col("id").alias(i), F.col("size").alias(n), "key") for s, i, n in zip(signed, ("name_id", "option_id"), ("_m", "_n")))
    near = 2 * F.least("_m", "_n") >= t * (F.col("_m") + F.col("_n")) - 1e-9
    return a.join(b, "key").filter(near).select("name_id", "option_id").distinct(), sides[0], sides[1]


def _signed_matches(names: DataFrame, options: DataFrame, threshold: float) -> DataFrame:
    """(name, match, score, ordinal) of all pairs at or above the threshold: by
    signature, then by how many characters and neighbours they share, then by the score."""
    pairs, left, right = candidate_pairs(names, options, threshold)
    left = left.select(F.col("id").alias("name_id"), "name", F.col("sorted").alias("_a"), F.col("chars").alias("_ca"), F.col("pairs").alias("_pa"))
    right = right.select(F.col("id").alias("option_id"), "choice", "ordinal", F.col("sorted").alias("_b"), F.col("chars").alias("_cb"), F.col("pairs").alias("_pb"))
    both = pairs.join(left, "name_id").join(right, "option_id")
    t, size = min(threshold, 100.0) / 100, F.size("_ca") + F.size("_cb")
    both = both.filter(2.0 * F.size(F.array_intersect("_ca", "_cb")) >= t * size - 1e-6)
    both = both.filter(F.size(F.array_intersect("_pa", "_pb")) >= (1.5 * t - 1) * size + 1 - 1e-6)
    scored = both.select("name", F.col("choice").alias("match"), _similarity("_a", "_b").alias("score"), "ordinal")
    return scored.filter(F.col("score") >= threshold)


def _scanned(rest: DataFrame, options: DataFrame, threshold: float) -> DataFrame:
    """(name, match, score, ordinal): best of each name in each block of choices
    whose lengths allow the threshold."""
    name_bands, choice_bands = _bands(rest), _bands(options)
    # small blocks while cores would idle, blocks of a bounded size beyond that
    rows = sum(r["rows"] for r in name_bands)
    per_task = min(NAMES_PER_TASK, max(100, rows // rest.sparkSession.sparkContext.defaultParallelism))
    name_blocks, choice_blocks = _blocks_of(name_bands, per_task), _blocks_of(choice_bands, CHOICES_PER_TASK)
    near = [(a["_band"], b["_band"]) for a in name_bands for b in choice_bands if _reach(a, b) >= threshold]
    placed_names = _dealt(rest, "_nb", "_cb", name_blocks, {a: [choice_blocks[c] for n, c in near if n == a] for a in name_blocks})
    placed_options = _dealt(options, "_cb", "_nb", choice_blocks, {b: [name_blocks[n] for n, c in near if c == b] for b in choice_blocks})
    return placed_names.groupBy("_nb", "_cb").cogroup(placed_options.groupBy("_nb", "_cb")).applyInPandas(_best_in_block(threshold), _MATCH_SCHEMA)


def fuzzy_best_match(
    left: DataFrame,
    name: str,
    choices: DataFrame,
    choice: str,
    ordinal: str,
    threshold: float = 60.0,
    match_out: str = "match",
    score_out: str = "score",
    strip_punct: bool = False,
) -> DataFrame:
    """``left`` with the normalised choice that scores highest for each name.

    Equal scores go to the lowest ordinal; below the threshold the match is
    NULL. Names are compared upper-cased and stripped, ``strip_punct`` also
    blanks out everything but letters and digits.

    Names whose sorted words equal a choice's are settled by an equi-join. The
    others meet the choices with which they share the rare pairs of neighbouring
    characters that a score of ``SIGNED_FROM``, or of a higher threshold, asks for: an
    equi-join too, and no such pair is missed. Only for a lower threshold are the names still without
    a match scored against all choices whose length allows it, block by block,
    each pair of blocks in one task that returns one row per name at most.
    """

    def cleaned(c: str):
        text = normalised_text(c)
        return normalised_text(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " ")) if strip_punct else text

    names = left.select(cleaned(name).alias("name")).filter(F.col("name").isNotNull()).distinct()
    options = (
        choices.select(cleaned(choice).alias("choice"), F.col(ordinal).cast("long").alias("ordinal"))
        .filter(F.col("choice").isNotNull())
        .groupBy("choice")
        .agg(F.min("ordinal").alias("ordinal"))
    )
    names = names.withColumn("sorted", token_sorted("name"))
    options = stored(_banded(options.withColumn("sorted", token_sorted("choice"))))
    equal = options.groupBy("sorted").agg(F.min_by(F.struct("choice", "ordinal"), "ordinal").alias("_equal"))
    names = stored(_banded(names.join(equal, "sorted", "left")))
    alike = F.lit(threshold <= 100) & F.col("_equal").isNotNull()
    settled = names.filter(alike).select("name", F.col("_equal.choice").alias("match"), F.lit(100.0).alias("score"), "_equal.ordinal")
    rest = names.filter(~alike).drop("_equal")

    hit = _signed_matches(rest, options, max(threshold, SIGNED_FROM))
    if threshold < SIGNED_FROM:
        # a name with a match up there has its best one there
        best = F.max_by(F.struct("match", "score", "ordinal"), F.struct(F.col("score"), -F.col("ordinal")))
        hit = stored(hit.groupBy("name").agg(best.alias("_hit")).select("name", "_hit.*"))
        left_over = stored(rest.join(hit.select("name"), "name", "left_anti"))
        hit = hit.unionByName(_scanned(left_over, options, threshold))
    scored = hit.select("name", "match", "score", "ordinal")

    found = (
        scored.union(settled)
        .groupBy("name")
        .agg(F.max_by(F.struct("match", "score"), F.struct(F.col("score"), -F.col("ordinal"))).alias("_hit"))
        .select(F.col("name").alias("_name"), F.col("_hit.match").alias(match_out), F.col("_hit.score").alias(score_out))
    )
    return (
        left.withColumn("_key", cleaned(name))
        .join(found, F.col("_key") == F.col("_name"), "left")
        .select(*left.columns, match_out, score_out)
    )


def match_report(df: DataFrame, name: str, match: str) -> DataFrame:
    """Per name: its match, whether it has one, and how many names share it."""
    names = df.select(name, match).distinct()
    shared = names.filter(F.col(match).isNotNull()).groupBy(F.struct(match).alias("_key")).agg(F.count(F.lit(1)).alias("names_on_match"))
    # unmatched names get a key of their own, so that they do not all meet in
    # the partition of the NULL key
    spread = F.struct(F.coalesce(match, F.concat(F.lit("\0"), name)).alias(match))
    return names.withColumn("_key", spread).join(shared, "_key", "left").select(
        name,
        match,
        F.when(F.col(match).isNull(), "unmatched").otherwise("matched").alias("status"),
        F.coalesce("names_on_match", F.lit(0)).cast("long").alias("names_on_match"),
    )


def attach_matches(
    master: DataFrame,
    master_name: str,
    matched: DataFrame,
    match: str,
    measures: Sequence[str],
) -> DataFrame:
    """Master rows with whole-number measures of the names matched to them.

    Several names on one master row repeat it; a master row without a match
    gets 0.
    """
    right = matched.filter(F.col(match).isNotNull()).select(F.col(match).alias("_match"), *measures)
    joined = master.withColumn("_key", normalised_text(master_name)).join(right, F.col("_key") == F.col("_match"), "left")
    whole = {m: F.coalesce(F.col(m), F.lit(0)).cast("long") for m in measures}
    return joined.withColumns(whole).drop("_key", "_match")
