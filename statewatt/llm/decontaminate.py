"""Benchmark passages in training text, by a positional inverted index.

Training texts are cut into words once and written down with a row number. The
occurrences of every test term are counted, and the postings (term, row, place)
of the rarest terms of each phrase are stored in ranges of the term, so a term
that a third of all words share is many ranges. A phrase is found by
intersecting the lists of its rarest terms, each shifted by the term's offset
in the phrase; what is left is compared with the words themselves. Phrases that
share their rarest terms at equal distances share one intersection.

Proximity search reads the same lists: an occurrence of the rarest term counts
if every other term has one near it. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statewatt.llm.common import lower_ascii, pick
from statewatt.session import stored

#: A word: a run of digits, letters a-z and characters beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words of a window; terms whose lists are intersected before the comparison.
WINDOW = 10
RAREST = 3
#: Up to so many test terms, or rows that hold a candidate, go to every executor
#: (some 100 MB); more are joined by a shuffle.
SENT_TERMS = 1_000_000


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; a null text has none."""
    return F.coalesce(F.regexp_extract_all(lower_ascii(text), F.lit(TERM), F.lit(0)), F.array().cast("array<string>"))


def training_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, doc_id, n_words, words), written down, so that row numbers stay.

    Rows alike are rows of their own; a null id is as good as any other.
    """
    few = pick(docs, id_col, text_col).toDF("doc_id", "text")
    few = few.select(F.monotonically_increasing_id().alias("row"), "doc_id", words_of(F.col("text")).alias("words"))
    return stored(few.select("row", "doc_id", F.size("words").cast("long").alias("n_words"), "words"))


def _each(words: DataFrame) -> DataFrame:
    return words.select("row", F.posexplode("words").alias("at", "term"))


def _sent(terms: DataFrame) -> DataFrame:
    """``terms``, or row numbers, for a join with all words: sent along if they are few."""
    return F.broadcast(terms) if terms.count() <= SENT_TERMS else terms


def term_counts(words: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, occurrences) of the listed terms (distinct) that occur."""
    return stored(_each(words).join(_sent(terms), "term").groupBy("term").agg(F.count("*").alias("occurrences")))


def postings(words: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, row, at): every occurrence of the listed terms (distinct), stored
    in order of the three."""
    order = ("term", "row", "at")
    lists = _each(words).join(_sent(terms), "term").select(*order)
    return stored(lists.repartitionByRange(*order).sortWithinPartitions(*order))


def windows_of(items: DataFrame, length: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, words): the windows of ``length`` words of every item; one with
    fewer words is a window as a whole, one with none has no window. Ids are
    strings, a null one the empty string."""
    few = pick(items, id_col, text_col).toDF("item", "text")
    few = few.select(F.coalesce(F.col("item").cast("string"), F.lit("")).alias("item"), words_of(F.col("text")).alias("all")).where(F.size("all") > 0)
    last = F.greatest(F.size("all") - length, F.lit(0))
    return few.select("item", "all", F.explode(F.sequence(F.lit(0), last)).alias("at")).select("item", F.slice("all", F.col("at") + 1, F.lit(length)).alias("words"))


def _ranked(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """(phrase, ranked): offsets and terms of each phrase, the rarest first.
    Phrases with a term that never occurs are gone."""
    terms = phrases.select("phrase", F.posexplode("words").alias("offset", "term")).join(counts, "term", "left")
    ranked = terms.groupBy("phrase").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("occurrences", F.lit(0)).alias("n"), "offset", "term"))).alias("ranked"))
    return ranked.where(F.col("ranked")[0]["n"] > 0)


def phrase_matches(words: DataFrame, phrases: DataFrame, rarest: int = RAREST) -> DataFrame:
    """(phrase, row, start, length): every place where a phrase (phrase, words)
    stands word for word in ``words`` of ``training_words``.

    ``phrase`` must be unique; a phrase has a word at least. Words and phrases
    are compared as they are, so both come from ``words_of``.
    """
    terms = stored(phrases.select(F.explode("words").alias("term")).distinct())
    ranked = _ranked(phrases, term_counts(words, terms))
    parts = F.slice("ranked", 1, rarest)
    first = F.col("ranked")[0]
    # how the other lists lie to the rarest term's: the same for many phrases
    probe = F.transform(parts, lambda p: F.struct((p["offset"] - first["offset"]).alias("shift"), p["term"].alias("term")))
    ranked = stored(ranked.select("phrase", first["offset"].alias("offset"), probe.alias("probe")))
    lists = postings(words, stored(ranked.select(F.explode("probe.term").alias("term")).distinct()))
    probes = stored(ranked.select("probe").distinct())
    found = lists.join(probes.withColumn("term", F.col("probe")[0]["term"]), "term").select("probe", "row", "at")
    for k in range(1, rarest):
        # a phrase of fewer terms meets its first list again
        part = F.coalesce(F.get("probe", F.lit(k)), F.col("probe")[0])
        wanted = found.withColumns({"_term": part["term"], "_at": F.col("at") + part["shift"]})
        other = lists.select(F.col("term").alias("_term"), "row", F.col("at").alias("_at"))
        found = wanted.join(other, ["_term", "row", "_at"], "left_semi").select("probe", "row", "at")
    starts = stored(found).join(ranked, "probe").select("phrase", "row", (F.col("at") - F.col("offset")).alias("start")).where("start >= 0")
    starts = stored(starts.join(phrases.select("phrase", F.col("words").alias("own")), "phrase"))
    same = F.slice("words", F.col("start") + 1, F.size("own")) == F.col("own")
    few = words.select("row", "words").join(_sent(starts.select("row").distinct()), "row", "left_semi")
    exact = few.join(starts, "row").where(same)
    return exact.select("phrase", "row", "start", F.size("own").alias("length"))


def proximity_matches(words: DataFrame, phrases: DataFrame, within: int) -> DataFrame:
    """(phrase, row, at, first, last): occurrences of each phrase's rarest term
    (of equally rare ones the earliest in the phrase) that have every other
    distinct term of it at most ``within`` words away, in any order, and the
    span from the first to the last of those nearest to it. Of two as near the
    one ahead counts.
    """
    distinct = phrases.select("phrase", F.array_distinct("words").alias("words"))
    terms = stored(distinct.select(F.explode("words").alias("term")).distinct())
    ranked = stored(_ranked(distinct, term_counts(words, terms)))
    lists = postings(words, stored(ranked.select(F.explode("ranked.term").alias("term")).distinct()))
    rare = lists.join(ranked.withColumn("term", F.col("ranked")[0]["term"]), "term")
    rare = rare.select("phrase", "row", "at", F.slice("ranked.term", 2, 1 << 30).alias("others"))
    alone = rare.where(F.size("others") == 0).select("phrase", "row", "at", F.col("at").alias("first"), F.col("at").alias("last"))
    # places in steps of ``within``: what is near lies in the same step or one beside it
    step = F.floor(F.col("at") / max(within, 1))
    asked = rare.select("phrase", "row", "at", F.size("others").alias("terms"), F.explode("others").alias("term"), step.alias("own"))
    asked = asked.select("phrase", "row", "at", "terms", "term", F.explode(F.array(F.col("own") - 1, F.col("own"), F.col("own") + 1)).alias("step"))
    other = lists.select("term", "row", F.col("at").alias("near"), step.alias("step"))
    apart = F.abs(F.col("near") - F.col("at"))
    met = asked.join(other, ["term", "row", "step"]).where(apart <= within)
    met = met.groupBy("phrase", "row", "at", "terms", "term").agg(F.min(F.struct(apart.alias("apart"), "near"))["near"].alias("near"))
    met = met.groupBy("phrase", "row", "at", "terms").agg(F.count("*").alias("n"), F.min("near").alias("low"), F.max("near").alias("high")).where("n = terms")
    return met.select("phrase", "row", "at", F.least("at", "low").alias("first"), F.greatest("at", "high").alias("last")).unionAll(alone)


def contamination(docs: DataFrame, benchmark: DataFrame, length: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit (words inside a window
    of some item), items (ids of the items that have a window there, as sorted
    strings).

    Null and empty texts have no words and no hits; items that share an id are
    one item. An empty benchmark hits nothing.
    """
    words = training_words(docs, id_col, text_col)
    windows = stored(windows_of(benchmark, length, item_col, item_text_col).distinct())
    phrases = stored(windows.select("words").distinct().select(F.monotonically_increasing_id().alias("phrase"), "words"))
    matches = stored(phrase_matches(words, phrases))
    places = matches.select("row", "start", "length").distinct()
    places = places.select("row", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("at")).distinct()
    hits = places.groupBy("row").agg(F.count("*").alias("n_hit"))
    named = matches.select("row", "phrase").distinct().join(phrases, "phrase").select("row", "words").join(windows, "words").select("row", "item").distinct()
    items = named.groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    told = words.select("row", "doc_id", "n_words").join(hits.join(items, "row"), "row", "left")
    return told.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
