"""Cross-site boilerplate lines, by how many sites a line is spread over.

Every line is hashed; a HyperLogLog sketch per hash counts its sites and merges
by aggregation, so a line that a third of the documents share is one sketch per
task before it moves. Lines whose estimate is near the threshold get an exact
distinct count. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statewatt.llm.common import cut, lower_ascii, pick

#: A line on so many sites is boilerplate.
MIN_SITES = 10
#: Log2 of a sketch's registers, and how near an estimate must be to be counted
#: exactly: the relative standard error at 2^12 is 1.6 percent, the band six times that.
LOG_REGISTERS = 12
BAND = 0.1


def normalised(line: Column) -> Column:
    """A-Z lower-cased, runs of white space one space, none at the ends."""
    return F.trim(F.regexp_replace(lower_ascii(line), r"[\x09-\x0D\x20]+", " "))


def _lines(docs: DataFrame) -> DataFrame:
    each = docs.select("key", "site", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    each = each.withColumn("line", normalised(F.col("line"))).where(F.col("line") != "")
    return each.select("key", "site", "at", F.unhex(F.md5(F.col("line").cast("binary"))).alias("hash"))


def line_spread(lines: DataFrame, min_sites: int = MIN_SITES, band: float = BAND) -> DataFrame:
    """(hash, sites) of every line hash on ``min_sites`` sites or more, of rows
    (hash, site). ``sites`` is exact near the threshold, an estimate above it."""
    sketch = lines.groupBy("hash").agg(F.hll_sketch_agg("site", LOG_REGISTERS).alias("sketch"))
    spread = sketch.select("hash", F.hll_sketch_estimate("sketch").alias("estimate")).where(F.col("estimate") >= min_sites * (1 - band))
    spread = cut(spread)
    far = F.col("estimate") > min_sites * (1 + band)
    sites = lines.where(F.col("site").isNotNull()).distinct()  # before it moves by hash: a line's rows are as many as its sites
    near = sites.join(spread.where(~far).select("hash"), "hash", "left_semi")
    exact = near.groupBy("hash").agg(F.count("*").alias("sites")).where(F.col("sites") >= min_sites)
    return spread.where(far).select("hash", F.col("estimate").alias("sites")).unionAll(exact)


def drop_boilerplate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """doc_id, n_lines, n_removed and text without boilerplate lines, one row
    per row of ``docs``.

    Lines end at line feeds; they are compared normalised, and blank ones never
    count nor go. A null site is no site; a null text stays null with no lines.
    A line that repeats within a site counts once there, and every occurrence
    of a boilerplate line goes. What stays is joined by line feeds, unchanged.
    """
    few = pick(docs, id_col, text_col, site_col).toDF("doc_id", "text", "site")
    key = F.struct(F.col("doc_id"), F.xxhash64("text").alias("x"), F.xxhash64(F.reverse("text")).alias("y")).alias("key")
    lines = cut(_lines(few.select(key, "text", F.col("site").cast("string").alias("site"))))
    spread = cut(line_spread(lines.select("hash", "site"), min_sites).select("hash"))
    gone = lines.select("key", "at", "hash").join(spread, "hash").groupBy("key").agg(F.collect_set("at").alias("gone"))
    gone = cut(gone)
    flat = few.select("doc_id", "text", key)
    joined = flat.join(gone, flat["key"].eqNullSafe(gone["key"]), "left").select("doc_id", "text", "gone")
    # posexplode's places are those of the array, so the same split gives the same lines
    parts = F.split("text", "\n")
    removed = F.coalesce(F.size("gone"), F.lit(0))
    text = F.when(removed > 0, F.array_join(F.filter(parts, lambda line, at: ~F.array_contains(F.col("gone"), at)), "\n")).otherwise(F.col("text"))
    size = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(parts))
    return joined.select("doc_id", size.cast("long").alias("n_lines"), removed.cast("long").alias("n_removed"), text.alias("text"))
