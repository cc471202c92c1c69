"""Connected components of a link table by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statewatt.llm.common import cut


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step over (hi, lo) links, hi > lo.

    Large star: every node hands its smallest neighbour to its larger
    neighbours. Small star: to itself and its smaller ones. The minima are
    written down first, so both sides of the join are plain shuffles and a hub
    with a third of all links can be split.
    """
    if larger:
        sides = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    else:
        sides = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
    least = cut(sides.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    wide = sides if not larger else sides.where(F.col("v") > F.col("u"))
    moved = wide.join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where(F.col("hi") > F.col("lo"))
    if not larger:
        moved = moved.unionAll(least.select(F.col("u").alias("hi"), F.col("m").alias("lo")))
    return cut(moved.distinct())


def _unsettled(edges: DataFrame) -> bool:
    """Whether some node has two parents, or is parent and child."""
    ends = edges.select(F.col("hi").alias("n"), F.lit(1).alias("child"), F.lit(0).alias("parent")).unionAll(
        edges.select(F.col("lo").alias("n"), F.lit(0).alias("child"), F.lit(1).alias("parent"))
    )
    ends = ends.groupBy("n").agg(F.sum("child").alias("child"), F.max("parent").alias("parent"))
    return ends.where((F.col("child") > 1) | ((F.col("child") == 1) & (F.col("parent") == 1))).limit(1).count() > 0


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node that has a link; root is the smallest node
    reachable. Links to itself and repeated ones do no harm; a null end makes
    none. Every step leaves at most as many links as it found, plus one a node.
    """
    edges = links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("hi") > F.col("lo")))
    edges = cut(edges.distinct())
    while _unsettled(edges):
        edges = _star(_star(edges, larger=True), larger=False)
    roots = edges.select("lo").distinct()
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionAll(roots.select(F.col("lo").alias("node"), F.col("lo").alias("root")))
