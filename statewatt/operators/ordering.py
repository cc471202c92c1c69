"""The exact place of every row in a total order, without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statewatt.session import stored


def with_position(df: DataFrame, order: Sequence[str | Column], name: str = "position") -> DataFrame:
    """``df`` with the 0-based place of each row under ``order``.

    Rows are range-partitioned on the whole order, so a value that a third of
    the rows share is split as long as the order goes on with a key. Each
    partition is one run of the result; it counts its rows, and the counts, one
    row a partition, give every run its first place.
    """
    runs = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_run", F.spark_partition_id())
    runs = stored(runs.withColumn("_at", F.monotonically_increasing_id()))
    size = runs.groupBy("_run").agg(F.count("*").alias("_rows"), F.min("_at").alias("_least"))
    ahead = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    first = size.select("_run", "_least", F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_first"))
    placed = runs.join(F.broadcast(first), "_run")  # as many rows as the shuffle has partitions
    return placed.withColumn(name, F.col("_first") + F.col("_at") - F.col("_least")).select(*df.columns, name)
