"""Optional relational source and sink; every option comes from the caller."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, table: str, options: Mapping[str, str]) -> DataFrame:
    """Table or sub-query over JDBC. Pass partitionColumn, lowerBound,
    upperBound and numPartitions to read it in parallel."""
    return spark.read.format("jdbc").options(**dict(options)).option("dbtable", table).load()


def write_jdbc(df: DataFrame, table: str, options: Mapping[str, str], batch_rows: int = 1000) -> None:
    """Replace a table over JDBC in batches; executors write in parallel."""
    df.write.format("jdbc").options(**dict(options)).option("dbtable", table).option("batchsize", batch_rows).mode(
        "overwrite"
    ).save()
