"""Parquet, CSV and table sources and sinks with declared schemas."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType, TimestampNTZType, TimestampType

from statewatt.functions import clean_non_finite
from statewatt.operators.ordering import with_position
from statewatt.sources.schemas import SCHEMAS


def _fits(stored: DataType, declared: DataType) -> bool:
    """Same type, or a time without zone where a time is declared: casting the
    latter would keep time filters out of the scan."""
    return stored == declared or (isinstance(stored, TimestampNTZType) and isinstance(declared, TimestampType))


def _conform(df: DataFrame, schema: StructType, source: str) -> DataFrame:
    """Declared columns in declared types; a missing column fails early.

    Only the declared columns are read, and a column whose stored type already
    fits is passed through bare, so filters on it still reach the scan.
    """
    stored = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in stored]
    if missing:
        raise ValueError(f"{source} lacks the columns {', '.join(missing)}")
    cols = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        cols.append(c if _fits(stored[f.name], f.dataType) else c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


_CASES = {"upper": F.upper, "lower": F.lower}


def load_table(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    codes: Mapping[str, str] | None = None,
    year_of: str | None = None,
) -> DataFrame:
    """Parquet table with the declared columns, non-finite numbers as NULL.

    Comparisons are case-sensitive, so ``codes`` (column -> 'upper' or 'lower')
    trims and normalises code columns whose spelling varies. Leave it out for
    clean data: a normalised column cannot be filtered in the scan.

    A table that ``write_table(year_of=ts)`` wrote keeps its partition column, as
    ``<ts>_year``, when ``year_of`` names ts; ``since`` and ``in_years`` take it, so that
    a time filter prunes folders.
    """
    df = spark.read.parquet(path)
    if year_of is not None:
        if "year" not in df.columns:
            raise ValueError(f"{path} is not partitioned by year")
        df = df.withColumnRenamed("year", f"{year_of}_year")
        if schema is not None:
            schema = StructType([*schema.fields, df.schema[f"{year_of}_year"]])
    if schema is not None:
        df = _conform(df, schema, path)
    for col, case in (codes or {}).items():
        if case not in _CASES:
            raise ValueError(f"code case must be 'upper' or 'lower', not {case!r}")
        df = df.withColumn(col, _CASES[case](F.btrim(col)))
    return clean_non_finite(df)


def load_inputs(
    spark: SparkSession, folder: str, names: Sequence[str] | None = None, year_of: Mapping[str, str] | None = None
) -> dict[str, DataFrame]:
    """The model inputs stored as ``<folder>/<name>.parquet``; ``year_of`` gives the
    time column of each one that is partitioned by its year."""
    yearly = year_of or {}
    return {n: load_table(spark, f"{folder}/{n}.parquet", SCHEMAS[n], year_of=yearly.get(n)) for n in (names or SCHEMAS)}


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), year_of: str | None = None) -> None:
    """Replace a parquet table; ``year_of`` adds and partitions by the year of
    a time column, the layout for long hourly tables."""
    if year_of is not None:
        df = df.withColumn("year", F.year(year_of))
        partition_by = ["year", *partition_by]
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_stage(df: DataFrame, name: str) -> DataFrame:
    """Replace the catalog table ``name`` and return it for the next stage."""
    df.write.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def with_file_position(df: DataFrame, name: str = "position") -> DataFrame:
    """``df``, as a file reader returned it, with each row's place in its input:
    files by path, rows as they stand in a file, however the files are split."""
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row")]
    return with_position(df.select("*", *place), ["_file", "_block", "_row"], name).drop("_file", "_block", "_row")


def read_csv(
    spark: SparkSession, path: str, schema: StructType, options: Mapping[str, str] | None = None, position: str | None = None
) -> DataFrame:
    """CSV files with a header; ``position`` names a column for the row's place."""
    rows = spark.read.schema(schema).option("header", True).options(**dict(options or {})).csv(path)
    return rows if position is None else with_file_position(rows, position)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
