"""What the training-data operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statewatt.session import _ensure_checkpoint_dir

#: A word: a run of bytes other than ASCII white space. ``bytes.split()`` cuts alike.
WORD = r"[^\x20\x09-\x0D]+"


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only, found by exact name and position, so that other
    columns may be called anything, even the same in another case or twice."""
    places = [df.columns.index(n) for n in names]
    flat = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return flat.select(*[F.col(f"c{p}").alias(n) for p, n in zip(places, names)])


def lower_ascii(c: Column) -> Column:
    """``c`` with A-Z lower-cased and every other character as it is."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read from there.

    The folder is the session's ``spark.checkpoint.dir``; one is made only where
    none is set, as in local tests. An executor that is lost takes nothing along.
    """
    _ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def integer_vectors(rows: DataFrame, scale: float, *others: str, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v, others): components floor(scale · x), x as double, as longs, of
    every row that takes part.

    Null and empty vectors and those with a null, infinite or not-a-number
    component take none. A component that no long can hold fails the job.
    """
    few = pick(rows, id_col, vector_col, *others).toDF("vec_id", "x", *others)
    x = F.transform("x", lambda e: e.cast("double"))
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    few = few.where(F.col("x").isNotNull() & (F.size("x") > 0) & F.coalesce(fine, F.lit(False)))

    def floored(e: Column) -> Column:
        return F.when(F.abs(e * scale) < 2.0**62, F.floor(e * scale).cast("long")).otherwise(F.raise_error(F.lit("a vector component is beyond a long")).cast("long"))

    return few.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, floored).alias("v"), *others)
