"""From raw documents to packed sequences, one operator a stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from statewatt.llm import exact, mixing, packing, simhash, toxicity
from statewatt.session import stored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 stay, all columns as they are. A null text
    scores like an empty one; rows that are alike score alike and stay or go together.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.clean(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z the row with the largest doc_id
    stays, a null doc_id loses; null texts count as empty and as equal.
    """
    return exact.survivors(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of fingerprints linked at three bits or fewer the row with the smallest
    doc_id stays, a null one last. Texts without words have fingerprint zero.
    """
    return simhash.representatives(docs, width=3, k=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix reads them, in training order. A null
    source is a source of its own; texts without words take no part.
    """
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document in its sequence; a null or empty text
    has the end token alone.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_copies),
    ("simhash near-dedup", drop_near_copies),
    ("source mixing", mix_sources),
    ("packing", pack_sequences),
]

#: No SQL tells the fingerprints, the model or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences; an empty table gives none."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
