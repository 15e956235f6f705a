"""The training-data pipeline: five stages, each one operator applied to all that the stage before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. Its result is written as Parquet and read again as the
next stage's documents. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trackspark.llm import jaccard, langid, mixing, packing, pii
from trackspark.llm.common import discard, made, scratch, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language; texts without a letter go."""
    return langid.identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts whose sets of five-word shingles are at least 80 % alike, told apart by id and text."""
    return jaccard.one_of_each(docs, words=5, percent=80)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind in brackets."""
    return pii.redacted(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix of sources takes, once per pass, in training order."""
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in bins of permitted lengths; bins follow the training order."""
    return packing.pack_in_order(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("packing", packing_stage),
]

# No SQL: a trained model decides in the first stage and a packing in the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; what lies between stages is written to the shared checkpoint folder.

    A stage's result is written before the next one begins; its input and what it wrote on the way are removed then.
    """
    docs, before = table(spark, sf_dir, "documents"), made()
    for name, stage in STAGES:
        rows = stage(spark, docs, sf_dir)
        folder = scratch(spark, f"stage-{name}")
        rows.write.parquet(folder)
        discard(spark, before, keep=[folder])
        docs = spark.read.parquet(folder)
    return docs
