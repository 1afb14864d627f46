"""Cleaning of a corpus in stages, from documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the
next one's documents; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from venueops.llm import packing, repeats, setjoin, tiling, toxicity
from venueops.llm.common import checkpointed


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that compression distance calls toxic."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word shingle similarity 0.8 or more."""
    return setjoin.one_of_each(docs, n_words=5, num=80, den=100)


def repeats_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of more than 50 words that occur more than once."""
    return repeats.without_repeats(docs, length=51, unit="words")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that cover a benchmark item."""
    return tiling.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens."""
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicates_stage),
    ("repeats", repeats_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None  # classifier, components and packing are beyond SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = checkpointed(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
