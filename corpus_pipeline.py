"""Corpus pipeline: civil, distinct, clean of secrets, mixed, packed.

Each stage is (name, function of (spark, docs, sf_dir)); its result is written as Parquet and read
again as the next stage's docs. All but the last return the columns of ``documents``. Rows are taken
as they come in every stage: null and repeated ids, null, empty and very long texts, equal rows,
further columns of any name and empty tables have the results that each stage states.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from tidelog.llm import mixing, near_dedup, packing, secrets, toxicity
from tidelog.llm.common import durable
from tidelog.llm.queries import WEIGHTS


def civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar rejects go; it learns from the labels of those at hand.

    A score at the threshold is a rejection. A text without clauses, null and empty ones too, stays.
    Each row is judged for itself, whole; without labels the grammar's own weights decide.
    """
    return toxicity.keep_civil(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (5-word shingles, Jaccard 0.8) stays: the row with the smallest doc_id.

    Ties go to the least hash of the text, then to any of the equal rows. Null, empty and blank texts
    are one group; a group without any id keeps one row.
    """
    return near_dedup.one_of_near_copies(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark, and n_chars follows; the documents stay, null texts as they are."""
    return secrets.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated by their source's rate and shuffled; columns as before.

    A null source is a source of its own; a document may be drawn zero times, as the method says.
    """
    return mixing.mix(docs, WEIGHTS).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences; a null or empty text is the end mark alone."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", civil), ("near-dedup", distinct), ("secrets", without_secrets), ("mixing", mixed), ("packing", packed)]

#: No SQL expresses the learned grammar, the components or the rounds; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written into the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
