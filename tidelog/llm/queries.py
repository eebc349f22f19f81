"""The thin queries opN_<name> of this subpackage and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, fingerprints, mixing, near_dedup, packing, pii, quality_classifier, quality_rules, secrets, toxicity

#: Target weights of the mixing query; sources not named have weight 1.
WEIGHTS = {"src0": 4.0, "src1": 2.0, "src2": 0.5}


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_docs(spark, sf_dir), WEIGHTS).select("doc_id", "text", "lang", "source", "n_chars", "copy", "n_copies")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pseudonymise(_docs(spark, sf_dir))
    count = lambda name: F.size(F.filter("pii", lambda k: k == F.lit(name))).alias(f"n_{name}")
    counts = [count(name) for name in pii.FORMATS]
    return found.select("doc_id", "text", *counts)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    return toxicity.score(docs, *toxicity.learn(docs, _labels(spark, sf_dir)))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_docs(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op6_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_docs(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir)
    return quality_classifier.score(docs, *quality_classifier.learn(docs, _labels(spark, sf_dir)))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(_docs(spark, sf_dir))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(_docs(spark, sf_dir))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(_docs(spark, sf_dir))
    return found.select("doc_id", near_dedup.hex64(F.col("fp")).alias("fingerprint"), "component_id")


QUERIES = {
    f.__name__: f
    for f in (op1_mixing, op2_pii, op3_toxicity, op4_packing, op5_chat, op6_fertility, op7_quality, op8_simhash, op9_secrets, op10_near_dedup)
}

ORACLES = {
    "op1_mixing": """
        WITH own AS (
            SELECT source, sum(length(coalesce(text, ''))) AS chars,
                   CASE source WHEN 'src0' THEN 4.0::DOUBLE WHEN 'src1' THEN 2.0::DOUBLE WHEN 'src2' THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS weight
            FROM documents GROUP BY source
        ), rates AS (
            SELECT source, CASE WHEN chars > 0
                THEN weight * (SELECT sum(chars) FROM own)::DOUBLE / (SELECT sum(weight) FROM own) / chars::DOUBLE
                ELSE 1.0 END AS rate
            FROM own
        ), cdf AS (
            SELECT source, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS c
            FROM rates, generate_series(0, 200) g(k)
        ), drawn AS (
            SELECT d.*, ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u FROM documents d
        ), counted AS (
            SELECT d.*, (SELECT count(*) FROM cdf WHERE cdf.source IS NOT DISTINCT FROM d.source AND cdf.c <= d.u)::INTEGER AS n_copies FROM drawn d
        )
        SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy, n_copies
        FROM counted, generate_series(0, 199) g(copy) WHERE copy < n_copies
    """,
}
