"""Corpus pipeline: each stage works on what the one before it kept.

Quality rules drop documents that they reject; of each near-duplicate group one document stays; documents
that contain a benchmark item go; secrets are replaced by a mark; the rest is encoded.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import bpe, decontamination, repetition, secret_scan, simhash
from pulsegrid.llm.settings import BPE_FILE
from pulsegrid.session import cut_lineage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the limits on repetition."""
    return repetition.accepted(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each SimHash component."""
    return simhash.first_of_groups(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets replaced; ``n_chars`` follows the changed text."""
    marked = secret_scan.redact(docs.withColumn("n_chars", F.col("n_chars").cast("long")))
    return marked.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, intact): token ids as packed little-endian 32-bit numbers.

    ``intact`` says whether decoding gives the text again.
    """
    rows = docs.select(F.struct("doc_id", F.md5("text").alias("md5")).alias("key"), "text")
    out = bpe.encode(rows, public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN, id_col="key")
    empty = F.md5(F.lit("").cast("binary"))
    return out.select(
        "key.doc_id", "n_tokens", "ids",
        (F.md5("decoded") == F.coalesce("key.md5", empty)).alias("intact"),
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("secret_scan", mask_secrets),
    ("byte_bpe", encode),
]

# Suffix arrays, SimHash components and BPE are beyond SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
