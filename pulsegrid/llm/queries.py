"""Registered queries of the operators, over the whole given tables with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm import (
    bpe, decontamination, exact_search, fill_middle, html_tree, language, lattice_lm, repetition, resampling,
    secret_scan, sharding, simhash, substring_dedup,
)
from pulsegrid.llm.oracles import ORACLES as ORACLES
from pulsegrid.llm.settings import BPE_FILE, LM_FILE, SHARDS


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that are left once repeated 35-word windows are removed."""
    out = substring_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    out = html_tree.main_texts(_table(spark, sf_dir, "pages"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page; the text model learns from the labelled documents."""
    documents = _table(spark, sf_dir, "documents").select("text", "lang")
    return language.identify(_table(spark, sf_dir, "pages"), documents)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document."""
    documents = _table(spark, sf_dir, "documents").select("doc_id")
    return sharding.place(documents, "doc_id", sharding.fill_table(SHARDS))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition measures and verdict of every document."""
    out = repetition.measure(_table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", "longest_repeat", "covered_chars",
    )


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the bytes that they decode to, as digests."""
    out = bpe.encode(
        _table(spark, sf_dir, "documents"), public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN
    )
    return out.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document."""
    found = secret_scan.scan(_table(spark, sf_dir, "documents"))
    kinds = [r.kind for r in secret_scan.BASE_RULES]
    base = F.filter("spans", lambda s: s["rank"] < len(kinds))
    counts = [
        F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("long").alias(f"n_{kind}")
        for rank, kind in enumerate(kinds)
    ]
    return found.select(
        "row.doc_id", *counts, F.sha2(secret_scan.spans_text(base), 256).alias("base_sha256"),
        secret_scan.spans_text(F.col("spans")).alias("spans"),
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents contain."""
    found = decontamination.contained(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return found.select("doc_id", "item_id", "n_shared", "n_item")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    out = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word model and subword lattice scores of every document."""
    return lattice_lm.score(_table(spark, sf_dir, "documents"), public_tokenizers.path(LM_FILE))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut and rearranged for filling in the middle, as digests."""
    out = fill_middle.transform(_table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op12_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best matches of every fiftieth vector among all others."""
    return exact_search.top_matches(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A draw of documents whose n-grams are distributed like those of the benchmark texts."""
    return resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f for f in (
        op1_substring_dedup, op2_html_extraction, op3_language_id, op4_sharding, op5_quality_rules,
        op6_byte_bpe, op7_secret_scan, op8_decontamination, op9_simhash, op10_lm_scoring, op11_fill_middle,
        op12_exact_search, op13_resampling,
    )
}
