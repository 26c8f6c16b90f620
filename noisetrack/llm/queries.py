"""Registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from noisetrack.llm import conversations, exact_dedup, fingerprints, language_model, licenses, mixing, packing, quality_rules, simhash_dedup, token_counts, toxicity, variants, warc
from noisetrack.llm.common import crc_mod, read


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scored = toxicity.score_documents(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))
    return scored.select("doc_id", (crc_mod(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_hits", "n_quoted")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(read(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    decided = mixing.decide(read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return decided.select(F.col("_id").alias("doc_id"), F.col("_tokens").alias("n_tokens"), F.col("_topic").alias("topic"), F.round("ratio", 6).alias("ratio"), F.round("keep_prob", 6).alias("keep_prob"), F.round("residual", 6).alias("residual"), "kept")


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents")).drop("spans")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_duplicates(read(spark, sf_dir, "documents"), keep="max")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = fingerprints.fingerprint_table(read(spark, sf_dir, "documents"))
    digits = lambda c: F.lower(F.hex(c))
    return table.select("doc_id", "n_chars", "edited_sha256", digits("fp").alias("fingerprint"), digits("edited_fp").alias("edited_fingerprint"), "near_edited", "near_next", digits("near_group").alias("near_group"))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_dedup.near_groups(read(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(read(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    judged = quality_rules.judge(docs, quality_rules.learn(docs, read(spark, sf_dir, "labels")))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "rule", "kept")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damaged(read(spark, sf_dir, "conversations")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_toxicity, op2_lm_scoring, op3_mixing, op4_license_scans, op5_warc, op6_exact_dedup, op7_packing, op8_token_counts, op9_fingerprints, op10_simhash_dedup, op11_spelling_variants, op12_quality_rules, op13_conversation_repair)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op3_mixing": mixing.oracle(), "op6_exact_dedup": exact_dedup.ORACLE}
