"""The operators as named queries over a folder of tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import (
    byte_bpe,
    conversations,
    decontaminate,
    language_model,
    licenses,
    mixing,
    periodic_runs,
    quality_classifier,
    quality_rules,
    simhash,
    suffix_dedup,
    token_counts,
    toxicity,
)
from basketry.llm.common import read
from basketry.session import tune

TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 512
RANKS = "byte_bpe_multi_50k.tiktoken"

Query = Callable[[SparkSession, str], DataFrame]


def op1_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.with_names(licenses.license_matches(read(tune(spark), folder, "documents")))


def op2_language_model(spark: SparkSession, folder: str) -> DataFrame:
    rows = language_model.held_out_scores(read(tune(spark), folder, "documents"))
    return rows.select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_classifier.quality_scores(read(tune(spark), folder, "documents"))


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    rows = simhash.near_duplicates(read(tune(spark), folder, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.select("doc_id", digits.alias("fingerprint"), "component_id")


def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(tune(spark), folder, "documents")
    return decontaminate.leaks(docs, read(spark, folder, "benchmark"))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality_rules.quality_verdicts(read(tune(spark), folder, "documents"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.cut_digest(read(tune(spark), folder, "documents"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(tune(spark), folder, "documents")
    return toxicity.toxicity(docs, read(spark, folder, "labels"))


def op9_mixing(spark: SparkSession, folder: str) -> DataFrame:
    rows = mixing.with_taken(mixing.mixed(read(tune(spark), folder, "documents").select(
        "doc_id", "text", "source"
    )))
    return rows.select("doc.doc_id", "size", "source_size", "target", "taken", "shards")


def op9_mixing_shards(spark: SparkSession, folder: str) -> DataFrame:
    """The mix carried out, a row per draw: what the pipeline ends with, as a query of its own."""
    rows = mixing.mixture(read(tune(spark), folder, "documents"))
    return rows.select("shard", "turn", "place", "words", "doc.*")


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    rows = token_counts.token_counts(read(tune(spark), folder, "documents"), path)
    return rows.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = periodic_runs.with_planted_runs(read(tune(spark), folder, "documents"))
    return periodic_runs.run_digest(periodic_runs.periodic_runs(docs))


def op12_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(tune(spark), folder, "documents")
    rows = byte_bpe.round_trip(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    return byte_bpe.round_trip_digest(rows)


def op13_conversations(spark: SparkSession, folder: str) -> DataFrame:
    rows = conversations.damaged(read(tune(spark), folder, "conversations"))
    return conversations.repair_digest(conversations.repair(rows))


QUERIES: dict[str, Query] = {
    "op1_licenses": op1_licenses,
    "op2_language_model": op2_language_model,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_simhash": op4_simhash,
    "op5_decontamination": op5_decontamination,
    "op6_quality_rules": op6_quality_rules,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_mixing": op9_mixing,
    "op10_token_counts": op10_token_counts,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_conversations": op13_conversations,
}
