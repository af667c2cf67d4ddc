"""A training corpus out of `documents`, in stages that are each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from basketry.llm import decontaminate, mixing, quality_rules, simhash, suffix_dedup
from basketry.llm.common import read
from basketry.session import new_path, tune

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents beyond the fences of their language and source go."""
    tune(spark)
    return quality_rules.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that of the least id."""
    tune(spark)
    return simhash.deduplicated(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes and more that stand earlier in the corpus are cut out of the texts."""
    tune(spark)
    return suffix_dedup.without_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    tune(spark)
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus: a row per draw of the mix, by shard and shuffled inside it.

    Documents the mix leaves out have no row, those drawn twice have two, and the text of one
    taken in part ends after `words` words.
    """
    tune(spark)
    return mixing.mixture(docs).select("shard", "turn", "place", "words", "doc.*")


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("decontamination", decontamination),
    ("mixing", mix),
]

# Quantile sketches, hashes of shingles and cuts inside a text are not for SQL to express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over `documents`; each reads what the one before wrote."""
    folder = new_path(spark, "corpus")
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
