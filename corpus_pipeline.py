"""The corpus pipeline: quality rules, near-duplicate removal, secret scans,
source mixing and packing, each stage over all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlytics.llm import jaccard_join, mixing, packing, quality_rules, secret_scan
from eventlytics.llm.frames import table, written
from eventlytics.llm.queries import MIX_SEED, MIX_WEIGHTS, mix_levels

# The mix takes nine tenths of the tokens, each document at most once.
MIX_PERCENT, MIX_EPOCHS = 90, 1


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the quality rules."""
    trusted = quality_rules.trusted_ids(table(spark, sf_dir, "labels"))
    return quality_rules.filter_documents(docs, quality_rules.fit_ratio(docs, trusted))


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of exact and near copies."""
    return jaccard_join.one_of_each_group(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets in the texts; every document stays."""
    return secret_scan.redact_documents(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each source's share of the token budget."""
    mixed = mixing.mix_sources(docs, mix_levels(), MIX_WEIGHTS, MIX_PERCENT, MIX_EPOCHS, MIX_SEED)
    return mixed.select(*[F.col(f"`{c}`") for c in docs.columns])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents' tokens into sequences; one row per piece."""
    return packing.pack_documents(docs).select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_stage),
    ("ngram_jaccard_join", near_copy_stage),
    ("secret_scan", secret_stage),
    ("source_mix", mix_stage),
    ("best_fit_packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each stage's result is written
    to the shared checkpoint folder and read back as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# Hashed n-gram ratios and byte-level tokens have no DuckDB form.
ORACLE_SQL: str | None = None
