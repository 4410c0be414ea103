"""The registered queries of this subpackage: each applies one operator,
with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlytics.llm import (audit_oracle, filter_audit, fingerprints, html_template, jaccard_join, jaccard_oracle,
                             language_id, mix_oracle, mixing, packing, quality_classifier, quality_rules,
                             repeats_oracle, secret_scan, spelling_variants, substring_dedup, url_filter, variants_oracle)
from eventlytics.llm.frames import NONE_VALUE, held_out, table

# Fixed rules of the URL query: host, path prefix, verdict.
URL_RULES = [
    url_filter.Rule("net", "/", url_filter.BLOCK),
    url_filter.Rule("example.net", "/en/", url_filter.ALLOW),
    url_filter.Rule("example.com", "/de/", url_filter.BLOCK),
    url_filter.Rule("org", "/fr/", url_filter.ALLOW),
]

# The tree of the mix. ``documents`` names no domain, so a source's domain
# is taken from the first hexadecimal digit of its md5.
MIX_WEIGHTS = {
    ("web",): 5, ("forum",): 3, ("books",): 2,
    (None, "en"): 4, (None, "de"): 2, (None, "fr"): 2, (None, "es"): 2,
}
MIX_SEED = 7


def mix_levels() -> dict:
    digit = F.substring(F.md5(F.coalesce(F.col("source"), F.lit(NONE_VALUE)).cast("binary")), 1, 1)
    domain = F.when(digit < "6", "web").when(digit < "b", "forum").otherwise("books")
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


def op1_ppm_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = language_id.identify_languages(docs, language_id.fit_languages(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op2_rule_ensemble_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_classifier.fit_rules(docs, table(spark, sf_dir, "labels"))
    out = quality_classifier.score_quality(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_documents(table(spark, sf_dir, "documents"))


def op4_html_template_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_template.extract_main_text(table(spark, sf_dir, "pages"))
    return out.withColumn("n_chars", F.length("text").cast("bigint"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_rules.fit_ratio(docs, quality_rules.trusted_ids(labels))
    return quality_rules.score_documents(docs, model)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack_documents(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"),
                      "sequence_id", "offset")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_documents(table(spark, sf_dir, "documents")).drop("found")


def op8_lookup_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    out = mixing.mix_sources(docs, mix_levels(), MIX_WEIGHTS, budget_percent=50, max_epochs=2, seed=MIX_SEED)
    return out.select("doc_id", "mix.domain", "mix.lang", "mix.source", "mix.tokens", "mix.epoch")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.group_variants(spelling_variants.count_words(table(spark, sf_dir, "documents")))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_ppm_language_id, op2_rule_ensemble_quality, op3_ngram_jaccard_join, op4_html_template_text,
    op5_quality_rules, op6_best_fit_packing, op7_secret_scan, op8_lookup_fingerprints, op9_source_mix,
    op10_url_filter, op11_spelling_variants, op12_filter_audit, op13_substring_dedup)}

# DuckDB SQL where it can express the operator.
ORACLES: dict[str, str] = {
    "op3_ngram_jaccard_join": jaccard_oracle.SQL,
    "op9_source_mix": mix_oracle.SQL,
    "op11_spelling_variants": variants_oracle.SQL,
    "op12_filter_audit": audit_oracle.SQL,
    "op13_substring_dedup": repeats_oracle.SQL,
}
