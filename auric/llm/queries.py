"""Queries of this subpackage: one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auric.llm import (alignment, decontam, html_extract, jaccard_join, langid, licenses, mixing, periodic_runs, quality_classifier,
                       quality_rules, simhash, suffix_dedup, tokens)
from auric.llm.textbatch import table

TOKENIZER = "piece_bpe_32k.model"
BYTE_TOKENIZER = "byte_bpe_50k.json"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs), keep=["doc_id"]).select(
        "doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op3_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("notices")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(table(spark, sf_dir, "pages"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_substrings(table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_documents(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "n_links")


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return alignment.align(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_TOKENIZER),
                           public_tokenizers.path(TOKENIZER)).digest()


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.similar_fingerprints(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id", "n_links")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.collapse_runs(periodic_runs.with_planted(table(spark, sf_dir, "documents"))))


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_token_counts, op3_license_scans, op4_mix_sources, op5_quality_rules, op6_quality_classifier,
    op7_decontaminate, op8_html_extraction,
    op9_suffix_dedup, op10_jaccard_join, op11_token_alignment, op12_simhash, op13_periodic_runs)}
ORACLES: dict[str, str] = {"op4_mix_sources": mixing.OP4_SQL, "op7_decontaminate": decontam.OP7_SQL}
