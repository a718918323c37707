"""Registered queries of the operators: each runs over its whole table."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import (
    bpe, decontaminate, embedding_dedup, language, lexical_search, line_dedup, packing, quality,
    secret_scan, simhash, source_audit, token_files, toxicity,
)
from ledgerlake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digest(table(spark, sf_dir, "documents"))


def secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts behind the verdicts of ``op1_secret_scan``, one row per span."""
    return secret_scan.secret_ownership(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digest(table(spark, sf_dir, "documents"))


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return quality.score_quality(table(spark, sf_dir, "documents"), quality.ratings(labels))


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), with_ids=False)


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_digest(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item that it leaks; clean documents have none."""
    return decontaminate.leak_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op12_source_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit_sources(table(spark, sf_dir, "documents"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), with_ids=False)


QUERIES: dict[str, Query] = {
    "op1_secret_scan": op1_secret_scan,
    "secret_ownership": secret_ownership,
    "op2_line_dedup": op2_line_dedup,
    "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_bpe_round_trip": op5_bpe_round_trip,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_language_id": op7_language_id,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_token_files": op9_token_files,
    "op10_toxicity": op10_toxicity,
    "op11_ranked_lexical_search": op11_ranked_lexical_search,
    "op12_source_divergence_audit": op12_source_divergence_audit,
    "op13_best_fit_packing": op13_best_fit_packing,
}
