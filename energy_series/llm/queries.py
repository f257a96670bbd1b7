"""The registered queries of this folder; each applies its operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    op1_fingerprints,
    op10_licences,
    op11_source_divergence,
    op12_byte_bpe,
    op13_merkle_manifest,
    op2_personal_data,
    op3_jaccard_join,
    op4_line_dedup,
    op5_toxicity,
    op6_token_counts,
    op7_decontamination,
    op8_token_files,
    op9_bpe,
)
from .common import table


def op1_fingerprints_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op2_personal_data_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_personal_data.report(table(spark, sf_dir, "documents"))


def op3_jaccard_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op4_line_dedup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_line_dedup.report(table(spark, sf_dir, "documents"))


def op5_toxicity_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return op5_toxicity.scores(docs, op5_toxicity.trained(docs, table(spark, sf_dir, "labels")))


def op6_token_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_token_counts.token_counts(table(spark, sf_dir, "documents"))


def op7_decontamination_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_token_files_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_token_files.token_files(table(spark, sf_dir, "documents"))


def op9_bpe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_bpe.encoded(table(spark, sf_dir, "documents"), digests=True)


def op10_licences_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return op10_licences.report(docs, op10_licences.trained(docs))


def op11_source_divergence_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_source_divergence.audit(table(spark, sf_dir, "documents"))


def op12_byte_bpe_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_byte_bpe.digests(table(spark, sf_dir, "documents"))


def op13_merkle_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_merkle_manifest.tamper_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints_query,
    "op2_personal_data": op2_personal_data_query,
    "op3_jaccard_join": op3_jaccard_query,
    "op4_line_dedup": op4_line_dedup_query,
    "op5_toxicity": op5_toxicity_query,
    "op6_token_counts": op6_token_counts_query,
    "op7_decontamination": op7_decontamination_query,
    "op8_token_files": op8_token_files_query,
    "op9_bpe": op9_bpe_query,
    "op10_licences": op10_licences_query,
    "op11_source_divergence": op11_source_divergence_query,
    "op12_byte_bpe": op12_byte_bpe_query,
    "op13_merkle_manifest": op13_merkle_query,
}
