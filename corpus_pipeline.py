"""The corpus pipeline: filters, deduplicates, decontaminates and encodes ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from energy_series.llm import op3_jaccard_join, op4_line_dedup, op5_toxicity, op7_decontamination, op9_bpe
from energy_series.llm.common import table, written


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on labelled ones, doesn't reject."""
    model = op5_toxicity.trained(docs, table(spark, sf_dir, "labels"))
    return op5_toxicity.accepted(docs, model)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines and sentences that recur in others, which stay in one."""
    return op4_line_dedup.clean(docs)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, a similarity of 0.8."""
    return op3_jaccard_join.one_row_of_each(docs, size=5, similarity=(4, 5))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return op7_decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text that they decode to."""
    return op9_bpe.encoded(docs, digests=True)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_stage),
    ("jaccard_join", jaccard_stage),
    ("decontamination", decontamination_stage),
    ("bpe", encode_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


ORACLE_SQL = None
