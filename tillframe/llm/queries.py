"""The registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillframe.llm import (
    alignment, decontaminate, jaccard, langid, lm, merkle, mixing, packing, pii, resharding, rules, secret_scan, tokens,
)
from tillframe.llm.common import read
from tillframe.llm.oracle import ORACLE_SQL


def op1_mixture_raking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture_report(read(spark, sf_dir, "documents"))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op3_min_cost_flow_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resharding.shard_report(read(spark, sf_dir, "documents"))


def op4_decision_list_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_report(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_report(read(spark, sf_dir, "documents"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_copies(read(spark, sf_dir, "documents")).drop("row", "leader")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_report(read(spark, sf_dir, "documents"))


def op8_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.entity_report(read(spark, sf_dir, "documents"))


def op9_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_report(read(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predicted_languages(read(spark, sf_dir, "documents"))


def op11_secret_novelty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_report(read(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_report(read(spark, sf_dir, "documents"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_report(read(spark, sf_dir, "documents"))


__all__ = ["ORACLE_SQL", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query for query in (
        op1_mixture_raking, op2_benchmark_decontamination, op3_min_cost_flow_sharding, op4_decision_list_rules, op5_token_counts,
        op6_ngram_jaccard_join, op7_best_fit_packing, op8_bootstrapped_pii, op9_deleted_interpolation,
        op10_language_id, op11_secret_novelty, op12_merkle_manifest, op13_tokenizer_alignment,
    )
}

