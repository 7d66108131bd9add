"""The text operators as registered queries over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tideferry.llm import (
    conversation_repair,
    decontamination,
    jaccard_join,
    license_scan,
    line_dedup,
    lm_scoring,
    merkle_manifest,
    packing,
    quality_rules,
    residual_packing,
    substring_dedup,
    token_counts,
    toxicity,
)
from tideferry.sources.tables import read_table


def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.report(read_table(spark, folder, "documents"))


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(read_table(spark, folder, "documents"))


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.report(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.of_documents(read_table(spark, folder, "documents"))


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judged(read_table(spark, folder, "documents"))


def op6_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.report(read_table(spark, folder, "documents"))


def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(read_table(spark, folder, "documents"))


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.report(read_table(spark, folder, "documents"))


def op9_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scoring.scored(read_table(spark, folder, "documents"), lm_scoring.QUERY_DEPTH)


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.scored(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return merkle_manifest.report(read_table(spark, folder, "documents"))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_repair.report(read_table(spark, folder, "conversations"))


def op13_residual_packing(spark: SparkSession, folder: str) -> DataFrame:
    return residual_packing.of_documents(read_table(spark, folder, "documents"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_packing": op2_packing,
    "op3_decontamination": op3_decontamination,
    "op4_token_counts": op4_token_counts,
    "op5_quality_rules": op5_quality_rules,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_license_scan": op7_license_scan,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_toxicity": op10_toxicity,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_residual_packing": op13_residual_packing,
}

ORACLE = {
    "op1_line_dedup": line_dedup.QUERY_SQL,
    "op2_packing": packing.QUERY_SQL,
    "op3_decontamination": decontamination.QUERY_SQL,
    "op5_quality_rules": quality_rules.QUERY_SQL,
    "op6_jaccard_join": jaccard_join.QUERY_SQL,
    "op7_license_scan": license_scan.QUERY_SQL,
    "op8_substring_dedup": substring_dedup.QUERY_SQL,
    "op11_merkle_manifest": merkle_manifest.QUERY_SQL,
    "op12_conversation_repair": conversation_repair.QUERY_SQL,
}
