"""Queries of the training-data operators, and DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from acctpulse.llm import (
    chat_format, decontaminate, hard_negatives, html_extract, jaccard_join, language_id, license_scan,
    piece_codec, quality_rules, spelling_variants, token_counts, token_store, url_filter,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), url_filter.rule_table(spark))


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.report(_table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.round_trip(_table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.report(_table(spark, sf_dir, "pages"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(_table(spark, sf_dir, "documents"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.report(chat_format.with_probe(_table(spark, sf_dir, "conversations"), spark))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(_table(spark, sf_dir, "embeddings"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(_table(spark, sf_dir, "documents"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(_table(spark, sf_dir, "documents"))


OPERATORS = (
    op1_url_filter, op2_token_store, op3_sentencepiece, op4_language_id, op5_html_extraction,
    op6_quality_rules, op7_license_scan, op8_jaccard_join, op9_chat_format, op10_decontamination,
    op11_hard_negatives, op12_spelling_variants, op13_token_counts,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filter": url_filter.SQL, "op9_chat_format": chat_format.SQL, "op10_decontamination": decontaminate.REPORT_SQL, "op11_hard_negatives": hard_negatives.SQL}
