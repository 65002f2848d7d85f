"""Model tables in the catalog, bucketed and sorted by key, and raw tables
whose counts come from their files' footers.

A table is bucketed by the column that is unique in it, so no bucket can grow by a
hot key: account-level tables by account_id, subscriptions and submissions by their
own ids.  Tables with the same key and number of buckets meet without an exchange,
and a key's repeats are counted where they lie.  ``segment_benchmarks``, one row a
peer group, and ``submission_periods``, which only repeats the events, are left out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

KEYS = {"stg_accounts": "account_id", "stg_subscriptions": "subscription_id", "stg_submissions": "submission_id",
        "account_dimensions": "account_id", "period_metrics": "account_id", "user_growth_accounting": "account_id",
        "account_score_mart": "account_id"}
FOOTER_COUNTS = "spark.sql.parquet.aggregatePushdown"
_V1_SOURCES = "spark.sql.sources.useV1SourceList"


def write_laid_out(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Full refresh of one table: each bucket is written, sorted, by one task."""
    (df.repartition(buckets, key).write.mode("overwrite").format("parquet")
     .bucketBy(buckets, key).sortBy(key).saveAsTable(table))


def save_models(models: Mapping[str, DataFrame], database: str, buckets: int) -> dict[str, str]:
    """The model tables of a run as tables of ``database``; name -> table.  Take about a bucket for each GB of the largest."""
    tables = {name: f"{database}.{name}" for name in KEYS}
    for name, table in tables.items():
        write_laid_out(models[name], table, KEYS[name], buckets)
    return tables


def read_models(spark: SparkSession, database: str) -> dict[str, DataFrame]:
    return {name: spark.table(f"{database}.{name}") for name in KEYS}


def read_with_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """A Parquet folder by the reader that answers plain ``count``, ``min`` and ``max``
    from the files' footers (R1, R2, R9 on a date column, R10).  Footers hold no exact
    bounds of texts, decimals and timestamps; an aggregate with one of those, a filter or
    a group is scanned, the columns it names only.  ``session`` switches the counting on
    (``FOOTER_COUNTS``); without it all aggregates are scanned."""
    listed = spark.conf.get(_V1_SOURCES)
    spark.conf.set(_V1_SOURCES, ",".join(s for s in listed.split(",") if s.strip().lower() != "parquet"))
    try:
        return spark.read.parquet(folder)
    finally:
        spark.conf.set(_V1_SOURCES, listed)
