"""Profiling and investigation reports over the raw tables (R1-R15).  Each
report is an aggregate job returning a small DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_bounded, cut_lineage


def _nulls(c) -> F.Column:
    """``sum(case when c then 1 else 0 end)``: NULL on an empty table, like the original."""
    return F.sum(F.when(c, F.lit(1)).otherwise(F.lit(0)))


def _rows(n) -> F.Column:
    """A count; over an empty table, footers give NULL for it."""
    return F.greatest(n, F.lit(0).cast("bigint"))


def _blank(name: str) -> F.Column:
    return F.col(name).isNull() | (F.col(name) == "")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """R1."""
    return reduce(DataFrame.unionByName, [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), _rows("row_count").alias("row_count"))
        for name, df in tables.items()])


NEUTRAL_TYPES = {"string": "text", "decimal": "decimal", "date": "date", "timestamp_ntz": "timestamp"}


def schema_report(tables: dict[str, DataFrame]) -> DataFrame:
    """R2: type, rows and filled values of every column, one aggregate per table."""
    parts = []
    for name, df in tables.items():
        filled = df.agg(F.count(F.lit(1)).alias("row_count"), *[F.count(F.col(f.name)).alias(f"c{i}") for i, f in enumerate(df.schema)])
        kinds = [NEUTRAL_TYPES.get(f.dataType.typeName().split("(")[0], f.dataType.typeName()) for f in df.schema]
        stack = ", ".join(f"'{f.name}', '{k}', c{i}" for i, (f, k) in enumerate(zip(df.schema, kinds)))
        parts.append(filled.selectExpr("row_count", f"stack({len(kinds)}, {stack}) AS (column_name, data_type, filled)").select(
            F.lit(name).alias("table_name"), "column_name", "data_type", _rows("row_count").alias("row_count"), _rows("filled").alias("filled")))
    return reduce(DataFrame.unionByName, parts)


def accounts_blanks(accounts: DataFrame) -> DataFrame:
    """R3."""
    return accounts.agg(
        _nulls(_blank("account_id")).alias("account_id_nulls"),
        _nulls(_blank("division")).alias("division_nulls"),
        _nulls(_blank("region")).alias("region_nulls"),
        _nulls(_blank("segment")).alias("segment_nulls"),
        _nulls(_blank("csm_owner")).alias("csm_owner_nulls"),
        _nulls(F.col("renewal_date").isNull()).alias("renewal_date_nulls"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per raw value, most frequent first."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.desc("cnt"))


def subscriptions_nulls(subs: DataFrame) -> DataFrame:
    """R5."""
    return subs.agg(
        _nulls(F.col("account_id").isNull()).alias("account_id_nulls"),
        _nulls(F.col("product").isNull()).alias("product_nulls"),
        _nulls(F.col("arr_usd").isNull()).alias("arr_nulls"),
        _nulls(F.col("arr_usd") == 0).alias("arr_zero"),
        _nulls(F.col("arr_usd") < 0).alias("arr_negative"),
    )


def subscriptions_by_product(subs: DataFrame) -> DataFrame:
    """R6."""
    return (subs.groupBy("product")
            .agg(F.count(F.lit(1)).alias("cnt"), F.round(F.sum("arr_usd"), 0).alias("total_arr"))
            .orderBy(F.desc("total_arr")))


def arr_stats(subs: DataFrame) -> DataFrame:
    """R7."""
    return subs.agg(
        F.round(F.min("arr_usd"), 0).alias("min_arr"),
        F.round(F.avg("arr_usd"), 0).alias("avg_arr"),
        F.round(F.max("arr_usd"), 0).alias("max_arr"),
        F.round(F.sum("arr_usd"), 0).alias("total_arr"),
    )


def _orphan_rows(child: DataFrame, accounts: DataFrame, out: str) -> DataFrame:
    """How many child rows have no account (NULL ids included, as a left join + IS
    NULL does).  Rows are counted per id before the join."""
    ids = child.groupBy("account_id").agg(F.count(F.lit(1)).alias("n"))
    return (ids.join(accounts.select("account_id").distinct(), "account_id", "left_anti")
            .agg(F.coalesce(F.sum("n"), F.lit(0)).alias(out)))


def orphan_subscriptions(subs: DataFrame, accounts: DataFrame) -> DataFrame:
    """R8."""
    return _orphan_rows(subs, accounts, "orphan_subs")


def submission_date_range(events: DataFrame) -> DataFrame:
    """R9."""
    return events.agg(F.min("submission_date").alias("earliest"), F.max("submission_date").alias("latest"))


def submissions_nulls(events: DataFrame) -> DataFrame:
    """R10, by plain counts, which stored tables answer from their footers
    (``laid_out.read_with_statistics``); NULL on an empty table."""
    rows = F.nullif(F.count(F.lit(1)), F.lit(0))
    return events.agg(
        (rows - F.count("account_id")).alias("account_id_nulls"),
        (rows - F.count("user_id")).alias("user_id_nulls"),
        (rows - F.count("product")).alias("product_nulls"),
        (rows - F.count("submission_date")).alias("date_nulls"),
    )


def submissions_by_product(events: DataFrame) -> DataFrame:
    """Rows, distinct users and distinct accounts per product.  Events are
    combined per (product, account, user) first; each combination is then listed
    once under its user and once under its account."""
    seen = events.groupBy("product", "account_id", "user_id").agg(F.count(F.lit(1)).alias("n"))
    keyed = seen.select("product", F.explode(F.array(
        F.struct(F.lit("u").alias("kind"), F.col("user_id").alias("key"), F.col("n")),
        F.struct(F.lit("a").alias("kind"), F.col("account_id").alias("key"), F.lit(0).cast("bigint").alias("n")))).alias("k"))
    keys = keyed.groupBy("product", F.col("k.kind").alias("kind"), F.col("k.key").alias("key")).agg(F.sum("k.n").alias("n"))
    filled = lambda kind: F.count_if((F.col("kind") == kind) & F.col("key").isNotNull())
    return (keys.groupBy("product")
            .agg(F.sum("n").alias("submissions"), filled("u").alias("unique_users"), filled("a").alias("accounts"))
            .orderBy(F.desc("submissions")))


def orphan_submissions(events: DataFrame, accounts: DataFrame) -> DataFrame:
    """R12."""
    return _orphan_rows(events, accounts, "orphan_submissions")


def ghost_accounts(events: DataFrame, accounts: DataFrame) -> DataFrame:
    """Distinct unknown account ids referenced by events."""
    ids = events.select("account_id").filter(F.col("account_id").isNotNull()).distinct()
    return (ids.join(accounts.select("account_id").distinct(), "account_id", "left_anti")
            .agg(F.count(F.lit(1)).alias("ghost_accounts")))


def subscribed_no_submissions(subs: DataFrame, events: DataFrame) -> DataFrame:
    """Distinct subscribed accounts with no event at all."""
    subscribed = subs.select("account_id").filter(F.col("account_id").isNotNull()).distinct()
    active = events.select("account_id").filter(F.col("account_id").isNotNull()).distinct()
    return subscribed.join(active, "account_id", "left_anti").agg(
        F.count(F.lit(1)).alias("accounts_no_submissions"))


def duplicate_submissions(events: DataFrame, max_broadcast_rows: int = 2_000_000) -> DataFrame:
    """Every row of a submission_id seen more than once, by id and date.

    The repeated ids come from a pre-aggregated count and are written once; within
    the counted bound they are broadcast, so no event row is shuffled but those
    of the result; beyond it, adaptive execution splits a skewed id.  The
    remaining columns break ties in the sort, so its range partitioning can
    split even one id's rows across tasks."""
    dupes = cut_lineage(events.groupBy("submission_id").agg(F.count(F.lit(1)).alias("n"))
                        .filter(F.col("n") > 1).select("submission_id"), "repeated_ids")
    dupes = broadcast_if_bounded(dupes, dupes.count(), max_broadcast_rows)
    return (events.join(dupes, "submission_id", "left_semi")
            .orderBy("submission_id", "submission_date", "submission_timestamp", "account_id", "product",
                     "user_id"))
