"""Adapter from the driver's generated tables to the three raw inputs
(accounts, subscriptions, submissions).  The derivation rules are listed in
FIXTURES.md section 2; every rule is a built-in expression so the adapter is
one scan-project-join plan per table with filters pushed to the Parquet scan.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT_CONFIG
from ..session import broadcast_if_bounded

# Fixed values of the adapter (FIXTURES.md section 2).
DIVISION_BY_KEY_MOD4 = ("K12", "Higher Ed", "k12", "highered")
NULL_REGION_EVERY = 37
NULL_SEGMENT_EVERY = 101
BLANK_CSM_EVERY = 10
CSM_MOD = 7
CUSTOMER_SINCE_TEXT = "1995-01-01"
RENEWAL_BASE = date(2001, 6, 30)
SUBS_MOVE_CUST_MOD = 11
GHOST_SUB_ORDER_MOD = 499
ZERO_ARR_ORDER_MOD = 20
PRODUCT_MOD = 6
TERM_DAYS = 365
EVENTS_MOVE_CUST_MOD = 13
GHOST_EVENT_ORDER_MOD = 997
QUIET_SEGMENT = "FURNITURE"
QUIET_FROM = "2000-07-01"
QUIET_SHIFT_DAYS = 1461  # moves the late events before both windows
SHARED_USER_SEGMENT = "BUILDING"
USER_MOD = 5
GHOST_ACCOUNT = "ACC-GHOST"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _neighbour(custkey: F.Column, every: int) -> F.Column:
    """The customer a row is credited to: rows of every ``every``-th customer
    move to the one before (customer 0 to 1), so that some accounts have none
    and no row is lost."""
    return F.when(custkey % every == 0, F.abs(custkey - 1)).otherwise(custkey)


def _acc(key) -> F.Column:
    return F.concat(F.lit("ACC-"), key.cast("string"))


def raw_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "customer").alias("c")
    n = _table(spark, sf_dir, "nation").alias("n")
    r = _table(spark, sf_dir, "region").alias("r")
    key = F.col("c.c_custkey")
    division = F.when(key % 4 == 0, DIVISION_BY_KEY_MOD4[0])
    for i in (1, 2, 3):
        division = division.when(key % 4 == i, DIVISION_BY_KEY_MOD4[i])
    renewal = F.date_add(F.lit(RENEWAL_BASE), ((key * 37) % 400 - 30).cast("int"))
    return (
        c.join(n, F.col("c.c_nationkey") == F.col("n.n_nationkey"))
        .join(r, F.col("n.n_regionkey") == F.col("r.r_regionkey"))
        .select(
            _acc(key).alias("account_id"),
            F.col("c.c_name").alias("account_name"),
            division.alias("division"),
            F.when(key % NULL_REGION_EVERY == 0, F.lit(None).cast("string"))
            .otherwise(F.col("r.r_name")).alias("region"),
            F.when(key % NULL_SEGMENT_EVERY == 0, F.lit(None).cast("string"))
            .otherwise(F.col("c.c_mktsegment")).alias("segment"),
            F.col("n.n_name").alias("country"),
            F.lit(CUSTOMER_SINCE_TEXT).alias("customer_since"),
            F.when(key % BLANK_CSM_EVERY == 0, F.lit(""))
            .otherwise(F.concat(F.lit("CSM-"), (key % CSM_MOD).cast("string"))).alias("csm_owner"),
            renewal.cast("string").alias("renewal_date"),
        )
    )


def raw_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    start = F.col("o_orderdate").cast("date")
    arr = F.expr("CAST(CAST(o_totalprice AS DECIMAL(14,2)) * 0.01 AS DECIMAL(18,4))")
    return o.select(
        F.concat(F.lit("SUB-"), key.cast("string")).alias("subscription_id"),
        F.when(key % GHOST_SUB_ORDER_MOD == 0, F.lit(GHOST_ACCOUNT))
        .otherwise(_acc(_neighbour(F.col("o_custkey"), SUBS_MOVE_CUST_MOD))).alias("account_id"),
        F.concat(F.lit("P"), (key % PRODUCT_MOD).cast("string")).alias("product"),
        F.when(key % ZERO_ARR_ORDER_MOD == 0, F.lit(0).cast("decimal(18,4)")).otherwise(arr).alias("arr_usd"),
        start.cast("string").alias("term_start_date"),
        F.date_add(start, TERM_DAYS).cast("string").alias("term_end_date"),
        F.lit("Active").alias("status"),
    )


def raw_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _table(spark, sf_dir, "lineitem")
    o = _table(spark, sf_dir, "orders").select(
        "o_orderkey", _neighbour(F.col("o_custkey"), EVENTS_MOVE_CUST_MOD).alias("custkey"))
    p = _table(spark, sf_dir, "part").select("p_partkey", "p_size")
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    cust = F.col("custkey")
    shipped = F.col("l_shipdate").cast("timestamp_ntz")
    quiet = ((F.col("c_mktsegment") == QUIET_SEGMENT) & (cust % 5 < 3)
             & (shipped >= F.lit(QUIET_FROM).cast("timestamp_ntz")))
    # customers join the orders, so that the events are not shuffled on the customer as well
    joined = (
        li.join(o.join(c, cust == c.c_custkey), li.l_orderkey == o.o_orderkey)
        .join(broadcast_if_bounded(p, p.count(), DEFAULT_CONFIG.broadcast_max_rows), li.l_partkey == p.p_partkey)
        .withColumn("happened", F.when(quiet, shipped - F.expr(f"INTERVAL {QUIET_SHIFT_DAYS} DAYS")).otherwise(shipped))
    )
    return joined.select(
        F.concat(F.lit("SBM-"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string"))
        .alias("submission_id"),
        F.col("happened").cast("date").alias("submission_date"),
        F.col("happened").alias("submission_timestamp"),
        F.when(F.col("l_orderkey") % GHOST_EVENT_ORDER_MOD == 0, F.lit(GHOST_ACCOUNT))
        .otherwise(_acc(cust)).alias("account_id"),
        F.concat(F.lit("P"), (F.col("p_size") % PRODUCT_MOD).cast("string")).alias("product"),
        F.when((F.col("c_mktsegment") == SHARED_USER_SEGMENT) & (cust % 5 < 4), F.lit("USR-0"))
        .otherwise(F.concat(F.lit("USR-"), (F.col("l_suppkey") % USER_MOD).cast("string"))).alias("user_id"),
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "accounts": raw_accounts(spark, sf_dir),
        "subscriptions": raw_subscriptions(spark, sf_dir),
        "submissions": raw_submissions(spark, sf_dir),
    }
