"""Any number of named, perhaps overlapping, date windows over the events.

The windows' bounds cut the calendar into elementary intervals, in each of which
the same windows are open.  An event's interval is found by binary search over
the bounds, written as a balanced tree of comparisons in the projection, and the
interval's windows are exploded: no range join, and the events are read once.
Beyond ``TREE_BOUNDS`` bounds the windows are listed by day instead and the
events meet them by an equality join on the date."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TREE_BOUNDS = 256
Window = tuple[str, date, date]  # name, first and last day


def elementary_intervals(windows: Sequence[Window]) -> tuple[list[date], list[list[str]]]:
    """The sorted bounds, and the windows open from each bound (inclusive) to the next."""
    bounds = sorted({a for _, a, b in windows if a <= b} | {b + timedelta(days=1) for _, a, b in windows if a <= b})
    return bounds, [sorted({name for name, a, b in windows if a <= bound <= b}) for bound in bounds]


def interval_of(day: Column, bounds: list[date]) -> Column:
    """How many bounds are on or before the day, by binary search; NULL for NULL."""
    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(day < F.lit(bounds[middle]), search(low, middle)).otherwise(search(middle + 1, high))

    return F.when(day.isNotNull(), search(0, len(bounds)))


def tag_windows(events: DataFrame, windows: Sequence[Window], date_col: str = "submission_date", tag: str = "window_name") -> DataFrame:
    """Every event once for each window that its date is in."""
    if not windows:
        return events.withColumn(tag, F.lit("")).limit(0)
    bounds, open_ = elementary_intervals(windows)
    if len(bounds) > TREE_BOUNDS:
        return _by_day(events, windows, date_col, tag)
    names = F.array(*[F.array(*[F.lit(n) for n in own]).cast("array<string>") for own in open_], F.array().cast("array<string>"))
    at = interval_of(F.col(date_col), bounds)
    return events.withColumn(tag, F.explode(F.get(names, at - 1)))


def _by_day(events: DataFrame, windows: Sequence[Window], date_col: str, tag: str) -> DataFrame:
    spark = events.sparkSession
    spans = spark.createDataFrame([(n, a, b) for n, a, b in windows if a <= b], f"`{tag}` string, _first date, _last date")
    days = spans.select(tag, F.explode(F.sequence("_first", "_last")).alias(date_col)).distinct()
    return events.join(days, date_col)


def window_activity(stg_submissions: DataFrame, windows: Sequence[Window]) -> DataFrame:
    """Per (window, account) with any event in it: submissions, active users, products used
    and the last day.  Events are combined per (window, account, user, product) first; each
    combination then counts once under its user and once under its product."""
    tagged = tag_windows(stg_submissions.select("account_id", "user_id", "product", "submission_date"), windows)
    seen = tagged.groupBy("window_name", "account_id", "user_id", "product").agg(
        F.count(F.lit(1)).alias("n"), F.max("submission_date").alias("last"))
    keyed = seen.select("window_name", "account_id", "last", F.explode(F.array(
        F.struct(F.lit("u").alias("kind"), F.col("user_id").alias("key"), F.col("n")),
        F.struct(F.lit("p").alias("kind"), F.col("product").alias("key"), F.lit(0).cast("bigint").alias("n")))).alias("k"))
    keys = keyed.groupBy("window_name", "account_id", F.col("k.kind").alias("kind"), F.col("k.key").alias("key")).agg(
        F.sum("k.n").alias("n"), F.max("last").alias("last"))
    filled = lambda kind: F.count_if((F.col("kind") == kind) & F.col("key").isNotNull())
    return keys.groupBy("window_name", "account_id").agg(
        F.sum("n").alias("submissions"), filled("u").alias("active_users"), filled("p").alias("products_active"),
        F.max("last").alias("last_submission_date"))
