"""Activity as a stored, mergeable state of daily counts (D7-D10 for any windows).

``activity_state`` folds staged events, once, into one row per account, user,
product and day: ``n``, the number of submissions.  Repeated submissions are
combined map-side, before the only shuffle.

States merge by the sum of the counts (``merge_states``), in any order: new or
late days are absorbed without the events before them, provided that each event
is folded into one state only.  ``engagement_from_state`` answers any recent /
prior windows and as-of date from the state with the same rows as
``engagement_summary`` has from the events, and ``engagement_of_windows``
several window sets in one pass.  The state has at most one row per event,
however often a day is submitted to; reading it emits a row by user, and one by
product only for days in a recent window."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_CONFIG, ScoreConfig
from .engagement import ENGAGEMENT_COLUMNS, _churn_rate, _growth_columns

STATE_COLUMNS = ("account_id", "user_id", "product", "day", "n")
_EPOCH = date(1970, 1, 1)
#: the columns of ``engagement_summary`` that depend on the windows
WINDOW_COLUMNS = ("recent_submissions", "prior_submissions", "recent_mau", "prior_mau", "products_active_recent",
                  "retained_users", "new_users", "resurrected_users", "churned_users")


def activity_state(stg_submissions: DataFrame) -> DataFrame:
    """The state of the events; a date of NULL is in no window, but its account, user and product are known."""
    rows = stg_submissions.select("account_id", "user_id", "product", F.unix_date("submission_date").alias("day"))
    return rows.groupBy("account_id", "user_id", "product", "day").agg(F.count(F.lit(1)).alias("n"))


def merge_states(*states: DataFrame) -> DataFrame:
    """The state of all the events of the states."""
    rows = reduce(DataFrame.unionByName, states)
    return rows.groupBy("account_id", "user_id", "product", "day").agg(F.sum("n").alias("n")).select(*STATE_COLUMNS)


def _day(d: date) -> int:
    return (d - _EPOCH).days


def _inside(first: date, last: date) -> Column:
    return F.coalesce(F.col("day").between(_day(first), _day(last)), F.lit(False))


def _periods(cfg: ScoreConfig) -> tuple[Column, Column, Column]:
    """Whether a day is recent, prior or before; as in the period tags, a day of both windows is a recent one."""
    recent = _inside(cfg.recent_start, cfg.recent_end)
    before = F.coalesce(F.col("day") < _day(cfg.prior_start), F.lit(False))
    return recent, _inside(cfg.prior_start, cfg.prior_end) & ~recent, before & ~recent


def engagement_of_windows(state: DataFrame, configs: Sequence[ScoreConfig]) -> DataFrame:
    """One row per account of the state: account_id, last_submission_date, and for the i-th
    config its ``WINDOW_COLUMNS`` as ``w<i>_<column>``.  State rows -> (account, kind, key) -> account."""
    periods = [_periods(cfg) for cfg in configs]
    user = F.struct(F.lit("u").alias("kind"), F.col("user_id").alias("key"))
    product = F.struct(F.lit("p").alias("kind"), F.col("product").alias("key"))
    any_recent = reduce(Column.__or__, [recent for recent, _, _ in periods])
    keyed = state.select("account_id", "day", "n", F.explode(F.when(any_recent, F.array(user, product)).otherwise(F.array(user))).alias("k"))
    is_user, known = F.col("kind") == "u", F.col("key").isNotNull()
    counted = lambda inside: F.sum(F.when(inside & (F.col("k.kind") == "u"), F.col("n")).otherwise(F.lit(0)))
    flags = []
    for i, (recent, prior, before) in enumerate(periods):
        flags += [F.max(recent).alias(f"r{i}"), F.max(prior).alias(f"p{i}"), F.max(before).alias(f"h{i}"),
                  counted(recent).alias(f"rc{i}"), counted(prior).alias(f"pc{i}")]
    per_key = keyed.groupBy("account_id", F.col("k.kind").alias("kind"), F.col("k.key").alias("key")).agg(F.max("day").alias("last"), *flags)
    columns = []
    for i in range(len(periods)):
        r, p, h = (is_user & F.col(f"{c}{i}") for c in "rph")
        columns += [F.sum(f"rc{i}"), F.sum(f"pc{i}"), F.count_if(r & known), F.count_if(p & known),
                    F.count_if(~is_user & known & F.col(f"r{i}")), *_growth_columns(r, p, h)]
    names = [f"w{i}_{c}" for i in range(len(periods)) for c in WINDOW_COLUMNS]
    return per_key.groupBy("account_id").agg(
        F.date_from_unix_date(F.max("last")).alias("last_submission_date"), *[c.alias(name) for c, name in zip(columns, names)])


def of_window(i: int, cfg: ScoreConfig) -> dict[str, Column]:
    """The columns of ``engagement_summary``, but account_id and last_submission_date, from those of the i-th config."""
    return ({c: F.col(f"w{i}_{c}") for c in WINDOW_COLUMNS} | {
        "days_since_last_submission": F.datediff(F.lit(cfg.as_of), F.col("last_submission_date")),
        "user_churn_rate": _churn_rate(f"w{i}_retained_users", f"w{i}_churned_users")})


def engagement_from_state(state: DataFrame, cfg: ScoreConfig = DEFAULT_CONFIG) -> DataFrame:
    """``engagement_summary`` for the windows of ``cfg``."""
    return engagement_of_windows(state, [cfg]).withColumns(of_window(0, cfg)).select(*ENGAGEMENT_COLUMNS)
