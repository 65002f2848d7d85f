"""Column builders for the component scores and statuses.

Each builder returns a ``Column`` over the joined account frame (dimensions +
engagement + peer median) so the whole scoring step is one projection inside
whole-stage codegen.  Ladders are first-match-wins ``CASE`` chains.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import ScoreConfig


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den) -> Column:
    """``num / nullif(den, 0)`` in double: NULL instead of an ANSI error."""
    return col(num).cast("double") / F.nullif(col(den), F.lit(0)).cast("double")


def ladder(value: Column, steps, otherwise: int | Column = 0, op: str = ">=") -> Column:
    """First-match-wins bands: ``steps`` are (threshold, score) from the top."""
    out = None
    for threshold, score in steps:
        cond = value >= F.lit(threshold) if op == ">=" else value <= F.lit(threshold)
        out = F.when(cond, F.lit(score)) if out is None else out.when(cond, F.lit(score))
    tail = otherwise if isinstance(otherwise, Column) else F.lit(otherwise)
    return out.otherwise(tail)


def submissions_per_user(subs="recent_submissions", users="recent_mau") -> Column:
    """Recent submissions per active user, 0.0 when nobody was active."""
    return F.when(col(users) == 0, F.lit(0.0)).otherwise(safe_div(subs, users))


def submission_trend_score(cfg: ScoreConfig) -> Column:
    ratio = (safe_div("recent_submissions", "recent_mau")
             / safe_div("prior_submissions", "prior_mau"))
    return (F.when(F.col("recent_mau") == 0, F.lit(0))
            .when(F.col("prior_mau") == 0, F.lit(cfg.no_baseline_trend_score))
            .otherwise(ladder(ratio, cfg.trend_steps)))


def mau_trend_score(cfg: ScoreConfig) -> Column:
    ratio = safe_div("recent_mau", "prior_mau")
    return (F.when(F.col("recent_mau") == 0, F.lit(0))
            .when(F.col("prior_mau") == 0, F.lit(cfg.no_baseline_trend_score))
            .otherwise(ladder(ratio, cfg.trend_steps)))


def recency_score(cfg: ScoreConfig) -> Column:
    days = F.col("days_since_last_submission")
    return (F.when(F.col("last_submission_date").isNull(), F.lit(0))
            .otherwise(ladder(days, cfg.recency_max_days, op="<=")))


def product_adoption_score(cfg: ScoreConfig) -> Column:
    ratio = safe_div("products_active_recent", "products_subscribed")
    any_active = F.when(F.col("products_active_recent") > 0, F.lit(cfg.adoption_any_active_score)).otherwise(F.lit(0))
    return (F.when(F.col("products_subscribed") == 0, F.lit(0))
            .otherwise(ladder(ratio, cfg.adoption_steps, otherwise=any_active)))


def relative_activity_score(cfg: ScoreConfig, rate="recent_submissions_per_mau",
                            median="median_submissions_per_mau") -> Column:
    ratio = col(rate) / F.nullif(col(median), F.lit(0.0))
    return (F.when(col(rate) == 0, F.lit(0))
            .when(col(median) == 0, F.lit(cfg.zero_peer_median_score))
            .otherwise(ladder(ratio, cfg.relative_steps)))


def composite_score(cfg: ScoreConfig) -> Column:
    """Exact decimal weighted sum rounded to one place (half up)."""
    total = None
    for name, weight in cfg.weights:
        term = F.col(name).cast("decimal(10,0)") * F.lit(Decimal(weight))
        total = term if total is None else total + term
    return F.round(total, 1).cast("decimal(5,1)")


def health_tier(cfg: ScoreConfig, score="composite_health_score") -> Column:
    s = col(score)
    return (F.when(s >= cfg.healthy_min, F.lit("Healthy"))
            .when(s >= cfg.at_risk_min, F.lit("At Risk"))
            .otherwise(F.lit("Critical")))


def mau_benchmark_status(cfg: ScoreConfig) -> Column:
    recent, prior = F.col("recent_mau"), F.col("prior_mau")
    # exact decimal product: 50 * 1.1 is exactly 55, unlike in double
    green_bar = prior.cast("decimal(20,0)") * F.lit(Decimal(cfg.green_mau_growth))
    return (F.when(F.coalesce(prior, F.lit(0)) == 0, F.lit("New"))
            .when(recent >= green_bar, F.lit("Green"))
            .when(recent >= prior, F.lit("Yellow"))
            .otherwise(F.lit("Red")))


def arr_tier(cfg: ScoreConfig, arr="total_arr") -> Column:
    a = col(arr)
    return (F.when(a > cfg.enterprise_arr_above, F.lit("Enterprise"))
            .when(a > cfg.mid_market_arr_above, F.lit("Mid-Market"))
            .otherwise(F.lit("SMB")))


def new_user_rate() -> Column:
    return F.round(safe_div("new_users", "recent_mau"), 3)


def _urgent(cfg):
    return (F.col("days_to_renewal") <= cfg.urgent_days) & (F.col("composite_health_score") < cfg.urgent_below)


def _watch(cfg):
    return (F.col("days_to_renewal") <= cfg.watch_days) & (F.col("composite_health_score") < cfg.watch_below)


def renewal_urgency(cfg: ScoreConfig) -> Column:
    return (F.when(_urgent(cfg), F.lit("Urgent"))
            .when(_watch(cfg), F.lit("Watch"))
            .otherwise(F.lit("Monitor")))


def arr_at_risk(cfg: ScoreConfig) -> Column:
    return F.when(_urgent(cfg) | _watch(cfg), F.col("total_arr")).otherwise(F.lit(0).cast("decimal(28,4)"))
