"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
data product, plus the matching DuckDB SQL.  Results are presented in
engine-neutral types (``functions.portable``) for the cross-engine check."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FIXTURE_CONFIG, FIXTURE_QUARTERS_CONFIG, FIXTURE_WINDOWS
from ..functions.portable import portable
from ..operators import engagement as E
from ..operators import profiling as R
from ..operators import quality as Q
from ..operators.benchmarks import segment_benchmarks
from ..operators.mart import account_base, exclude_shells, own_scores, score_accounts, score_window_sets, scored_accounts, stage_all
from ..operators.range_checks import FIGURES, check_ranges, totals
from ..operators.windows import window_activity
from ..sources.fixtures import raw_tables
from . import oracle as O
from .models import PERIOD_METRICS, Models

Query = Callable[[SparkSession, str], DataFrame]

# component-score keys: the score with the inputs it reads, over every account
COMPONENTS = {
    "submission_trend_score": ("recent_submissions", "prior_submissions", "recent_mau", "prior_mau"),
    "mau_trend_score": ("recent_mau", "prior_mau"),
    "recency_score": ("last_submission_date", "days_since_last_submission"),
    "product_adoption_score": ("products_subscribed", "products_active_recent"),
    "relative_activity_score": ("division", "segment", "recent_submissions_per_mau",
                                "median_submissions_per_mau"),
    "composite_health_score": ("submission_trend_score", "mau_trend_score", "recency_score",
                               "product_adoption_score", "relative_activity_score"),
    "health_tier": ("composite_health_score",),
    "peer_percentile_rank": ("division", "segment", "composite_health_score"),
    "mau_benchmark_status": ("recent_mau", "prior_mau"),
    "arr_tier": ("total_arr",),
    "new_user_rate": ("new_users", "recent_mau"),
    "renewal_urgency": ("days_to_renewal", "composite_health_score"),
    "arr_at_risk": ("total_arr", "renewal_urgency"),
}


def _staged(spark, sf_dir, cfg=FIXTURE_CONFIG):
    return stage_all(raw_tables(spark, sf_dir), cfg)


def _periods(spark, sf_dir, cfg=FIXTURE_CONFIG):
    return E.tag_periods(_staged(spark, sf_dir, cfg).submissions, cfg)


def _component(name: str) -> Query:
    """The score over every account, from no more than it needs: the dimensions,
    the account base, or (with a peer median or composite in it) all scores."""
    def run(spark, sf_dir, cfg=FIXTURE_CONFIG):
        if name == "arr_tier":
            frame = _dimensions(spark, sf_dir).withColumn(name, own_scores(cfg)[name])
        elif name in own_scores(cfg):
            frame = account_base(_staged(spark, sf_dir), cfg, materialize=False).withColumn(name, own_scores(cfg)[name])
        else:
            frame = scored_accounts(raw_tables(spark, sf_dir), cfg)
        return portable(frame.select("account_id", *COMPONENTS[name], name))
    return run


def _checks(kind: str) -> Query:
    def run(spark, sf_dir):
        checks = [c for c in Q.catalog(FIXTURE_CONFIG) if c.kind == kind]
        return portable(Q.run_checks(Models(raw_tables(spark, sf_dir), FIXTURE_CONFIG), checks))
    return run


def _raw_checks(kind: str) -> Query:
    """The staged tables' checks on the uncleaned tables, where they do fail."""
    def run(spark, sf_dir):
        raw = raw_tables(spark, sf_dir)
        models = {f"raw_{n}": df for n, df in raw.items()} | {"stg_accounts": stage_all(raw, FIXTURE_CONFIG).accounts}
        return portable(Q.run_checks(models, [c for c in Q.raw_catalog(FIXTURE_CONFIG) if c.kind == kind]))
    return run


def _key_ranges(spark, sf_dir):
    """Q2 of the submission ids and Q4 of their accounts on the raw tables, by ranges of hashes."""
    raw = raw_tables(spark, sf_dir)
    ids = totals(check_ranges(raw["submissions"], "submission_id")).select(F.lit("submission_id").alias("key_name"), *FIGURES)
    accounts = totals(check_ranges(raw["submissions"], "account_id", raw["accounts"])).select(F.lit("account_id").alias("key_name"), *FIGURES)
    return portable(ids.unionByName(accounts))


def _mart_check(fn) -> Query:
    return lambda spark, sf_dir: portable(fn(score_accounts(raw_tables(spark, sf_dir), FIXTURE_CONFIG)))


def _raw_report(fn, *tables) -> Query:
    def run(spark, sf_dir):
        raw = raw_tables(spark, sf_dir)
        return portable(fn(*[raw[t] for t in tables]))
    return run


def queries() -> dict[str, Query]:
    cfg = FIXTURE_CONFIG
    q: dict[str, Query] = {
        # staging
        "stg_accounts": lambda s, d: portable(_staged(s, d).accounts),
        "stg_subscriptions": lambda s, d: portable(_staged(s, d).subscriptions),
        "stg_submissions": lambda s, d: portable(_staged(s, d).submissions),
        "stg_submissions_filtered": lambda s, d: portable(_staged(s, d, replace(cfg, dedup="filter")).submissions),
        # intermediate
        "subscription_summary": lambda s, d: portable(E.subscription_summary(_staged(s, d).subscriptions)),
        "account_dimensions": lambda s, d: portable(_dimensions(s, d)),
        "submission_periods": lambda s, d: portable(_periods(s, d)),
        "account_recency": lambda s, d: portable(E.last_activity(_staged(s, d).submissions)),
        "period_metrics": lambda s, d: portable(E.engagement_summary(_staged(s, d).submissions, cfg).select(*PERIOD_METRICS)),
        "engagement_summary": lambda s, d: portable(E.engagement_summary(_staged(s, d).submissions, cfg)),
        "user_activity_flags": lambda s, d: portable(E.user_flags(_periods(s, d), cfg)),
        "user_growth_accounting": lambda s, d: portable(E.growth_accounting(E.user_flags(_periods(s, d), cfg))),
        "account_activity_rate": lambda s, d: portable(_activity_rate(s, d)),
        "segment_benchmarks": lambda s, d: portable(_benchmarks(s, d)),
        "window_activity": lambda s, d: portable(window_activity(_staged(s, d).submissions, FIXTURE_WINDOWS)),
    }
    q.update({name: _component(name) for name in COMPONENTS})
    q.update({
        "shell_account_exclusion": lambda s, d: portable(
            exclude_shells(account_base(_staged(s, d), cfg, materialize=False))
            .select("account_id", "products_subscribed", "days_since_last_submission")),
        "account_score_mart": lambda s, d: portable(score_accounts(raw_tables(s, d), cfg)),
        "account_score_mart_quarters": lambda s, d: portable(score_accounts(raw_tables(s, d), FIXTURE_QUARTERS_CONFIG)),
        "account_score_mart_window_sets": lambda s, d: portable(
            score_window_sets(raw_tables(s, d), {"years": cfg, "quarters": FIXTURE_QUARTERS_CONFIG})),
        # data quality
        "dq_not_null": _checks("not_null"),
        "dq_unique": _checks("unique"),
        "dq_accepted_values": _checks("accepted_values"),
        "dq_relationships": _checks("relationships"),
        "dq_raw_not_null": _raw_checks("not_null"),
        "dq_raw_unique": _raw_checks("unique"),
        "dq_raw_accepted_values": _raw_checks("accepted_values"),
        "dq_raw_relationships": _raw_checks("relationships"),
        "dq_key_ranges": _key_ranges,
        "dq_no_negative_arr": _mart_check(Q.no_negative_arr),
        "dq_score_range": _mart_check(Q.score_range),
        "dq_percentile_range": _mart_check(Q.percentile_range),
        "dq_urgent_is_critical": _mart_check(Q.urgent_is_critical),
        "dq_growth_identity": _mart_check(Q.growth_identity),
        # profiling
        "profile_row_counts": lambda s, d: portable(R.row_counts(raw_tables(s, d))),
        "profile_schema": lambda s, d: portable(R.schema_report(raw_tables(s, d))),
        "profile_accounts_blanks": _raw_report(R.accounts_blanks, "accounts"),
        "profile_division_counts": _raw_report(lambda a: R.value_counts(a, "division"), "accounts"),
        "profile_region_counts": _raw_report(lambda a: R.value_counts(a, "region"), "accounts"),
        "profile_segment_counts": _raw_report(lambda a: R.value_counts(a, "segment"), "accounts"),
        "profile_subscriptions_nulls": _raw_report(R.subscriptions_nulls, "subscriptions"),
        "profile_subscriptions_by_product": _raw_report(R.subscriptions_by_product, "subscriptions"),
        "profile_arr_stats": _raw_report(R.arr_stats, "subscriptions"),
        "profile_orphan_subscriptions": _raw_report(R.orphan_subscriptions, "subscriptions", "accounts"),
        "profile_submission_date_range": _raw_report(R.submission_date_range, "submissions"),
        "profile_submissions_nulls": _raw_report(R.submissions_nulls, "submissions"),
        "profile_submissions_by_product": _raw_report(R.submissions_by_product, "submissions"),
        "profile_orphan_submissions": _raw_report(R.orphan_submissions, "submissions", "accounts"),
        "profile_ghost_accounts": _raw_report(R.ghost_accounts, "submissions", "accounts"),
        "profile_subscribed_no_submissions": _raw_report(R.subscribed_no_submissions, "subscriptions", "submissions"),
        "duplicate_submissions": _raw_report(R.duplicate_submissions, "submissions"),
    })
    return q


def _benchmarks(spark, sf_dir, cfg=FIXTURE_CONFIG):
    """Peer medians from the engagement of the accounts alone: no subscription is read."""
    staged = _staged(spark, sf_dir, cfg)
    return segment_benchmarks(_activity_rate(spark, sf_dir, cfg), cfg.peer_group_cols, row_bound=staged.n_accounts)


def _dimensions(spark, sf_dir, cfg=FIXTURE_CONFIG):
    staged = _staged(spark, sf_dir, cfg)
    return E.account_dimensions(staged.accounts, staged.subscriptions, cfg)


def _activity_rate(spark, sf_dir, cfg=FIXTURE_CONFIG):
    staged = _staged(spark, sf_dir, cfg)
    return E.activity_rate(E.engagement_summary(staged.submissions, cfg), staged.accounts)


def oracle_sql() -> dict[str, str]:
    return O.oracle_sql()
