"""Account dimensions and engagement metrics.

Two shapes of the engagement step are provided:

* the plain products (``period_metrics``, ``user_flags``, ``growth_accounting``)
  follow the original definitions one aggregate each; conditional distinct
  counts make Spark expand every event row once per distinct aggregate;
* ``engagement_summary`` computes the same columns in one fused chain of
  pre-aggregations: (account, user, product) -> (account, user) and
  (account, product) -> account.  Every level is a hash aggregate with a
  map-side partial step, so only partial rows cross the network and a hot
  account or user is combined on the map side before its shuffle.

Tests assert both shapes agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_CONFIG, ScoreConfig
from ..functions.scores import safe_div, submissions_per_user

RECENT, PRIOR = "recent", "prior"


# ---------------------------------------------------------------- dimensions
def subscription_summary(stg_subscriptions: DataFrame) -> DataFrame:
    """Total ARR and distinct subscribed products per account."""
    return stg_subscriptions.groupBy("account_id").agg(
        F.sum("arr_usd").alias("total_arr"),
        F.count_distinct("product").alias("products_subscribed"),
    )


def days_to_renewal(cfg: ScoreConfig) -> dict[str, Column]:
    return {"days_to_renewal": F.datediff(F.col("renewal_date"), F.lit(cfg.as_of))}


def account_dimensions(stg_accounts: DataFrame, stg_subscriptions: DataFrame,
                       cfg: ScoreConfig = DEFAULT_CONFIG) -> DataFrame:
    """Every account, days to renewal from the as-of date, subscription totals (0 if none)."""
    summary = subscription_summary(stg_subscriptions)
    return stg_accounts.join(summary, "account_id", "left").select(
        "account_id", "account_name", "division", "region", "segment", "country",
        "customer_since", "csm_owner", "renewal_date",
        days_to_renewal(cfg)["days_to_renewal"].alias("days_to_renewal"),
        F.coalesce(F.col("total_arr"), F.lit(0).cast("decimal(28,4)")).alias("total_arr"),
        F.coalesce(F.col("products_subscribed"), F.lit(0).cast("bigint")).alias("products_subscribed"),
    )


# ------------------------------------------------------------------- periods
def period_of(cfg: ScoreConfig, date_col: str = "submission_date"):
    d = F.col(date_col)
    return (F.when(d.between(F.lit(cfg.recent_start), F.lit(cfg.recent_end)), F.lit(RECENT))
            .when(d.between(F.lit(cfg.prior_start), F.lit(cfg.prior_end)), F.lit(PRIOR)))


def _is_historical(cfg: ScoreConfig):
    """Outside both windows and before the prior window starts."""
    return F.col("period").isNull() & (F.col("submission_date") < F.lit(cfg.prior_start))


def tag_periods(stg_submissions: DataFrame, cfg: ScoreConfig = DEFAULT_CONFIG) -> DataFrame:
    """Every event tagged recent / prior / NULL."""
    return stg_submissions.select(
        "account_id", "user_id", "product", "submission_date", period_of(cfg).alias("period"))


def last_activity(stg_submissions: DataFrame) -> DataFrame:
    """Last submission date over the whole history."""
    return stg_submissions.groupBy("account_id").agg(F.max("submission_date").alias("last_submission_date"))


# -------------------------------------------------------------- plain shapes
def period_metrics(periods: DataFrame, cfg: ScoreConfig = DEFAULT_CONFIG) -> DataFrame:
    """D8 (plain): per account with any event, period counts, distinct users and products."""
    recent = F.col("period") == RECENT
    prior = F.col("period") == PRIOR
    agg = periods.groupBy("account_id").agg(
        F.max("submission_date").alias("last_submission_date"),
        F.count(F.when(recent, F.lit(1))).alias("recent_submissions"),
        F.count(F.when(prior, F.lit(1))).alias("prior_submissions"),
        F.count_distinct(F.when(recent, F.col("user_id"))).alias("recent_mau"),
        F.count_distinct(F.when(prior, F.col("user_id"))).alias("prior_mau"),
        F.count_distinct(F.when(recent, F.col("product"))).alias("products_active_recent"),
    )
    return agg.withColumn(
        "days_since_last_submission", F.datediff(F.lit(cfg.as_of), F.col("last_submission_date")))


def user_flags(periods: DataFrame, cfg: ScoreConfig = DEFAULT_CONFIG) -> DataFrame:
    """Per (account, user) 0/1 flags for recent, prior and historical activity."""
    def flag(cond):
        return F.max(F.when(cond, F.lit(1)).otherwise(F.lit(0)))
    return periods.groupBy("account_id", "user_id").agg(
        flag(F.col("period") == RECENT).alias("active_recent"),
        flag(F.col("period") == PRIOR).alias("active_prior"),
        flag(_is_historical(cfg)).alias("active_historical"),
    )


def _growth_columns(r, p, h):
    """The four user buckets from per-user recent / prior / historical predicates."""
    retained = F.count_if(r & p)
    new = F.count_if(r & ~p & ~h)
    resurrected = F.count_if(r & ~p & h)
    churned = F.count_if(~r & p)
    return retained, new, resurrected, churned


def _churn_rate(retained="retained_users", churned="churned_users"):
    return F.round(safe_div(churned, F.col(retained) + F.col(churned)), 3)


def growth_accounting(flags: DataFrame) -> DataFrame:
    """Retained / new / resurrected / churned users and churn rate (NULL without prior users)."""
    r = F.col("active_recent") == 1
    p = F.col("active_prior") == 1
    h = F.col("active_historical") == 1
    retained, new, resurrected, churned = _growth_columns(r, p, h)
    return flags.groupBy("account_id").agg(
        retained.alias("retained_users"), new.alias("new_users"),
        resurrected.alias("resurrected_users"), churned.alias("churned_users"),
    ).withColumn("user_churn_rate", _churn_rate())


# --------------------------------------------------------------- fused shape
ENGAGEMENT_COLUMNS = (
    "account_id", "last_submission_date", "recent_submissions", "prior_submissions",
    "recent_mau", "prior_mau", "products_active_recent", "days_since_last_submission",
    "retained_users", "new_users", "resurrected_users", "churned_users", "user_churn_rate",
)


def engagement_summary(stg_submissions: DataFrame, cfg: ScoreConfig = DEFAULT_CONFIG) -> DataFrame:
    """D7+D8+D10 in one chain of pre-aggregations, one row per account with events.

    events -> (account, user, product) -> each row emitted once keyed by its
    user and once by its product -> (account, kind, key) -> account.  The
    (account, kind, key) level gives per-user flags (MAU, growth buckets) and
    per-product activity in the same pass, so the event scan and the dedup
    run once and every shuffle carries pre-aggregated rows."""
    tagged = tag_periods(stg_submissions, cfg)
    per_user_product = tagged.groupBy("account_id", "user_id", "product").agg(
        F.count_if(F.col("period") == RECENT).alias("rc"),
        F.count_if(F.col("period") == PRIOR).alias("pc"),
        F.max(F.coalesce(_is_historical(cfg), F.lit(False))).alias("hist"),
        F.max("submission_date").alias("last"),
    )
    keyed = per_user_product.select(
        "account_id", "rc", "pc", "hist", "last",
        F.explode(F.array(
            F.struct(F.lit("u").alias("kind"), F.col("user_id").alias("key")),
            F.struct(F.lit("p").alias("kind"), F.col("product").alias("key")),
        )).alias("k"),
    )
    per_key = keyed.groupBy("account_id", F.col("k.kind").alias("kind"), F.col("k.key").alias("key")).agg(
        F.sum("rc").alias("rc"), F.sum("pc").alias("pc"),
        F.max("hist").alias("hist"), F.max("last").alias("last"),
    )
    user = F.col("kind") == "u"
    r, p, h = user & (F.col("rc") > 0), user & (F.col("pc") > 0), F.col("hist")
    retained, new, resurrected, churned = _growth_columns(r, p, h)
    sum_user = lambda c: F.sum(F.when(user, F.col(c)))
    per_account = per_key.groupBy("account_id").agg(
        F.max("last").alias("last_submission_date"),
        sum_user("rc").alias("recent_submissions"),
        sum_user("pc").alias("prior_submissions"),
        # NULL user ids form a growth group but are no distinct active user
        F.count_if(r & F.col("key").isNotNull()).alias("recent_mau"),
        F.count_if(p & F.col("key").isNotNull()).alias("prior_mau"),
        F.count_if((F.col("kind") == "p") & (F.col("rc") > 0) & F.col("key").isNotNull())
        .alias("products_active_recent"),
        retained.alias("retained_users"), new.alias("new_users"),
        resurrected.alias("resurrected_users"),
        churned.alias("churned_users"),
    )
    return per_account.select(
        "account_id", "last_submission_date", "recent_submissions", "prior_submissions",
        "recent_mau", "prior_mau", "products_active_recent",
        F.datediff(F.lit(cfg.as_of), F.col("last_submission_date")).alias("days_since_last_submission"),
        "retained_users", "new_users", "resurrected_users", "churned_users",
        _churn_rate().alias("user_churn_rate"),
    )


def plain_engagement(stg_submissions: DataFrame, cfg: ScoreConfig = DEFAULT_CONFIG) -> DataFrame:
    """The same columns as ``engagement_summary`` from the plain D8/D9/D10 products."""
    periods = tag_periods(stg_submissions, cfg)
    metrics = period_metrics(periods, cfg)
    growth = growth_accounting(user_flags(periods, cfg))
    return metrics.join(growth, "account_id", "left").select(*ENGAGEMENT_COLUMNS)


# ------------------------------------------------------------- activity rate
def activity_rate(metrics: DataFrame, dims: DataFrame) -> DataFrame:
    """Recent submissions per active user, for accounts with any history."""
    return metrics.join(dims.select("account_id", "division", "segment"), "account_id").select(
        "account_id", "division", "segment",
        submissions_per_user().alias("recent_submissions_per_mau"),
    )
