"""Staging (D1-D3): clean the three raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT_CONFIG, ScoreConfig
from ..session import cut_lineage
from .seen_twice import PossibleRepeats


def stage_accounts(accounts: DataFrame, cfg: ScoreConfig = DEFAULT_CONFIG) -> DataFrame:
    """Drop null ids, fold division spellings, fill missing regions, type the dates."""
    lower_div = F.lower(F.col("division"))
    division = (
        F.when(lower_div.isin(*cfg.higher_ed_spellings), F.lit("Higher Ed"))
        .when(lower_div == cfg.k12_spelling, F.lit("K12"))
        .otherwise(F.col("division"))
    )
    return accounts.filter(F.col("account_id").isNotNull()).select(
        "account_id",
        "account_name",
        "segment",
        "country",
        F.col("customer_since").cast("date").alias("customer_since"),
        "csm_owner",
        F.col("renewal_date").cast("date").alias("renewal_date"),
        division.alias("division"),
        F.coalesce(F.col("region"), F.lit(cfg.unknown_region)).alias("region"),
    )


def stage_subscriptions(subscriptions: DataFrame, stg_accounts: DataFrame) -> DataFrame:
    """Paid subscriptions of known accounts.  Status is passed through."""
    return (
        subscriptions.filter(F.col("arr_usd") > 0)
        .join(stg_accounts.select("account_id"), "account_id", "left_semi")
        .select(
            "subscription_id",
            "account_id",
            "product",
            "arr_usd",
            F.col("term_start_date").cast("date").alias("term_start_date"),
            F.col("term_end_date").cast("date").alias("term_end_date"),
            "status",
        )
    )


SUBMISSION_COLUMNS = ("submission_id", "submission_date", "submission_timestamp", "account_id", "product",
                      "user_id")


def _typed_submissions(submissions: DataFrame) -> DataFrame:
    return submissions.select(
        "submission_id",
        F.col("submission_date").cast("date").alias("submission_date"),
        F.col("submission_timestamp").cast("timestamp_ntz").alias("submission_timestamp"),
        "account_id",
        "product",
        "user_id",
    )


def _first_copy(df: DataFrame, *lead) -> DataFrame:
    """First row per submission_id by (``lead``, timestamp NULL last, account,
    product, user).  ``row_number() = 1`` is planned with a partial
    per-partition limit before the single shuffle on submission_id, so a hot
    id ships at most one row per map task."""
    first = Window.partitionBy("submission_id").orderBy(
        *lead,
        F.col("submission_timestamp").asc_nulls_last(),
        F.col("account_id").asc_nulls_last(),
        F.col("product").asc_nulls_last(),
        F.col("user_id").asc_nulls_last(),
    )
    return df.withColumn("_copy", F.row_number().over(first)).filter(F.col("_copy") == 1).drop("_copy")


def _first_copies(df: DataFrame, ids: DataFrame, cfg: ScoreConfig, *lead) -> DataFrame:
    """``_first_copy`` of all rows.  With ``dedup="filter"`` only rows whose id may
    be repeated in ``ids`` are shuffled; the others pass as they are.  Beyond the
    broadcast bound of possible repeats, all rows are."""
    if cfg.dedup == "window":
        return _first_copy(df, *lead)
    repeats = PossibleRepeats(ids.select("submission_id"), "submission_id", cfg.broadcast_max_rows)
    if not repeats.bounded:
        return _first_copy(df, *lead)
    return repeats.single(df).unionByName(_first_copy(repeats.possible(df), *lead))


def stage_submissions(submissions: DataFrame, stg_accounts: DataFrame,
                      cfg: ScoreConfig = DEFAULT_CONFIG, n_accounts: int | None = None) -> DataFrame:
    """D3: events of known accounts, one row per submission_id: ghost-account
    rows are dropped first, then the first copy of each id is kept.

    * Accounts within the broadcast bound: a map-side semi join, then the dedup.
    * More accounts than that: the unknown account ids are found at account
      scale (distinct event accounts minus accounts).  When they are few
      (checked count), each event is flagged map-side against them and the
      dedup orders ghost copies last, then drops a ghost winner.  That keeps
      the first known copy, as filtering first does, and the only shuffle of
      events stays the one on submission_id.  Otherwise a shuffle semi join.

    The dedup itself shuffles all events, or only the possible repeats among
    them (``ScoreConfig.dedup``, see ``_first_copies``).
    """
    ids = stg_accounts.select("account_id")
    if n_accounts is None:
        n_accounts = ids.count()
    typed = _typed_submissions(submissions)
    if n_accounts <= cfg.broadcast_max_rows:
        return _first_copies(typed.join(F.broadcast(ids), "account_id", "left_semi"), typed, cfg).select(*SUBMISSION_COLUMNS)
    ghosts = cut_lineage(
        typed.select("account_id").filter(F.col("account_id").isNotNull()).distinct()
        .join(ids, "account_id", "left_anti"),
        "ghost_accounts")
    if ghosts.count() > cfg.broadcast_max_rows:
        return _first_copies(typed.join(ids, "account_id", "left_semi"), typed, cfg).select(*SUBMISSION_COLUMNS)
    flagged = (typed.join(F.broadcast(ghosts.withColumn("_ghost", F.lit(True))), "account_id", "left")
               .withColumn("_ghost", F.coalesce(F.col("_ghost"), F.lit(False)) | F.col("account_id").isNull()))
    return (_first_copies(flagged, typed, cfg, F.col("_ghost").asc())
            .filter(~F.col("_ghost")).select(*SUBMISSION_COLUMNS))
