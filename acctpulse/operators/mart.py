"""Component scores, composite and the account score mart.

Flow: staged tables -> account dimensions left-joined with the engagement
summary (one row per account, written once to the checkpoint folder so the
event tables are read a single time) -> peer medians -> five component
scores, composite, tier, peer percentile, statuses -> shell filter.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_CONFIG, ScoreConfig
from ..functions import scores as S
from ..session import broadcast_if_bounded, cut_lineage
from .benchmarks import MEDIAN_COL, segment_benchmarks
from .activity_state import activity_state, engagement_from_state, engagement_of_windows, of_window
from .engagement import account_dimensions, days_to_renewal, engagement_summary, plain_engagement
from .percentile import peer_percentile
from .staging import stage_accounts, stage_submissions, stage_subscriptions

MART_COLUMNS = (
    "account_id", "account_name", "division", "region", "segment", "country",
    "customer_since", "csm_owner", "total_arr", "products_subscribed", "renewal_date",
    "days_to_renewal", "recent_submissions", "prior_submissions", "recent_mau", "prior_mau",
    "products_active_recent", "last_submission_date", "days_since_last_submission",
    "submission_trend_score", "mau_trend_score", "recency_score", "product_adoption_score",
    "relative_activity_score", "composite_health_score", "health_tier", "peer_percentile_rank",
    "retained_users", "new_users", "resurrected_users", "churned_users", "user_churn_rate",
    "new_user_rate", "mau_benchmark_status", "arr_tier", "renewal_urgency", "arr_at_risk",
)
COUNT_COLUMNS = ("recent_submissions", "prior_submissions", "recent_mau", "prior_mau",
                 "products_active_recent", "retained_users", "new_users", "resurrected_users",
                 "churned_users")


class Staged:
    """The staged tables, each built when first asked for, so that a key that
    reads only accounts or subscriptions never touches the events.  The size
    checks (one aggregate over the accounts) run only where a broadcast hangs
    on them."""

    def __init__(self, raw: dict[str, DataFrame], cfg: ScoreConfig):
        self._raw, self._cfg = raw, cfg

    @cached_property
    def accounts(self) -> DataFrame:
        return stage_accounts(self._raw["accounts"], self._cfg)

    @cached_property
    def subscriptions(self) -> DataFrame:
        """Known accounts by a plain semi join: adaptive execution picks the
        broadcast from the measured size, so nothing runs here."""
        return stage_subscriptions(self._raw["subscriptions"], self.accounts)

    @cached_property
    def submissions(self) -> DataFrame:
        return stage_submissions(self._raw["submissions"], self.accounts, self._cfg, self.n_accounts)

    @cached_property
    def _sizes(self):
        groups = F.count_distinct(F.struct(*[F.col(c) for c in self._cfg.peer_group_cols]))
        return self.accounts.agg(F.count(F.lit(1)).alias("n"), groups.alias("groups")).first()

    @property
    def n_accounts(self) -> int:
        return int(self._sizes["n"])

    @property
    def n_peer_groups(self) -> int:
        return int(self._sizes["groups"])


def stage_all(raw: dict[str, DataFrame], cfg: ScoreConfig = DEFAULT_CONFIG) -> Staged:
    return Staged(raw, cfg)


def account_base(staged: Staged, cfg: ScoreConfig = DEFAULT_CONFIG, engagement: str = "fused",
                 materialize: bool = True, state: DataFrame | None = None) -> DataFrame:
    """Every account with its dimensions and engagement counts (0 when none), from
    the staged events or from an activity state of them."""
    dims = account_dimensions(staged.accounts, staged.subscriptions, cfg)
    build = engagement_summary if engagement == "fused" else plain_engagement
    eng = build(staged.submissions, cfg) if state is None else engagement_from_state(state, cfg)
    eng = eng.withColumn("_has_events", F.lit(True))
    base = _with_zeros(dims.join(eng, "account_id", "left"), dims.columns)
    return cut_lineage(base, "account_base") if materialize else base


def _with_zeros(joined: DataFrame, dims: list[str]) -> DataFrame:
    return joined.select(
        *[F.col(c) for c in dims if c != "account_id"], "account_id",
        "last_submission_date", "days_since_last_submission",
        *[F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in COUNT_COLUMNS],
        "user_churn_rate",   # NULL without prior users; the mart shows 0
        F.coalesce(F.col("_has_events"), F.lit(False)).alias("_has_events"),
    )


def account_bases(staged: Staged, configs: list[ScoreConfig], state: DataFrame) -> list[DataFrame]:
    """The account bases of configs that differ in their windows only: the state is
    read once for all of them, and the accounts and subscriptions too."""
    dims = account_dimensions(staged.accounts, staged.subscriptions, configs[0])
    eng = engagement_of_windows(state, configs).withColumn("_has_events", F.lit(True))
    wide = cut_lineage(dims.join(eng, "account_id", "left"), "account_bases")
    return [_with_zeros(wide.withColumns(days_to_renewal(cfg) | of_window(i, cfg)), dims.columns) for i, cfg in enumerate(configs)]


def with_history(base: DataFrame) -> DataFrame:
    """Accounts of the base with any event history: the grain of the
    period-metrics and growth-accounting tables."""
    return base.filter(F.col("_has_events"))


def peer_benchmarks(base: DataFrame, cfg: ScoreConfig = DEFAULT_CONFIG, median: str = "split",
                    n_accounts: int | None = None) -> DataFrame:
    """D11-D12 from the account base: only accounts with event history take part
    (at most ``n_accounts`` rows)."""
    rate = with_history(base).select(
        "account_id", *cfg.peer_group_cols, S.submissions_per_user().alias("recent_submissions_per_mau"))
    return segment_benchmarks(rate, cfg.peer_group_cols, method=median, row_bound=n_accounts)


def own_scores(cfg: ScoreConfig) -> dict:
    """The scores and statuses that need neither the peer median nor the composite."""
    return {
        "submission_trend_score": S.submission_trend_score(cfg),
        "mau_trend_score": S.mau_trend_score(cfg),
        "recency_score": S.recency_score(cfg),
        "product_adoption_score": S.product_adoption_score(cfg),
        "mau_benchmark_status": S.mau_benchmark_status(cfg),
        "arr_tier": S.arr_tier(cfg),
        "new_user_rate": S.new_user_rate(),
    }


def score_components(base: DataFrame, benchmarks: DataFrame, cfg: ScoreConfig = DEFAULT_CONFIG,
                     n_peer_groups: int | None = None) -> DataFrame:
    """D13-D19, D21-D25 on every account (shells included)."""
    g = list(cfg.peer_group_cols)
    if n_peer_groups is not None:
        benchmarks = broadcast_if_bounded(benchmarks, n_peer_groups, cfg.broadcast_max_rows)
    # plain equality: a NULL segment finds no peer median (relative score 0)
    bench = benchmarks.select(*[F.col(c).alias(f"_b_{c}") for c in g], MEDIAN_COL)
    cond = [base[c] == bench[f"_b_{c}"] for c in g]
    joined = base.join(bench, cond, "left").drop(*[f"_b_{c}" for c in g])
    # each step reads the columns the previous one defined
    return (
        joined.withColumns(own_scores(cfg) | {
            "user_churn_rate": F.coalesce(F.col("user_churn_rate"), F.lit(0.0)),
            "recent_submissions_per_mau": S.submissions_per_user()})
        .withColumn("relative_activity_score", S.relative_activity_score(cfg))
        .withColumn("composite_health_score", S.composite_score(cfg))
        .withColumns({
            "health_tier": S.health_tier(cfg), "renewal_urgency": S.renewal_urgency(cfg),
            "arr_at_risk": S.arr_at_risk(cfg)})
    )


def with_peer_percentile(scored: DataFrame, cfg: ScoreConfig = DEFAULT_CONFIG, method: str = "histogram",
                         n_peer_groups: int | None = None) -> DataFrame:
    bound = None if n_peer_groups is None else n_peer_groups * cfg.composite_domain_size()
    return peer_percentile(scored, method, cfg.peer_group_cols, row_bound=bound,
                           max_broadcast_rows=cfg.broadcast_max_rows)


def exclude_shells(df: DataFrame) -> DataFrame:
    """Keep accounts with a subscription or any event history."""
    return df.filter((F.col("products_subscribed") > 0) | F.col("days_since_last_submission").isNotNull())


def scored_accounts(raw: dict[str, DataFrame], cfg: ScoreConfig = DEFAULT_CONFIG, *,
                    engagement: str = "fused", median: str = "split", percentile: str = "histogram",
                    materialize: bool = True) -> DataFrame:
    """Every account with all scores and the peer percentile (before the shell filter)."""
    staged = stage_all(raw, cfg)
    base = account_base(staged, cfg, engagement, materialize)
    return score_base(base, cfg, staged.n_peer_groups, median=median, percentile=percentile,
                      n_accounts=staged.n_accounts)


def score_base(base: DataFrame, cfg: ScoreConfig = DEFAULT_CONFIG, n_peer_groups: int | None = None, *,
               median: str = "split", percentile: str = "histogram", n_accounts: int | None = None) -> DataFrame:
    """Scores and peer percentile over an account base (see ``account_base``)."""
    bench = peer_benchmarks(base, cfg, median, n_accounts)
    scored = score_components(base, bench, cfg, n_peer_groups)
    # percentile ranks include shell accounts: rank first, filter after
    return with_peer_percentile(scored, cfg, percentile, n_peer_groups)


def score_accounts(raw: dict[str, DataFrame], cfg: ScoreConfig = DEFAULT_CONFIG, *, ordered: bool = False,
                   **kw) -> DataFrame:
    """The 37-column account score mart."""
    mart = exclude_shells(scored_accounts(raw, cfg, **kw)).select(*MART_COLUMNS)
    if ordered:
        mart = mart.orderBy("composite_health_score", "peer_percentile_rank")
    return mart


def score_window_sets(raw: dict[str, DataFrame], configs: dict[str, ScoreConfig], state: DataFrame | None = None) -> DataFrame:
    """The marts of several window sets (``window_set`` names them), all from one
    activity state: the events are read once, or not at all if their state is given."""
    first = next(iter(configs.values()))
    alike: dict[ScoreConfig, list[str]] = {}
    for name, cfg in configs.items():
        alike.setdefault(cfg.with_windows(first.as_of, (first.recent_start, first.recent_end), (first.prior_start, first.prior_end)), []).append(name)
    marts = {}
    for shared, names in alike.items():
        staged = stage_all(raw, shared)
        if state is None:
            state = cut_lineage(activity_state(staged.submissions), "activity_state")
        for name, base in zip(names, account_bases(staged, [configs[name] for name in names], state)):
            scored = score_base(base, configs[name], staged.n_peer_groups, n_accounts=staged.n_accounts)
            marts[name] = exclude_shells(scored).select(F.lit(name).alias("window_set"), *MART_COLUMNS)
    return reduce(DataFrame.unionByName, [marts[name] for name in configs])
