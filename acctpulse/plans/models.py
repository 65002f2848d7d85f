"""The model tables of one scoring run on a single account base, their
registration as views (S3), and a run that builds, checks and writes."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, Observation

from ..config import DEFAULT_CONFIG, ScoreConfig
from ..operators import engagement as E
from ..operators import quality as Q
from ..operators.mart import (MART_COLUMNS, account_base, exclude_shells, peer_benchmarks, score_components, stage_all,
                              with_history, with_peer_percentile)
from ..session import cut_lineage
from ..sources import versions
from ..sources.raw import register_views, write_mart

DIMENSIONS = ("account_id", "account_name", "division", "region", "segment", "country", "customer_since",
              "csm_owner", "renewal_date", "days_to_renewal", "total_arr", "products_subscribed")
PERIOD_METRICS = ("account_id", "last_submission_date", "recent_submissions", "prior_submissions",
                  "recent_mau", "prior_mau", "products_active_recent", "days_since_last_submission")
GROWTH = ("account_id", "retained_users", "new_users", "resurrected_users", "churned_users", "user_churn_rate")


class Models(Mapping):
    """Staged, intermediate and mart tables by name, each built when first asked
    for.  The account base is written once and every account-level model reads
    it; staged events are a second scan, only for those who ask for them.  The
    column checks of the staged events (``watched``) are observed while the base is written."""

    NAMES = ("stg_accounts", "stg_subscriptions", "stg_submissions", "account_dimensions", "submission_periods",
             "period_metrics", "user_growth_accounting", "segment_benchmarks", "account_score_mart")

    def __init__(self, raw: dict[str, DataFrame], cfg: ScoreConfig = DEFAULT_CONFIG, watched: list[Q.Check] | None = None):
        self._staged, self._cfg = stage_all(raw, cfg), cfg
        self._watched, self._seen = Q.column_metrics(watched or []), None
        self._made: dict[str, DataFrame] = {}

    @cached_property
    def base(self) -> DataFrame:
        if not self._watched:
            return account_base(self._staged, self._cfg)
        self._seen, plain = Observation("staged events"), self._staged.submissions
        try:
            self._staged.submissions = plain.observe(self._seen, *[m.alias(f"m{i}") for i, m in enumerate(self._watched.values())])
            return account_base(self._staged, self._cfg)
        finally:
            self._staged.submissions = plain

    def observed(self) -> dict[Q.Check, int]:
        """Rows that break each watched check, seen while the base was written.  Zero
        is certain; work repeated after a lost executor may count a failing row twice."""
        self.base
        return {c: self._seen.get[f"m{i}"] for i, c in enumerate(self._watched)} if self._watched else {}

    @cached_property
    def benchmarks(self) -> DataFrame:
        return peer_benchmarks(self.base, self._cfg, n_accounts=self._staged.n_accounts)

    def _make(self, name: str) -> DataFrame:
        st, cfg = self._staged, self._cfg
        if name == "submission_periods":
            return E.tag_periods(st.submissions, cfg)
        if name == "account_dimensions":
            return self.base.select(*DIMENSIONS)
        if name == "period_metrics":
            return with_history(self.base).select(*PERIOD_METRICS)
        if name == "user_growth_accounting":
            return with_history(self.base).select(*GROWTH)
        if name == "segment_benchmarks":
            return self.benchmarks
        if name == "account_score_mart":
            scored = score_components(self.base, self.benchmarks, cfg, st.n_peer_groups)
            return exclude_shells(with_peer_percentile(scored, cfg, n_peer_groups=st.n_peer_groups)).select(*MART_COLUMNS)
        return getattr(st, name.removeprefix("stg_"))

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.NAMES:
            raise KeyError(name)
        if name not in self._made:
            self._made[name] = self._make(name)
        return self._made[name]

    def __iter__(self):
        return iter(self.NAMES)

    def __len__(self) -> int:
        return len(self.NAMES)


def register_models(raw: dict[str, DataFrame], cfg: ScoreConfig = DEFAULT_CONFIG) -> list[str]:
    """Expose every model as a temporary view for SQL users."""
    return register_views(Models(raw, cfg))


class ChecksFailed(Exception):
    """The failing checks of a run, as (check_name, model, column_name, failures)."""


def _checked(raw: dict[str, DataFrame], cfg: ScoreConfig) -> tuple[Models, DataFrame]:
    """The models of a run and the summary of all its checks, one row each.  What the write of the
    account base has shown to hold of the staged events is not checked again; anything it has not is."""
    checks = Q.catalog(cfg)
    models = Models(raw, cfg, [c for c in checks if c.model == "stg_submissions" and c.kind in Q.COLUMN_KINDS])
    held = [c for c, n in models.observed().items() if n == 0]
    spark = models.base.sparkSession
    clean = spark.createDataFrame([(c.kind, c.model, c.column, 0) for c in held], "check_name string, model string, column_name string, failures long")
    summary = Q.run_checks(models, [c for c in checks if c not in held]).unionByName(clean)
    return models, cut_lineage(summary, "check_summary")


def _raise_failures(summary: DataFrame) -> None:
    failed = summary.filter("failures > 0").collect()   # at most one row per check
    if failed:
        raise ChecksFailed([tuple(r) for r in failed])


def publish(raw: dict[str, DataFrame], target: str, cfg: ScoreConfig = DEFAULT_CONFIG) -> DataFrame:
    """One run: builds the models, runs all checks, and writes the mart only if
    none fails.  Returns the check summary (one row per check)."""
    models, summary = _checked(raw, cfg)
    _raise_failures(summary)
    write_mart(models["account_score_mart"], target)
    return summary


def publish_version(raw: dict[str, DataFrame], root: str, cfg: ScoreConfig = DEFAULT_CONFIG) -> DataFrame:
    """``publish`` for a mart that is read while it is refreshed: readers of
    ``versions.read_current`` get the version before until all checks have passed
    and the new one is whole."""
    models, summary = _checked(raw, cfg)
    _raise_failures(summary)
    versions.refresh(models["account_score_mart"], root)
    return summary
