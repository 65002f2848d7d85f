"""Data-quality checks (Q1-Q9).  Every check returns the failing rows as a
DataFrame; empty means pass.  ``run_checks`` turns a list of checks into one
summary frame (check, model, column_name, failures) with at most two passes over
a checked table: one aggregate for all that is said of its columns (nulls,
accepted values, assertions) and one for its keys (uniqueness, parents).
``column_metrics`` gives the columns' figures as plain aggregates, to be observed
while the table is computed for something else."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ARR_TIERS, HEALTH_TIERS, MAU_STATUSES, URGENCIES, ScoreConfig


# ------------------------------------------------------------- generic checks
def not_null(df: DataFrame, column: str) -> DataFrame:
    """Q1: rows where ``column`` is NULL."""
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Q2: non-NULL values seen more than once, with their count."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def accepted_values(df: DataFrame, column: str, values) -> DataFrame:
    """Q3: non-NULL values outside the accepted list, with their count."""
    return (df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values))
            .groupBy(column).agg(F.count(F.lit(1)).alias("n_records")))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Q4: non-NULL child keys with no parent row."""
    keys = parent.select(F.col(parent_column).alias(column))
    return child.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


# ----------------------------------------------------------- mart assertions
def no_negative_arr(mart: DataFrame) -> DataFrame:
    """Q5."""
    return mart.filter(VIOLATIONS["no_negative_arr"]()).select("account_id", "total_arr")


SCORE_COLUMNS = ("composite_health_score", "submission_trend_score", "mau_trend_score", "recency_score",
                 "product_adoption_score", "relative_activity_score")


def score_range(mart: DataFrame) -> DataFrame:
    """Q6: any score outside 0..100."""
    return mart.filter(VIOLATIONS["score_range"]()).select("account_id", *SCORE_COLUMNS)


def percentile_range(mart: DataFrame) -> DataFrame:
    """Q7."""
    return (mart.filter(VIOLATIONS["percentile_range"]())
            .select("account_id", "peer_percentile_rank", "division", "segment"))


def urgent_is_critical(mart: DataFrame) -> DataFrame:
    """Q8: Urgent accounts must be Critical."""
    return (mart.filter(VIOLATIONS["urgent_is_critical"]())
            .select("account_id", "health_tier", "renewal_urgency", "composite_health_score", "days_to_renewal"))


def growth_identity(mart: DataFrame) -> DataFrame:
    """Q9: recent active users = retained + new + resurrected."""
    return (mart.filter(VIOLATIONS["growth_identity"]())
            .select("account_id", "recent_mau", "retained_users", "new_users", "resurrected_users"))


def _outside(column: str):
    return (F.col(column) < 0) | (F.col(column) > 100)


# the rows that break an assertion; built on call, when a session exists
VIOLATIONS = {
    "no_negative_arr": lambda: F.col("total_arr") < 0,
    "score_range": lambda: reduce(lambda a, b: a | b, [_outside(c) for c in SCORE_COLUMNS]),
    "percentile_range": lambda: _outside("peer_percentile_rank"),
    "urgent_is_critical": lambda: (F.col("renewal_urgency") == "Urgent") & (F.col("health_tier") != "Critical"),
    "growth_identity": lambda: F.col("recent_mau") != F.col("retained_users") + F.col("new_users") + F.col("resurrected_users"),
}
ASSERTIONS = {
    "no_negative_arr": no_negative_arr,
    "score_range": score_range,
    "percentile_range": percentile_range,
    "urgent_is_critical": urgent_is_critical,
    "growth_identity": growth_identity,
}


# ------------------------------------------------------------- check catalog
@dataclass(frozen=True)
class Check:
    kind: str          # not_null | unique | accepted_values | relationships | assertion
    model: str
    column: str
    values: tuple = ()
    parent: str = ""   # model name of the parent for relationships


def catalog(cfg: ScoreConfig) -> list[Check]:
    """The column contracts of the staged, intermediate and mart tables."""
    nn = {
        "stg_accounts": ("account_id", "division", "region", "renewal_date"),
        "stg_subscriptions": ("subscription_id", "account_id", "product", "arr_usd"),
        "stg_submissions": ("submission_id", "account_id", "user_id", "product", "submission_date"),
        "account_dimensions": ("account_id", "total_arr", "products_subscribed"),
        "period_metrics": ("account_id", "recent_submissions", "recent_mau"),
        "segment_benchmarks": ("division", "segment", "median_submissions_per_mau"),
        "user_growth_accounting": ("account_id",),
        "account_score_mart": ("account_id", "composite_health_score", "health_tier", "renewal_urgency",
                               "submission_trend_score", "mau_trend_score", "recency_score",
                               "product_adoption_score", "relative_activity_score", "peer_percentile_rank"),
    }
    uq = ("stg_accounts", "stg_subscriptions", "stg_submissions", "account_dimensions", "period_metrics",
          "user_growth_accounting", "account_score_mart")
    uq_col = {"stg_subscriptions": "subscription_id", "stg_submissions": "submission_id"}
    av = (
        ("stg_accounts", "division", tuple(cfg.divisions)),
        ("stg_accounts", "region", tuple(cfg.regions)),
        ("stg_subscriptions", "product", tuple(cfg.products)),
        ("stg_submissions", "product", tuple(cfg.products)),
        ("account_score_mart", "health_tier", HEALTH_TIERS),
        ("account_score_mart", "renewal_urgency", URGENCIES),
        ("account_score_mart", "mau_benchmark_status", MAU_STATUSES),
        ("account_score_mart", "arr_tier", ARR_TIERS),
    )
    checks = [Check("not_null", m, c) for m, cols in nn.items() for c in cols]
    checks += [Check("unique", m, uq_col.get(m, "account_id")) for m in uq]
    for m, c, v in av:
        if not v:
            raise ValueError(f"no accepted values for {m}.{c}: name them in the ScoreConfig")
        checks.append(Check("accepted_values", m, c, v))
    checks += [Check("relationships", m, "account_id", parent="stg_accounts")
               for m in ("stg_subscriptions", "stg_submissions")]
    checks += [Check("assertion", "account_score_mart", name) for name in ASSERTIONS]
    return checks


def raw_catalog(cfg: ScoreConfig) -> list[Check]:
    """The staged tables' contracts, held against the uncleaned tables."""
    raw = {f"stg_{n}": f"raw_{n}" for n in ("accounts", "subscriptions", "submissions")}
    return [replace(c, model=raw[c.model]) for c in catalog(cfg) if c.model in raw]


COLUMN_KINDS = ("not_null", "accepted_values", "assertion")


def _fails(check: Check):
    """Whether a row breaks a check of its columns."""
    if check.kind == "not_null":
        return F.col(check.column).isNull()
    if check.kind == "assertion":
        return VIOLATIONS[check.column]()
    return F.col(check.column).isNotNull() & ~F.col(check.column).isin(*check.values)


def column_metrics(checks: list[Check]) -> dict[Check, F.Column]:
    """The number of rows that break each check of columns, as an aggregate."""
    return {c: F.count_if(_fails(c)) for c in checks if c.kind in COLUMN_KINDS}


def _rows(figures: DataFrame, checks: list[Check]) -> DataFrame:
    """One summary row a check from a row with their figures in columns f0, f1, ..."""
    rows = [F.struct(F.lit(c.kind).alias("check_name"), F.lit(c.model).alias("model"), F.lit(c.column).alias("column_name"),
                     F.coalesce(F.col(f"f{i}"), F.lit(0)).cast("bigint").alias("failures")) for i, c in enumerate(checks)]
    return figures.select(F.inline(F.array(*rows)))


def _column_pass(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One pass: null and assertion failures are counted per combination of the
    columns with accepted values; the failing values are then counted among the
    combinations (a failure of accepted values is one value, however many rows)."""
    listed = sorted({c.column for c in checks if c.kind == "accepted_values"})
    sums = {c: F.count_if(_fails(c)) for c in checks if c.kind != "accepted_values"}
    if not listed:
        return _rows(df.agg(*[sums[c].alias(f"f{i}") for i, c in enumerate(checks)]), checks)
    combined = df.groupBy(*listed).agg(F.count(F.lit(1)).alias("_n"), *[sums[c].alias(f"_s{i}") for i, c in enumerate(checks) if c in sums])
    return _rows(combined.agg(*[
        (F.sum(f"_s{i}") if c in sums else F.count_distinct(F.when(_fails(c), F.col(c.column)))).alias(f"f{i}")
        for i, c in enumerate(checks)]), checks)


def _key_pass(df: DataFrame, checks: list[Check], models: Mapping[str, DataFrame]) -> DataFrame:
    """One pass: rows are counted per key and check, which combines them before
    the shuffle; a parent's keys meet the counts where they lie."""
    keys = [F.struct(F.lit(i).alias("i"), F.col(c.column).cast("string").alias("key")) for i, c in enumerate(checks)]
    counts = (df.select(F.explode(F.array(*keys)).alias("k")).filter(F.col("k.key").isNotNull())
              .groupBy(F.col("k.i").alias("i"), F.col("k.key").alias("key")).agg(F.count(F.lit(1)).alias("n")))
    parents = [models[c.parent].select(F.lit(i).alias("i"), F.col("account_id").cast("string").alias("key"))
               for i, c in enumerate(checks) if c.kind == "relationships"]
    if parents:
        known = reduce(DataFrame.unionByName, parents).distinct().withColumn("known", F.lit(True))
        counts = counts.join(known, ["i", "key"], "left")
    own = lambda i: F.col("i") == i
    return _rows(counts.agg(*[
        (F.count_if(own(i) & (F.col("n") > 1)) if c.kind == "unique" else F.sum(F.when(own(i) & F.col("known").isNull(), F.col("n")))).alias(f"f{i}")
        for i, c in enumerate(checks)]), checks)


def _stored_key_pass(df: DataFrame, check: Check) -> DataFrame:
    """Uniqueness in a table bucketed by the key: no key moves."""
    return _rows(unique(df, check.column).agg(F.count(F.lit(1)).alias("f0")), [check])


def run_checks(models: Mapping[str, DataFrame], checks: list[Check], laid_out: Mapping[str, str] | None = None) -> DataFrame:
    """Summary frame (check_name, model, column_name, failures).  Only the models
    that the checks name are asked for, each at most twice: for its columns and
    for its keys.  ``laid_out`` names the column that a stored model is bucketed by;
    its repeats are counted in a pass of their own, which shuffles none of them."""
    parts = []
    for model in dict.fromkeys(c.model for c in checks):
        own = [c for c in checks if c.model == model]
        stored = [c for c in own if c.kind == "unique" and (laid_out or {}).get(model) == c.column]
        parts += [_stored_key_pass(models[model], c) for c in stored]
        own = [c for c in own if c not in stored]
        columns, keys = [c for c in own if c.kind in COLUMN_KINDS], [c for c in own if c.kind not in COLUMN_KINDS]
        if columns:
            parts.append(_column_pass(models[model], columns))
        if keys:
            parts.append(_key_pass(models[model], keys, models))
    return reduce(DataFrame.unionByName, parts)
