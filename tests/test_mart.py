"""End-to-end golden accounts and the reference's table checks on the mart."""

from datetime import date, datetime
from decimal import Decimal

from acctpulse.config import DEFAULT_CONFIG as CFG
from acctpulse.config import FIXTURE_CONFIG
from acctpulse.operators import quality as Q
from acctpulse.operators.mart import MART_COLUMNS, score_accounts, scored_accounts

from .test_staging_engagement import ACC_SCHEMA, EV_SCHEMA, SUB_SCHEMA


def golden(spark):
    acc = [
        # id, division, region, segment, renewal
        ("SHELL", "K12", "NAM", "District", "2025-08-01"),       # no subscription, no event
        ("SUBONLY", "K12", "NAM", "District", "2025-09-28"),     # subscription, no event (90 days)
        ("EVONLY", "K12", "NAM", "District", "2026-06-30"),      # events, no subscription
        ("NEWBIE", "K12", "NAM", "District", "2025-12-27"),      # recent users only (180 days)
        ("GONE", "K12", "NAM", "District", "2025-06-20"),        # prior users only, past due
        ("NULLSEG", "Higher Ed", "EMEA", None, None),            # NULL segment, NULL renewal
        ("SOLO", "Higher Ed", "EMEA", "Enterprise", "2025-12-28"),
    ]
    accounts = spark.createDataFrame(
        [(a, a.title(), d, r, s, "X", "2020-01-01", "", rn) for a, d, r, s, rn in acc], ACC_SCHEMA)
    subs = spark.createDataFrame([
        ("S1", "SUBONLY", "P", Decimal("20000"), "2025-01-01", "2026-01-01", "Active"),
        ("S2", "NEWBIE", "P", Decimal("50000.01"), "2025-01-01", "2026-01-01", "Active"),
        ("S3", "GONE", "P", Decimal("100"), "2025-01-01", "2026-01-01", "Active"),
        ("S4", "SOLO", "P", Decimal("100"), "2025-01-01", "2026-01-01", "Active"),
    ], SUB_SCHEMA)
    ev = []

    def add(acct, day, user, product="P"):
        ev.append((f"E{len(ev)}", day, datetime(day.year, day.month, day.day), acct, product, user))
    add("EVONLY", date(2025, 6, 25), "u1")
    add("NEWBIE", date(2025, 6, 29), "u1")
    add("NEWBIE", date(2025, 6, 28), "u2")
    add("GONE", date(2025, 2, 1), "u1")
    add("NULLSEG", date(2025, 6, 1), "u1")
    add("SOLO", date(2025, 6, 30), "u1")
    add("SOLO", date(2025, 3, 1), "u1")
    return {"accounts": accounts, "subscriptions": subs, "submissions": spark.createDataFrame(ev, EV_SCHEMA)}


def test_golden_accounts(spark):
    raw = golden(spark)
    everyone = {r.account_id: r for r in scored_accounts(raw, CFG).collect()}
    mart = {r.account_id: r for r in score_accounts(raw, CFG).collect()}
    assert "SHELL" not in mart and "SHELL" in everyone
    # the shell still counts in its peer group's percentile (5 District accounts)
    assert everyone["SHELL"].peer_percentile_rank == 0.0
    s = mart["SUBONLY"]
    assert (s.submission_trend_score, s.mau_trend_score, s.recency_score, s.product_adoption_score,
            s.relative_activity_score) == (0, 0, 0, 0, 0)
    assert s.mau_benchmark_status == "New" and s.last_submission_date is None
    assert s.renewal_urgency == "Urgent" and s.arr_at_risk == Decimal("20000")
    e = mart["EVONLY"]
    assert e.product_adoption_score == 0 and e.total_arr == 0 and e.arr_tier == "SMB"
    n = mart["NEWBIE"]
    assert (n.submission_trend_score, n.mau_trend_score, n.mau_benchmark_status) == (70, 70, "New")
    assert n.arr_tier == "Enterprise" and n.new_user_rate == 1.0 and n.user_churn_rate == 0.0
    g = mart["GONE"]
    assert (g.submission_trend_score, g.mau_trend_score, g.mau_benchmark_status) == (0, 0, "Red")
    assert g.new_user_rate is None and g.days_to_renewal == -10
    ns = mart["NULLSEG"]
    assert ns.relative_activity_score == 0 and ns.renewal_urgency == "Monitor" and ns.arr_at_risk == 0
    solo = mart["SOLO"]
    assert solo.peer_percentile_rank == 0.0 and solo.relative_activity_score == 80
    assert list(score_accounts(raw, CFG).columns) == list(MART_COLUMNS)


def test_reference_checks_pass_on_driver_tables(spark, raw_small):
    mart = score_accounts(raw_small, FIXTURE_CONFIG)
    for check in (Q.no_negative_arr, Q.score_range, Q.percentile_range, Q.urgent_is_critical, Q.growth_identity):
        assert check(mart).count() == 0, check.__name__
    assert Q.unique(mart, "account_id").count() == 0
    assert Q.not_null(mart, "composite_health_score").count() == 0
    assert 0 < mart.count() < 150   # shells are left out (FIXTURES.md)


def test_method_variants_agree(spark, raw_small):
    a = score_accounts(raw_small, FIXTURE_CONFIG)
    b = score_accounts(raw_small, FIXTURE_CONFIG, engagement="plain", median="percentile", percentile="window")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_mart_with_many_median_ranges(spark, raw_small, monkeypatch):
    """Force the split median onto several pinned ranges inside the full mart."""
    from acctpulse.operators import quantiles

    monkeypatch.setattr(quantiles, "ROWS_PER_RANGE", 7)
    assert quantiles.range_partitions(spark, 150) > 1
    split = score_accounts(raw_small, FIXTURE_CONFIG)
    single = score_accounts(raw_small, FIXTURE_CONFIG, median="percentile")
    assert split.exceptAll(single).count() == 0 and single.exceptAll(split).count() == 0


def planted(spark, column, value):
    """The golden mart with one value of NEWBIE replaced."""
    from pyspark.sql import functions as F

    mart = score_accounts(golden(spark), CFG)
    kind = mart.schema[column].dataType
    return mart.withColumn(column, F.when(F.col("account_id") == "NEWBIE", F.lit(value).cast(kind)).otherwise(F.col(column)))


def test_each_assertion_is_seen_to_fail(spark):
    for name, column, value in (
        ("no_negative_arr", "total_arr", -1), ("score_range", "recency_score", 101), ("score_range", "composite_health_score", -1),
        ("percentile_range", "peer_percentile_rank", 101.0), ("growth_identity", "recent_mau", 9),
    ):
        rows = Q.ASSERTIONS[name](planted(spark, column, value)).collect()
        assert [r.account_id for r in rows] == ["NEWBIE"], name
    from pyspark.sql import functions as F

    urgent = planted(spark, "renewal_urgency", "Urgent").withColumn("health_tier", F.lit("Healthy"))
    assert "NEWBIE" in {r.account_id for r in Q.urgent_is_critical(urgent).collect()}


def test_each_generic_check_is_seen_to_fail(spark):
    mart = planted(spark, "renewal_urgency", "Perhaps")
    twice = mart.union(mart.filter("account_id = 'GONE'"))
    models = {"account_score_mart": twice, "stg_accounts": mart.filter("account_id != 'SOLO'").select("account_id"),
              "stg_submissions": mart.select("account_id", "new_user_rate")}
    checks = [Q.Check("unique", "account_score_mart", "account_id"), Q.Check("accepted_values", "account_score_mart", "renewal_urgency", ("Urgent", "Watch", "Monitor")),
              Q.Check("not_null", "stg_submissions", "new_user_rate"), Q.Check("not_null", "stg_submissions", "account_id"),
              Q.Check("relationships", "stg_submissions", "account_id", parent="stg_accounts"), Q.Check("assertion", "account_score_mart", "no_negative_arr")]
    got = {(r.check_name, r.column_name): r.failures for r in Q.run_checks(models, checks).collect()}
    assert got["unique", "account_id"] == 1 and got["accepted_values", "renewal_urgency"] == 1
    assert got["not_null", "new_user_rate"] >= 1 and got["not_null", "account_id"] == 0
    assert got["relationships", "account_id"] == 1 and got["assertion", "no_negative_arr"] == 0


def test_catalog_is_whole_and_needs_products():
    import pytest

    checks = Q.catalog(FIXTURE_CONFIG)
    assert len(checks) == 55   # 33 not null, 7 unique, 8 accepted values, 2 relationships, 5 assertions
    with pytest.raises(ValueError, match="product"):
        Q.catalog(CFG)


def test_publish_checks_before_it_writes(spark, raw_small, tmp_path):
    import pytest
    from pyspark.sql import functions as F

    from acctpulse.plans.models import ChecksFailed, publish

    summary = publish({n: df.filter("segment IS NOT NULL") if n == "accounts" else df for n, df in raw_small.items()}, f"{tmp_path}/mart", FIXTURE_CONFIG)
    assert summary.count() == 55 and summary.filter("failures > 0").count() == 0
    assert spark.read.parquet(f"{tmp_path}/mart").columns == list(MART_COLUMNS)
    bad = dict(raw_small, subscriptions=raw_small["subscriptions"].withColumn("product", F.lit("P9")))
    with pytest.raises(ChecksFailed, match="accepted_values"):
        publish(bad, f"{tmp_path}/never", FIXTURE_CONFIG)
    assert not (tmp_path / "never").exists()
