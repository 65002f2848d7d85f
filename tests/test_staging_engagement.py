"""Staging rules, period windows, growth buckets; fused engagement equals the plain products."""

from datetime import date, datetime
from decimal import Decimal

from acctpulse.config import DEFAULT_CONFIG as CFG
from acctpulse.config import FIXTURE_CONFIG
from acctpulse.operators import engagement as E
from acctpulse.operators.mart import stage_all
from acctpulse.operators.staging import stage_accounts, stage_submissions, stage_subscriptions

ACC_SCHEMA = ("account_id string, account_name string, division string, region string, segment string, "
              "country string, customer_since string, csm_owner string, renewal_date string")
SUB_SCHEMA = ("subscription_id string, account_id string, product string, arr_usd decimal(18,4), "
              "term_start_date string, term_end_date string, status string")
EV_SCHEMA = ("submission_id string, submission_date date, submission_timestamp timestamp_ntz, "
             "account_id string, product string, user_id string")


def accounts(spark):
    rows = [
        ("A1", "One", "higher ed", "NAM", "SMB", "US", "2020-01-01", "", "2025-09-28"),
        ("A2", "Two", "HighEd", None, "District", "US", "2020-01-01", "C", "2025-07-01"),
        ("A3", "Three", "K12", "EMEA", "School", "FR", "2020-01-01", None, "2026-01-01"),
        ("A4", "Four", "highered", "APAC", "SMB", "JP", "2020-01-01", "C", "2025-06-20"),
        (None, "NoId", "k12", "APAC", "SMB", "JP", "2020-01-01", "C", "2025-06-20"),
    ]
    return spark.createDataFrame(rows, ACC_SCHEMA)


def test_stage_accounts(spark):
    out = {r.account_name: r for r in stage_accounts(accounts(spark), CFG).collect()}
    assert "NoId" not in out
    assert out["One"].division == "Higher Ed"
    assert out["Two"].division == "HighEd"   # not a known spelling after lower(): passed through
    assert out["Four"].division == "Higher Ed"
    assert out["Two"].region == "Unknown"
    assert out["One"].csm_owner == ""       # blank kept as is
    assert out["One"].renewal_date == date(2025, 9, 28)


def test_stage_subscriptions(spark):
    stg_a = stage_accounts(accounts(spark), CFG)
    rows = [("S1", "A1", "P", Decimal("10"), "2025-01-01", "2026-01-01", "Active"),
            ("S2", "A1", "P", Decimal("0"), "2025-01-01", "2026-01-01", "Cancelled"),
            ("S3", "GHOST", "P", Decimal("10"), "2025-01-01", "2026-01-01", "Active"),
            ("S4", "A2", "Q", Decimal("5"), "2025-01-01", "2026-01-01", "Cancelled")]
    out = stage_subscriptions(spark.createDataFrame(rows, SUB_SCHEMA), stg_a).collect()
    assert sorted(r.subscription_id for r in out) == ["S1", "S4"]   # status not filtered
    assert {r.term_start_date for r in out} == {date(2025, 1, 1)}


def test_dedup_prefers_dated_copy_and_drops_ghosts(spark):
    stg_a = stage_accounts(accounts(spark), CFG)
    ts = datetime(2025, 5, 1, 9, 0)
    rows = [
        ("E1", date(2025, 5, 1), None, "A1", "P", "u1"),
        ("E1", date(2025, 5, 1), ts, "A1", "P", "u2"),
        ("E2", date(2025, 5, 1), ts, "GHOST", "P", "u1"),
        ("E2", date(2025, 5, 2), datetime(2025, 5, 2), "A1", "P", "u3"),
        ("E3", date(2025, 5, 1), ts, "A1", "Q", "u9"),
        ("E3", date(2025, 5, 1), ts, "A1", "P", "u9"),
    ]
    out = {r.submission_id: r for r in
           stage_submissions(spark.createDataFrame(rows, EV_SCHEMA), stg_a, CFG).collect()}
    assert out["E1"].user_id == "u2"          # NULL timestamp sorts last
    assert out["E2"].user_id == "u3"          # ghost copy dropped before dedup
    assert out["E3"].product == "P"           # tie broken by the remaining columns
    assert len(out) == 3


def _events(spark):
    d = date
    rows = [
        # u1: recent + prior -> retained
        ("1", d(2025, 4, 1), "A1", "P", "u1"), ("2", d(2025, 3, 31), "A1", "P", "u1"),
        # u2: recent only, history before prior window -> resurrected
        ("3", d(2025, 6, 30), "A1", "Q", "u2"), ("4", d(2024, 12, 31), "A1", "Q", "u2"),
        # u3: recent only, no history -> new
        ("5", d(2025, 5, 5), "A1", "P", "u3"),
        # u4: prior only -> churned
        ("6", d(2025, 1, 1), "A1", "P", "u4"),
        # u5: only after the as-of date -> no bucket, but moves the last date
        ("7", d(2025, 7, 3), "A1", "P", "u5"),
        # A3: prior activity only
        ("8", d(2025, 2, 1), "A3", "P", "x1"),
    ]
    return spark.createDataFrame(
        [(i, dt, datetime(dt.year, dt.month, dt.day), a, p, u) for i, dt, a, p, u in rows], EV_SCHEMA)


def test_periods_growth_and_fused_equals_plain(spark):
    ev = _events(spark)
    fused = {r.account_id: r for r in E.engagement_summary(ev, CFG).collect()}
    plain = {r.account_id: r for r in E.plain_engagement(ev, CFG).collect()}
    assert fused == plain
    a1 = fused["A1"]
    assert (a1.recent_submissions, a1.prior_submissions, a1.recent_mau, a1.prior_mau) == (3, 2, 3, 2)
    assert a1.products_active_recent == 2
    assert (a1.retained_users, a1.new_users, a1.resurrected_users, a1.churned_users) == (1, 1, 1, 1)
    assert a1.recent_mau == a1.retained_users + a1.new_users + a1.resurrected_users
    assert a1.user_churn_rate == 0.5
    assert a1.last_submission_date == date(2025, 7, 3)
    assert a1.days_since_last_submission == -3
    a3 = fused["A3"]
    assert (a3.recent_mau, a3.prior_mau, a3.churned_users, a3.user_churn_rate) == (0, 1, 1, 1.0)


def test_churn_rate_null_without_prior_users(spark):
    ev = spark.createDataFrame([("1", date(2025, 5, 1), datetime(2025, 5, 1), "A1", "P", "u1")], EV_SCHEMA)
    g = E.growth_accounting(E.user_flags(E.tag_periods(ev, CFG), CFG)).collect()[0]
    assert g.user_churn_rate is None and g.new_users == 1


def test_fused_equals_plain_on_driver_tables(spark, raw_small):
    staged = stage_all(raw_small, FIXTURE_CONFIG)
    fused = E.engagement_summary(staged.submissions, FIXTURE_CONFIG)
    plain = E.plain_engagement(staged.submissions, FIXTURE_CONFIG)
    assert fused.count() == plain.count()
    assert fused.exceptAll(plain).count() == 0 and plain.exceptAll(fused).count() == 0
