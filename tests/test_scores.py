"""Ladder edges of every score and status (FIXTURES.md section 3)."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from acctpulse.config import DEFAULT_CONFIG as CFG
from acctpulse.config import ScoreConfig
from acctpulse.functions import scores as S


def _eval(spark, rows, schema, col):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(col).collect()]


def test_recency_edges(spark):
    days = [7, 8, 30, 31, 60, 61, 90, 91, 180, 181, -5]
    rows = [(date(2025, 1, 1), d) for d in days] + [(None, None)]
    got = _eval(spark, rows, "last_submission_date date, days_since_last_submission int", S.recency_score(CFG))
    assert got == [100, 80, 80, 60, 60, 40, 40, 20, 20, 0, 100, 0]


def test_trend_edges(spark):
    # recent_sub, recent_mau, prior_sub, prior_mau
    rows = [
        (6, 1, 5, 1),    # 1.2  -> 100
        (5, 1, 5, 1),    # 1.0  -> 80
        (4, 1, 5, 1),    # 0.8  -> 60
        (3, 1, 5, 1),    # 0.6  -> 40
        (2, 1, 5, 1),    # 0.4  -> 20
        (1, 1, 5, 1),    # 0.2  -> 0
        (3, 1, 0, 0),    # no prior users -> 70
        (0, 0, 5, 1),    # no recent users -> 0
    ]
    got = _eval(spark, rows, "recent_submissions long, recent_mau long, prior_submissions long, prior_mau long",
                S.submission_trend_score(CFG))
    assert got == [100, 80, 60, 40, 20, 0, 70, 0]


def test_mau_trend_edges(spark):
    rows = [(6, 5), (5, 5), (4, 5), (3, 5), (2, 5), (1, 5), (3, 0), (0, 5)]
    got = _eval(spark, rows, "recent_mau long, prior_mau long", S.mau_trend_score(CFG))
    assert got == [100, 80, 60, 40, 20, 0, 70, 0]


def test_adoption_edges(spark):
    rows = [(3, 2), (2, 2), (3, 4), (1, 2), (1, 4), (1, 5), (0, 1), (2, 0)]
    got = _eval(spark, rows, "products_active_recent long, products_subscribed long", S.product_adoption_score(CFG))
    assert got == [100, 100, 80, 60, 40, 20, 0, 0]


def test_relative_edges(spark):
    rows = [(2.0, 2.0), (3.0, 2.0), (1.5, 2.0), (1.0, 2.0), (0.5, 2.0), (0.4, 2.0), (1.0, 0.0), (1.0, None),
            (0.0, 2.0)]
    got = _eval(spark, rows, "recent_submissions_per_mau double, median_submissions_per_mau double",
                S.relative_activity_score(CFG))
    assert got == [80, 100, 60, 40, 20, 0, 80, 0, 0]


def test_composite_exact_and_tiers(spark):
    rows = [(100, 80, 60, 40, 20), (100, 100, 100, 100, 100), (0, 0, 0, 0, 0), (70, 70, 20, 0, 0)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} int" for n, _ in CFG.weights))
    out = df.select(S.composite_score(CFG).alias("c")).collect()
    assert [r.c for r in out] == [Decimal("70.0"), Decimal("100.0"), Decimal("0.0"), Decimal("42.5")]
    assert str(df.select(S.composite_score(CFG)).schema[0].dataType) == "DecimalType(5,1)"
    tiers = _eval(spark, [(Decimal("70.0"),), (Decimal("69.5"),), (Decimal("40.0"),), (Decimal("39.5"),)],
                  "composite_health_score decimal(5,1)", S.health_tier(CFG))
    assert tiers == ["Healthy", "At Risk", "At Risk", "Critical"]


def test_mau_status_exact_decimal(spark):
    rows = [(55, 50), (54, 50), (50, 50), (49, 50), (3, 0), (99, 90), (110, 100)]
    got = _eval(spark, rows, "recent_mau long, prior_mau long", S.mau_benchmark_status(CFG))
    assert got == ["Green", "Yellow", "Yellow", "Red", "New", "Green", "Green"]


def test_arr_tier_strict(spark):
    rows = [(Decimal(x),) for x in ("50000", "50000.01", "15000", "15000.01", "0")]
    got = _eval(spark, rows, "total_arr decimal(28,4)", S.arr_tier(CFG))
    assert got == ["Mid-Market", "Enterprise", "SMB", "Mid-Market", "SMB"]


def test_urgency_and_arr_at_risk(spark):
    rows = [(d, Decimal("39.5"), Decimal("100")) for d in (90, 91, 180, 181, -10, None)]
    df = spark.createDataFrame(rows, "days_to_renewal int, composite_health_score decimal(5,1), total_arr decimal(28,4)")
    out = df.select(S.renewal_urgency(CFG).alias("u"), S.arr_at_risk(CFG).alias("a")).collect()
    assert [r.u for r in out] == ["Urgent", "Watch", "Watch", "Monitor", "Urgent", "Monitor"]
    assert [float(r.a) for r in out] == [100, 100, 100, 0, 100, 0]


def test_new_user_rate(spark):
    got = _eval(spark, [(1, 3), (0, 0), (2, 2)], "new_users long, recent_mau long", S.new_user_rate())
    assert got == [0.333, None, 1.0]


def test_composite_domain_bound():
    assert CFG.composite_domain_size() <= 200
    assert ScoreConfig().composite_domain_size() == CFG.composite_domain_size()


@pytest.mark.parametrize("steps", [CFG.trend_steps, CFG.relative_steps, CFG.adoption_steps])
def test_ladders_descend(steps):
    th = [t for t, _ in steps]
    assert th == sorted(th, reverse=True)
