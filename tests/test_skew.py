"""A third of all rows on one key: results stay whole and exact."""

from datetime import date, datetime

from pyspark.sql import functions as F

from acctpulse.config import DEFAULT_CONFIG as CFG
from acctpulse.operators import engagement as E
from acctpulse.operators.staging import stage_accounts, stage_submissions

from .test_staging_engagement import ACC_SCHEMA, EV_SCHEMA


def test_hot_account_and_hot_submission_id(spark):
    accounts = spark.createDataFrame(
        [(f"A{i}", "n", "K12", "NAM", "School", "X", "2020-01-01", "c", "2025-12-01") for i in range(20)], ACC_SCHEMA)
    rows = []
    for i in range(3000):
        hot = i % 3 == 0
        acct = "A0" if hot else f"A{1 + i % 19}"
        sid = "HOT" if i % 3 == 1 else f"S{i}"           # a third of the rows share one submission id
        day = date(2025, 4 + i % 3, 1 + i % 28)
        rows.append((sid, day, datetime(day.year, day.month, day.day, i % 24), acct, f"P{i % 4}", f"u{i % 50}"))
    ev = spark.createDataFrame(rows, EV_SCHEMA)
    staged = stage_submissions(ev, stage_accounts(accounts, CFG), CFG).cache()
    assert staged.count() == 3000 - 1000 + 1
    # the kept copy of the hot id is the earliest one by timestamp, then account, product, user
    keep = (ev.filter("submission_id = 'HOT'")
            .orderBy("submission_timestamp", "account_id", "product", "user_id").first())
    assert staged.filter("submission_id = 'HOT'").first().user_id == keep.user_id
    fused = E.engagement_summary(staged, CFG)
    plain = E.plain_engagement(staged, CFG)
    assert fused.exceptAll(plain).count() == 0 and plain.exceptAll(fused).count() == 0
    total = fused.agg(F.sum("recent_submissions")).first()[0]
    assert total == staged.filter(F.col("submission_date").between(CFG.recent_start, CFG.recent_end)).count()


def test_many_accounts_paths_equal_broadcast_path(spark, raw_small):
    """Above the broadcast bound the ghost filter runs as flag-and-order (few
    ghosts) or as a shuffle semi join (many); both equal the broadcast path."""
    from dataclasses import replace

    from acctpulse.config import FIXTURE_CONFIG

    stg_a = stage_accounts(raw_small["accounts"], FIXTURE_CONFIG)
    ref = stage_submissions(raw_small["submissions"], stg_a, FIXTURE_CONFIG)
    for bound in (10, 0):   # 150 accounts > bound; 1 ghost account <= 10, > 0
        cfg = replace(FIXTURE_CONFIG, broadcast_max_rows=bound)
        got = stage_submissions(raw_small["submissions"], stg_a, cfg)
        assert got.columns == ref.columns
        assert got.exceptAll(ref).count() == 0 and ref.exceptAll(got).count() == 0, bound


def test_ghost_copy_first_is_replaced_by_known_copy(spark):
    from dataclasses import replace
    accounts = spark.createDataFrame(
        [(f"A{i}", "n", "K12", "NAM", "School", "X", "2020-01-01", "c", "2025-12-01") for i in range(3)], ACC_SCHEMA)
    ts = datetime(2025, 5, 1)
    ev = spark.createDataFrame([
        ("S1", date(2025, 5, 1), ts, "GHOST", "P", "u1"),            # earliest copy is a ghost
        ("S1", date(2025, 5, 2), datetime(2025, 5, 2), "A1", "P", "u2"),
        ("S2", date(2025, 5, 1), ts, "GHOST", "P", "u1"),            # only ghost copies
        ("S3", date(2025, 5, 1), ts, None, "P", "u1"),               # NULL account
        ("S4", date(2025, 5, 1), ts, "A2", "P", "u3"),
    ], EV_SCHEMA)
    stg_a = stage_accounts(accounts, CFG)
    for bound in (1_000, 1, 0):
        out = {r.submission_id: r.user_id for r in
               stage_submissions(ev, stg_a, replace(CFG, broadcast_max_rows=bound)).collect()}
        assert out == {"S1": "u2", "S4": "u3"}, bound
