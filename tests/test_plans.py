"""Physical-plan properties the design relies on at scale."""

import contextlib
import io

from acctpulse.config import FIXTURE_CONFIG
from acctpulse.operators import engagement as E
from acctpulse.operators.mart import MART_COLUMNS, account_base, exclude_shells, score_base, stage_all


def plan(df, mode=None) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode) if mode else df.explain()
    return buf.getvalue()


def test_fused_engagement_scans_events_once_without_expand(raw_small):
    staged = stage_all(raw_small, FIXTURE_CONFIG)
    p = plan(E.engagement_summary(staged.submissions, FIXTURE_CONFIG))
    assert p.count("lineitem.parquet") == 1
    assert "Expand" not in p
    assert "WindowGroupLimit" in p            # partial top-1 per id before the dedup shuffle
    plain = plan(E.plain_engagement(staged.submissions, FIXTURE_CONFIG))
    assert "Expand" in plain                   # the plain shape expands rows per distinct aggregate


def test_scan_pruning_and_pushdown(raw_small):
    staged = stage_all(raw_small, FIXTURE_CONFIG)
    p = plan(staged.submissions, "formatted")
    # only the five lineitem columns the adapter uses are read
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int," in p
    assert "l_extendedprice" not in p
    assert "PushedFilters: [IsNotNull(l_orderkey)" in p


def test_mart_has_no_group_sized_window_or_reducer(raw_small):
    staged = stage_all(raw_small, FIXTURE_CONFIG)
    base = account_base(staged, FIXTURE_CONFIG)
    mart = exclude_shells(score_base(base, FIXTURE_CONFIG, staged.n_peer_groups, n_accounts=staged.n_accounts)).select(*MART_COLUMNS)
    p = plan(mart)
    assert "percent_rank" not in p
    assert "percentile(" not in p
    assert "BroadcastHashJoin" in p            # peer medians and rank histogram: bounded, broadcast
    assert "lineitem.parquet" not in p         # the events were read once, into the account base


def test_many_accounts_ghost_filter_does_not_shuffle_events_on_account(raw_small):
    from dataclasses import replace

    from acctpulse.operators.staging import stage_accounts, stage_submissions

    cfg = replace(FIXTURE_CONFIG, broadcast_max_rows=10)   # 150 accounts: above the bound, 1 ghost below it
    stg = stage_submissions(raw_small["submissions"], stage_accounts(raw_small["accounts"], cfg), cfg)
    p = plan(stg)
    assert "hashpartitioning(account_id" not in p
    assert "hashpartitioning(submission_id" in p and "WindowGroupLimit" in p
    assert "BroadcastHashJoin" in p and "LeftOuter" in p      # map-side flag against the unknown accounts


def test_events_are_shuffled_once_for_the_dedup(raw_small):
    """The joins of the adapter broadcast their small sides here; the only exchange
    of event rows is the one on submission_id."""
    staged = stage_all(raw_small, FIXTURE_CONFIG)
    p = plan(staged.submissions)
    shuffles = [line for line in p.splitlines() if "Exchange hashpartitioning" in line or "Exchange RoundRobin" in line]
    assert len(shuffles) == 1 and "submission_id" in shuffles[0]


def test_account_keys_never_read_the_events(spark, monkeypatch):
    from dataclasses import replace

    from acctpulse.operators import quantiles
    from acctpulse.plans import registry

    from .conftest import SMALL

    monkeypatch.setattr(quantiles, "ROWS_PER_RANGE", 7)
    monkeypatch.setattr(registry, "FIXTURE_CONFIG", replace(FIXTURE_CONFIG, broadcast_max_rows=10))
    written = []
    monkeypatch.setattr("acctpulse.session.cut_lineage", lambda df, name: written.append(name))
    for key in ("stg_accounts", "stg_subscriptions", "account_dimensions", "subscription_summary", "arr_tier"):
        p = plan(registry.queries()[key](spark, SMALL))
        assert "lineitem.parquet" not in p, key
    assert not written


def test_reports_combine_before_they_shuffle(raw_small):
    from acctpulse.operators import profiling as R

    p = plan(R.submissions_by_product(raw_small["submissions"]))
    assert "Expand" not in p
    p = plan(R.orphan_submissions(raw_small["submissions"], raw_small["accounts"]))
    assert p.count("HashAggregate") >= 3 and "lineitem.parquet" in p
    p = plan(R.duplicate_submissions(raw_small["submissions"]))
    assert "BroadcastHashJoin" in p and "hashpartitioning(submission_id" not in p
