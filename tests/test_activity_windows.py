"""Activity states and window tables against the plain engagement products and SQL."""

import random
from dataclasses import replace
from datetime import date, timedelta

import duckdb

from acctpulse.config import FIXTURE_CONFIG, FIXTURE_QUARTERS_CONFIG, FIXTURE_WINDOWS
from acctpulse.operators import activity_state as A
from acctpulse.operators import engagement as E
from acctpulse.operators import mart
from acctpulse.operators import windows as W
from acctpulse.operators.mart import score_accounts, score_window_sets, stage_all
from tests.test_plans import plan

EVENT = "account_id string, user_id string, product string, submission_date date"


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def random_events(spark, n, seed):
    rng = random.Random(seed)
    start = date(1999, 1, 1)
    rows = [(rng.choice("abcd"), rng.choice(["u1", "u2", "u3", None]), rng.choice(["P1", "P2", None]),
             start + timedelta(days=rng.randrange(1000)) if rng.random() > 0.05 else None) for _ in range(n)]
    rows += [("old", "u1", "P1", date(1960, 2, 3)), ("old", "u2", "P1", date(1969, 12, 31)), ("none", "u9", "P2", None)]
    return spark.createDataFrame(rows, EVENT)


def configs():
    yield FIXTURE_CONFIG
    yield FIXTURE_QUARTERS_CONFIG
    day = date(2000, 2, 29)
    for recent, prior in (((day, day), (day - timedelta(days=1),) * 2), ((day, day + timedelta(days=200)), (day - timedelta(days=3), day + timedelta(days=90))),
                          ((date(1960, 1, 1), date(1969, 12, 31)), (date(1950, 1, 1), date(1959, 12, 31)))):
        yield FIXTURE_CONFIG.with_windows(recent[1], recent, prior)


def test_any_windows_from_one_state(spark):
    events = random_events(spark, 600, 1)
    state = A.activity_state(events).cache()
    for cfg in configs():
        expected = E.plain_engagement(events, cfg)
        assert same(A.engagement_from_state(state, cfg).select(*expected.columns), expected), cfg
    state.unpersist()


def test_a_late_day_is_absorbed(spark):
    events = random_events(spark, 300, 2)
    late = spark.createDataFrame([("a", "u1", "P9", date(2000, 3, 1)), ("new", "u7", "P1", date(1999, 5, 5))], EVENT)
    merged = A.merge_states(A.activity_state(events), A.activity_state(late))
    assert same(merged, A.activity_state(events.union(late)))
    assert same(A.engagement_from_state(merged, FIXTURE_CONFIG), E.engagement_summary(events.union(late), FIXTURE_CONFIG))


def test_an_empty_state(spark):
    state = A.activity_state(spark.createDataFrame([], EVENT))
    assert state.isEmpty() and A.engagement_from_state(state, FIXTURE_CONFIG).isEmpty()


def test_marts_of_two_window_sets_from_one_state(spark, raw_small):
    sets = {"years": FIXTURE_CONFIG, "quarters": FIXTURE_QUARTERS_CONFIG}
    both = score_window_sets(raw_small, sets)
    for name, cfg in sets.items():
        assert same(both.filter(both.window_set == name).drop("window_set"), score_accounts(raw_small, cfg))
    state = A.activity_state(stage_all(raw_small, FIXTURE_CONFIG).submissions)
    assert same(score_window_sets(raw_small, {"years": FIXTURE_CONFIG}, state).drop("window_set"), score_accounts(raw_small, FIXTURE_CONFIG))
    assert "lineitem.parquet" not in plan(both)   # the events were read once, into the state


def test_a_state_has_at_most_one_row_per_event(spark):
    rows = [(f"a{i % 7}", f"u{i}", f"P{i % 3}", date(1999, 1, 1) + timedelta(days=3 * i)) for i in range(200)]
    events = spark.createDataFrame(rows + rows[:50] + [("a0", None, None, None)] * 2, EVENT)
    assert A.activity_state(events).count() == 201


def test_window_sets_read_the_state_once(spark, raw_small, monkeypatch):
    names, cut = [], mart.cut_lineage
    monkeypatch.setattr(mart, "cut_lineage", lambda df, name: names.append(name) or cut(df, name))
    sets = {"years": FIXTURE_CONFIG, "regions": replace(FIXTURE_QUARTERS_CONFIG, unknown_region="nowhere"), "quarters": FIXTURE_QUARTERS_CONFIG}
    marts = score_window_sets(raw_small, sets)
    assert names == ["activity_state", "account_bases", "account_bases"]   # one for each way of cleaning the accounts
    for name, cfg in sets.items():
        assert same(marts.filter(marts.window_set == name).drop("window_set"), score_accounts(raw_small, cfg)), name


def tagged_in_sql(events, windows):
    con = duckdb.connect()
    con.register("events", events.toPandas())
    rows = ", ".join(f"('{n}', DATE '{a}', DATE '{b}')" for n, a, b in windows)
    return sorted(con.execute(f"SELECT account_id, CAST(submission_date AS DATE), n FROM events JOIN (VALUES {rows}) w(n, a, b)"
                              " ON CAST(submission_date AS DATE) BETWEEN a AND b").fetchall())


def test_overlapping_windows_tag_in_one_pass(spark, monkeypatch):
    events = random_events(spark, 300, 3).filter("submission_date IS NOT NULL")
    windows = [*FIXTURE_WINDOWS, ("one_day", date(2000, 2, 29), date(2000, 2, 29)), ("never", date(2001, 1, 2), date(2001, 1, 1)), ("old", date(1900, 1, 1), date(1999, 6, 1))]
    windows += [(f"m{i}", date(1999, 1, 1) + timedelta(days=7 * i), date(1999, 1, 1) + timedelta(days=7 * i + 45)) for i in range(60)]
    for bounds in (W.TREE_BOUNDS, 3):
        monkeypatch.setattr(W, "TREE_BOUNDS", bounds)
        out = W.tag_windows(events, windows)
        got = sorted((r.account_id, r.submission_date, r.window_name) for r in out.collect())
        assert got == tagged_in_sql(events, windows) and len(got) > 1000
        p = plan(out)
        assert "NestedLoop" not in p and "Cartesian" not in p
        if bounds > 3:
            assert "Join" not in p and "Exchange" not in p
    assert W.tag_windows(events, []).isEmpty()


def test_null_dates_are_in_no_window(spark):
    events = spark.createDataFrame([("a", "u", "P", None), ("a", "u", "P", date(2000, 1, 1))], EVENT)
    assert W.tag_windows(events, FIXTURE_WINDOWS).count() == 1
    rows = W.window_activity(events, [("y", date(2000, 1, 1), date(2000, 12, 31))]).collect()
    assert [tuple(r) for r in rows] == [("y", "a", 1, 1, 1, date(2000, 1, 1))]


def test_config_stays_frozen():
    assert replace(FIXTURE_CONFIG, dedup="filter").recent_end == FIXTURE_CONFIG.recent_end
