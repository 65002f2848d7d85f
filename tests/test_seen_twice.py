"""De-duplication that ships only possible repeats."""

from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from acctpulse.config import FIXTURE_CONFIG
from acctpulse.operators import seen_twice as ST
from acctpulse.operators.staging import _first_copies, _typed_submissions, stage_accounts, stage_submissions
from tests.test_plans import plan

FILTERED = replace(FIXTURE_CONFIG, dedup="filter")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, (1 << 62) - 1) | st.integers(0, 40), max_size=40), max_size=6))
def test_merged_parts_are_the_slots_hit_again(parts):
    slots = [np.array(p, np.int64) for p in parts]
    merged = ST.merge([tuple(ST.pack(a) for a in ST.levels(s)) for s in slots]) if slots else np.zeros(0, np.int64)
    assert merged.tolist() == sorted(s for s, n in Counter(x for p in parts for x in p).items() if n > 1)
    for s in slots:
        own = np.unique(s)
        assert (ST.unpack(ST.pack(own)) == own).all()


@pytest.mark.parametrize("range_rows, flush_rows, spread", [(8_000_000, 4_000_000, 64), (50, 37, 64), (50, 37, 1)])
def test_no_repeat_is_missed(spark, range_rows, flush_rows, spread):
    """Many ranges and parts; with a spread of 1 most keys are unlucky and share a slot."""
    keys = [f"k{i % 900}" for i in range(1000)] + [None, None] + ["hot"] * 700
    df = spark.createDataFrame([(k,) for k in keys], "id string").repartition(9)
    bits = ST.slot_bits(len(keys), spread)
    found = ST.seen_twice(df, bits, len(keys), range_rows, flush_rows)
    slots = {r.slot for r in found.collect()}
    by_slot = Counter()
    for r in df.groupBy("id").count().select("id", "count", ST.slot(df["id"], bits).alias("slot")).collect():
        by_slot[r.slot] += r["count"]
    assert slots == {s for s, n in by_slot.items() if n > 1}


def events(spark, rows):
    return spark.createDataFrame([(i, "2001-01-01", t, a, "P1", "u") for i, t, a in rows],
                                 "submission_id string, submission_date string, submission_timestamp string, account_id string, product string, user_id string")


def test_filtered_dedup_gives_the_same_rows(spark, raw_small):
    accounts = stage_accounts(raw_small["accounts"], FILTERED)
    twice = raw_small["submissions"].unionByName(raw_small["submissions"].filter("submission_id LIKE '%7'").replace({"P1": "P0"}, subset=["product"]))
    for cfg in (FILTERED, replace(FILTERED, broadcast_max_rows=10)):   # accounts within and beyond the broadcast bound
        a = stage_submissions(twice, accounts, replace(cfg, dedup="window"))
        b = stage_submissions(twice, accounts, cfg)
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_odd_ids(spark):
    """Hot and NULL ids, an id of a known and an unknown account, an empty table."""
    rows = [(f"s{i}", f"2001-01-01 00:00:{i % 60:02d}", "A") for i in range(300)]
    rows += [("hot", f"2001-01-01 00:{i // 60 % 60:02d}:{i % 60:02d}", "A") for i in range(500)] + [(None, "2001-01-02 00:00:00", "A"), (None, None, "A")]
    rows += [("s5", "2000-01-01 00:00:00", "GHOST"), ("s6", None, "A"), ("s7", "2000-01-01 00:00:00", None)]
    df, accounts = events(spark, rows), spark.createDataFrame([("A",)], "account_id string")
    for bound in (2_000_000, 0):
        cfg = replace(FILTERED, broadcast_max_rows=bound)
        a, b = (stage_submissions(df, accounts, replace(cfg, dedup=d)) for d in ("window", "filter"))
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())) and a.count() == 302
    assert stage_submissions(df.limit(0), accounts, FILTERED).count() == 0


def test_rows_of_ids_seen_once_are_not_shuffled(spark):
    df = events(spark, [(f"s{i}", "2001-01-01 00:00:00", "A") for i in range(5000)] + [("s1", "2000-01-01 00:00:00", "A")])
    typed = _typed_submissions(df)
    out = _first_copies(typed, typed, FILTERED)
    p = plan(out)
    # one exchange by id, and below it the map-side join with the possible repeats
    assert p.count("Exchange hashpartitioning(submission_id") == 1 and "Exchange hashpartitioning(_slot" not in p
    assert p.count("BroadcastHashJoin") == 2 and "LeftAnti" in p and "LeftSemi" in p
    repeats = ST.PossibleRepeats(typed.select("submission_id"), "submission_id", 10_000)
    assert repeats.possible(typed).count() < 5001 * 3 / ST.SPREAD and repeats.single(typed).count() + repeats.possible(typed).count() == 5001
    assert out.count() == 5000
