"""Every registered query against its DuckDB SQL on the smallest driver tables
(the driver repeats this at sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from acctpulse.plans import registry

from .conftest import SMALL

TABLES = "region nation customer supplier part orders lineitem".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def _rows(records, cols):
    rows = [tuple(_norm(r[c]) for c in cols) for r in records]
    return sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


QUERIES = registry.queries()
SQL = registry.oracle_sql()


def test_every_query_registered_with_sql():
    assert set(SQL) == set(QUERIES) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(SQL))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SMALL)
    got = [r.asDict() for r in df.collect()]
    res = con.execute(SQL[key])
    cols = [d[0] for d in res.description]
    exp = [dict(zip(cols, r)) for r in res.fetchall()]
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(exp)
    assert _rows(got, sorted(cols)) == _rows(exp, sorted(cols))


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and len(df.columns) == 37


# Sorted reports: the oracle compares rows as sets, so the order is asserted here.
ORDERED = {
    "profile_division_counts": [("cnt", True)], "profile_region_counts": [("cnt", True)], "profile_segment_counts": [("cnt", True)],
    "profile_subscriptions_by_product": [("total_arr", True)], "profile_submissions_by_product": [("submissions", True)],
    "duplicate_submissions": [("submission_id", False), ("submission_date", False)],
}


@pytest.mark.parametrize("key", sorted(ORDERED))
def test_sort_order(spark, key):
    rows = [tuple(r[c] for c, _ in ORDERED[key]) for r in QUERIES[key](spark, SMALL).collect()]
    assert rows == sorted(rows, reverse=ORDERED[key][0][1]) and len(rows) > 1


def test_entry_is_sorted(spark):
    rows = [(r.composite_health_score, r.peer_percentile_rank) for r in entry.entry(spark).collect()]
    assert rows == sorted(rows)


def test_raw_checks_do_fail(spark):
    """Each kind of check is seen to fail on the uncleaned tables."""
    for kind in ("not_null", "unique", "accepted_values", "relationships"):
        assert QUERIES[f"dq_raw_{kind}"](spark, SMALL).filter("failures > 0").count() > 0, kind


def test_no_input_row_is_dropped(spark):
    counts = {r.table_name: r.row_count for r in QUERIES["profile_row_counts"](spark, SMALL).collect()}
    for name, table in (("accounts", "customer"), ("subscriptions", "orders"), ("submissions", "lineitem")):
        assert counts[name] == spark.read.parquet(f"{SMALL}/{table}.parquet").count()
