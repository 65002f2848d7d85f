"""Bucketed model tables, counts from footers, key checks by hash ranges."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from acctpulse.config import FIXTURE_CONFIG
from acctpulse.operators import profiling as R
from acctpulse.operators import quality as Q
from acctpulse.operators import range_checks as K
from acctpulse.plans.models import Models
from acctpulse.sources import laid_out as L


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


# -- bucketed tables


@pytest.fixture(scope="module")
def stored(spark, raw_small, tmp_path_factory):
    folder = tmp_path_factory.mktemp("models")
    spark.sql(f"CREATE DATABASE laid_out_test LOCATION '{folder}'")
    models = Models(raw_small, FIXTURE_CONFIG)
    L.save_models(models, "laid_out_test", buckets=4)
    yield models, L.read_models(spark, "laid_out_test")
    spark.sql("DROP DATABASE laid_out_test CASCADE")


def test_model_tables_meet_without_an_exchange(stored):
    _, kept = stored
    mart, growth, accounts = kept["account_score_mart"], kept["user_growth_accounting"], kept["stg_accounts"]
    joined = mart.hint("merge").join(growth.hint("merge"), "account_id", "left").join(accounts.select("account_id", "csm_owner").hint("merge"), "account_id", "left")
    p = plan(joined)
    assert "Exchange" not in p and p.count("SortMergeJoin") >= 2
    assert joined.count() == mart.count()
    p = plan(kept["stg_submissions"].groupBy("submission_id").count())
    assert "Exchange" not in p


def test_stored_models_equal_the_built(stored):
    models, kept = stored
    for name in L.KEYS:
        assert kept[name].columns == models[name].columns
        assert kept[name].count() == models[name].count(), name
    mart = models["account_score_mart"]
    assert kept["account_score_mart"].exceptAll(mart).isEmpty() and mart.exceptAll(kept["account_score_mart"]).isEmpty()


def test_uniqueness_of_stored_models_moves_no_key(stored):
    models, kept = stored
    checks = [c for c in Q.catalog(FIXTURE_CONFIG) if c.model in kept and c.kind in ("unique", "relationships")]
    got = {tuple(r) for r in Q.run_checks(kept, checks, L.KEYS).collect()}
    assert got == {tuple(r) for r in Q.run_checks(models, checks).collect()} and len(got) == len(checks)
    own = [c for c in checks if c.kind == "unique" and c.model == "stg_submissions"]
    assert "hashpartitioning" not in plan(Q.run_checks(kept, own, L.KEYS))


def test_a_repeat_in_a_stored_model_is_found(spark, stored):
    _, kept = stored
    accounts = kept["stg_accounts"]
    L.write_laid_out(accounts.unionByName(accounts.limit(3)), "laid_out_test.planted", "account_id", 4)
    check = Q.Check("unique", "stg_accounts", "account_id")
    rows = Q.run_checks({"stg_accounts": spark.table("laid_out_test.planted")}, [check], L.KEYS).collect()
    assert [r.failures for r in rows] == [3]


# -- counts from footers


def test_reports_are_answered_by_footers(spark, raw_small, tmp_path):
    listed = spark.conf.get("spark.sql.sources.useV1SourceList")
    events = raw_small["submissions"].withColumn("user_id", F.when(F.col("user_id") != "USR-3", F.col("user_id")))
    events.write.parquet(f"{tmp_path}/events")
    events.withColumn("submission_date", F.col("submission_date").cast("string")).write.parquet(f"{tmp_path}/texts")
    kept, texts = L.read_with_statistics(spark, f"{tmp_path}/events"), L.read_with_statistics(spark, f"{tmp_path}/texts")
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == listed
    for report, frame, plain in (
            (lambda t: R.submissions_nulls(t), kept, events), (lambda t: R.row_counts({"submissions": t}), kept, events),
            (lambda t: R.schema_report({"submissions": t}), kept, events), (R.submission_date_range, kept, events)):
        pushed = [line for line in plan(report(frame)).splitlines() if "PushedAggregation" in line]
        assert pushed and all("[]" not in line for line in pushed)
        assert report(frame).collect() == report(plain).collect()
    assert R.submissions_nulls(kept).first().user_id_nulls > 0
    # a text has no exact bounds in a footer: scanned, with the same answer
    ranged = R.submission_date_range(texts)
    assert "PushedAggregation" not in plan(ranged)
    assert ranged.select(F.to_date("earliest"), F.to_date("latest")).collect() == R.submission_date_range(events).collect()


def test_empty_tables_keep_null_counts(spark, raw_small, tmp_path):
    raw_small["submissions"].limit(0).write.parquet(f"{tmp_path}/none")
    for table in (L.read_with_statistics(spark, f"{tmp_path}/none"), raw_small["submissions"].limit(0)):
        assert list(R.submissions_nulls(table).first()) == [None] * 4
        assert R.row_counts({"t": table}).first().row_count == 0
        assert {(r.row_count, r.filled) for r in R.schema_report({"t": table}).collect()} == {(0, 0)}


# -- key checks by ranges


def figures(checked):
    return tuple(K.totals(checked).first())


def by_hand(child, parent=None):
    rows = [r[0] for r in child.collect()]
    known = {r[0] for r in parent.collect()} if parent is not None else set(rows)
    filled = [k for k in rows if k is not None]
    orphans = [k for k in filled if k not in known]
    return sum(filled.count(k) > 1 for k in set(filled)), len(orphans), len(set(orphans)), len(rows) - len(filled)


def kept_as(spark, df, path):
    df.write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_ranges_find_what_is_planted(spark, tmp_path):
    parent = spark.range(500).selectExpr("concat('A', id) AS k")
    clean = spark.range(3000).selectExpr("concat('A', id % 500) AS k").repartition(5)
    odd = spark.createDataFrame([("A1",), ("X",), ("X",), ("Y",), ("",), (None,), (None,)], "k string")
    first = kept_as(spark, K.check_ranges(clean, "k", parent, ranges=64), tmp_path / "first")
    assert figures(first) == by_hand(clean, parent) == (500, 0, 0, 0)
    now = clean.unionByName(odd)
    second = K.check_ranges(now, "k", parent, before=first, ranges=64)
    assert figures(second) == by_hand(now, parent) == (501, 4, 3, 2)
    assert figures(K.check_ranges(now, "k", parent, ranges=64)) == figures(second)
    # an account that goes takes its rows along, one that comes back mends them
    fewer = parent.filter("k <> 'A7'")
    third = kept_as(spark, K.check_ranges(clean, "k", fewer, before=first, ranges=64), tmp_path / "third")
    assert figures(third) == by_hand(clean, fewer) == (500, 6, 1, 0)
    assert figures(K.check_ranges(clean, "k", parent, before=third, ranges=64)) == (500, 0, 0, 0)
    # a range that is empty now has no figures left
    assert figures(K.check_ranges(odd.limit(0), "k", parent, before=first, ranges=64)) == (0, 0, 0, 0)


def test_only_departing_ranges_are_examined(spark, tmp_path):
    keys = spark.range(20_000).selectExpr("concat('S', id) AS k")
    first = kept_as(spark, K.check_ranges(keys, "k", ranges=256), tmp_path / "first")
    shuffled = keys.repartition(7).sortWithinPartitions(F.desc("k"))
    now = K._both(shuffled, None, "k", "k", 256)
    assert K.departed(now, first).isEmpty()                  # another order, the same table: only summaries move
    # one key takes the place of another: as many rows, two ranges at most
    swapped = keys.filter("k <> 'S5'").unionByName(spark.createDataFrame([("S6",)], "k string"))
    gone = K.departed(K._both(swapped, None, "k", "k", 256), first)
    assert 1 <= gone.count() <= 2
    assert K.rows_to_examine(swapped, "k", gone, 256).count() < 400
    assert figures(K.check_ranges(swapped, "k", before=first, ranges=256)) == (1, 0, 0, 0)


def test_a_hot_key_is_combined_before_it_moves(spark):
    hot = spark.range(30_000).selectExpr("if(id % 3 = 0, 'HOT', concat('S', id)) AS k")
    p = plan(K.check_ranges(hot, "k", ranges=64))
    assert "partial_count" in p or "Functions [1]: [partial_count(1)]" in p
    assert figures(K.check_ranges(hot, "k", ranges=64)) == (1, 0, 0, 0)
