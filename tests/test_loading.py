"""Inferred CSV types, rejected rows, versioned marts, permanent views, observed checks."""

from datetime import date

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctpulse.config import FIXTURE_CONFIG
from acctpulse.operators import quality as Q
from acctpulse.operators.mart import MART_COLUMNS
from acctpulse.plans.models import ChecksFailed, Models, publish_version
from acctpulse.sources import inference as I
from acctpulse.sources import raw as SRC
from acctpulse.sources import versions as V

DUCK = {"BOOLEAN": "boolean", "BIGINT": "bigint", "DOUBLE": "double", "DATE": "date", "TIMESTAMP": "timestamp_ntz", "VARCHAR": "string"}
CELLS = {
    "flag": ["true", "FALSE", ""], "whole": ["1", "-20", "0"], "real": ["1.5", "-2", "1e5"], "late_real": ["1", "2", "3"], "late_text": ["1", "2", "3"],
    "day": ["2024-01-05", "2024-12-31", ""], "moment": ["2024-01-05 10:00:00", "2024-01-05 10:00:01.25", ""], "mixed": ["2024-01-05", "7", "true"],
    "day_or_moment": ["2024-01-05", "2024-01-06", "2024-01-07 10:00:00"], "code": ["007", "008", "9"], "plus": ["+3", "1", "2"], "yes": ["yes", "no", ""], "nothing": ["", "", ""], "one": ["", "", "5"], "no_day": ["2024-01-05", "2024-02-30", "2024-01-01"],
    "big": ["9223372036854775807", "1", "2"], "name": ["x", "y y", "z"], "text_flag": ["true", "false", "maybe"],
}
LATE = {"late_real": "0.5", "late_text": "n/a"}


def csv_file(folder, name, cells, late=None, repeat=400):
    rows = [",".join(c[i % 3] for c in cells.values()) for i in range(3 * repeat)]
    if late is not None:
        rows.append(",".join(late.get(k, c[2]) for k, c in cells.items()))
    path = folder / name
    path.write_text(",".join(cells) + "\n" + "\n".join(rows) + "\n")
    return str(path)


def test_inferred_types_equal_a_full_reading(spark, tmp_path):
    path = csv_file(tmp_path, "a.csv", CELLS, LATE)
    expected = duckdb.sql(f"DESCRIBE SELECT * FROM read_csv_auto('{path}', sample_size=-1)").fetchall()
    df = I.read_csv_inferred(spark, path)
    assert {c: t for c, t in df.dtypes} == {name: DUCK[kind] for name, kind, *_ in expected}
    rows = duckdb.sql(f"SELECT * FROM read_csv_auto('{path}', sample_size=-1)").fetchall()
    assert sorted(map(str, (tuple(r) for r in df.collect()))) == sorted(map(str, rows))


def test_states_of_files_merge(spark, tmp_path):
    first, second = csv_file(tmp_path, "a.csv", CELLS), csv_file(tmp_path, "b.csv", CELLS, LATE, 1)
    states = [I.type_state(I.read_text_csv(spark, p)) for p in (first, second)]
    assert dict(I.read_csv_inferred(spark, first).dtypes)["late_real"] == "bigint"
    merged = I.merge_states(*states)
    whole = I.type_state(I.read_text_csv(spark, [first, second]))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, whole.collect()))
    assert I.inferred_schema(merged) == I.read_csv_inferred(spark, [first, second]).schema


def test_declared_types_win_and_empty_files_are_text(spark, tmp_path):
    path = csv_file(tmp_path, "a.csv", CELLS)
    df = I.read_csv_inferred(spark, path, declared=T.StructType([T.StructField("whole", T.StringType()), T.StructField("big", T.DecimalType(20, 0))]))
    kinds = dict(df.dtypes)
    assert kinds["whole"] == "string" and kinds["big"] == "decimal(20,0)" and kinds["real"] == "double"
    assert set(dict(I.read_csv_inferred(spark, csv_file(tmp_path, "e.csv", CELLS, repeat=0)).dtypes).values()) == {"string"}


def test_the_whole_file_is_folded_in_one_aggregate(spark, tmp_path):
    from tests.test_plans import plan

    p = plan(I.type_state(I.read_text_csv(spark, csv_file(tmp_path, "a.csv", CELLS))))
    assert p.count("FileScan csv") == 1 and p.count("Exchange") == 1 and "partial_bit_and" in p and "Sample" not in p


# -- rejected rows


def test_bad_rows_are_kept_apart(spark, raw_small, tmp_path):
    paths = SRC.write_raw_csv({n: df.limit(200) for n, df in raw_small.items()}, f"{tmp_path}/csv")
    clean, none = SRC.load_raw_with_rejects(spark, paths, f"{tmp_path}/clean")
    assert none.isEmpty()
    for name in paths:
        assert SRC.read_loaded_table(spark, name, clean).exceptAll(SRC.read_raw_csv(spark, paths[name], name, SRC.NULL_MARK)).isEmpty()
    bad = tmp_path / "bad.csv"
    good = "SUB-1,ACC-1,P1,10.5,2000-01-01,2001-01-01,Active"
    bad.write_text("subscription_id,account_id,product,arr_usd,term_start_date,term_end_date,status\n" + f"{good}\n" * 3
                   + "SUB-2,ACC-1,P1\nSUB-3,ACC-1,P1,ten,2000-01-01,2001-01-01,Active\n" + f"{good}\n")
    with pytest.raises(SRC.TooManyRejects, match="subscriptions"):
        SRC.load_raw_with_rejects(spark, {"subscriptions": str(bad)}, f"{tmp_path}/t1")
    locations, rejected = SRC.load_raw_with_rejects(spark, {"subscriptions": str(bad)}, f"{tmp_path}/t2", max_rejected_share=0.5)
    loaded = SRC.read_raw_table(spark, "subscriptions", locations).select(*SRC.RAW_SCHEMAS["subscriptions"].fieldNames())
    assert loaded.count() == 4 and SRC.read_loaded_table(spark, "subscriptions", locations).exceptAll(loaded).isEmpty()
    assert sorted((r.table_name, r.reason, r.line[:5]) for r in rejected.collect()) == [("subscriptions", "number of fields", "SUB-2"), ("subscriptions", "value", "SUB-3")]


# -- versions and views


def test_readers_keep_the_old_version_until_the_new_is_whole(spark, tmp_path):
    root = f"{tmp_path}/mart"
    assert V.current_version(spark, root) is None
    with pytest.raises(FileNotFoundError):
        V.read_current(spark, root)
    first = V.refresh(spark.range(5), root)
    reader = V.read_current(spark, root)
    staged = V.stage_version(spark.range(9), root)
    assert V.read_current(spark, root).count() == 5          # during a refresh
    with pytest.raises(Exception, match="raise_error|USER_RAISED"):
        V.refresh(spark.range(9).withColumn("id", F.when(F.col("id") == 8, F.raise_error(F.lit("raise_error"))).otherwise(F.col("id"))), root)
    assert V.read_current(spark, root).count() == 5          # after one that failed
    V.release(spark, root, staged)
    assert V.read_current(spark, root).count() == 9 and reader.count() == 5
    with pytest.raises(FileNotFoundError):
        V.release(spark, root, "unknown")
    assert V.prune(spark, root) == [] and first in V.prune(spark, root, older_than_seconds=0)
    assert V.read_current(spark, root).count() == 9


def test_permanent_views_are_seen_by_other_sessions(spark, tmp_path):
    spark.range(3).selectExpr("id", "id * 2 AS `odd name`").write.parquet(f"{tmp_path}/v1")
    spark.range(4).selectExpr("id").write.parquet(f"{tmp_path}/v2")
    try:
        assert SRC.register_permanent_views(spark, {"permanent_of_test": f"{tmp_path}/v1"}) == ["permanent_of_test"]
        other = spark.newSession()
        assert other.sql("SELECT sum(`odd name`) AS s FROM permanent_of_test").first().s == 6
        SRC.register_permanent_views(spark, {"permanent_of_test": f"{tmp_path}/v2"})
        assert other.table("permanent_of_test").count() == 4
    finally:
        spark.sql("DROP VIEW IF EXISTS permanent_of_test")


# -- checks


def planted_models(spark):
    accounts = spark.createDataFrame([("A",), ("B",), ("B",), (None,)], "account_id string")
    rows = [("s1", "A", "u", "P1", date(2001, 1, 1)), ("s1", "A", None, "P9", None), ("s2", "X", "u", "P8", date(2001, 1, 1)), (None, None, "u", "P9", None), ("s3", "X", "u", None, None)]
    events = spark.createDataFrame(rows, "submission_id string, account_id string, user_id string, product string, submission_date date")
    return {"stg_accounts": accounts, "stg_submissions": events}


def test_passes_count_what_the_checks_list(spark):
    models = planted_models(spark)
    checks = [c for c in Q.catalog(FIXTURE_CONFIG) if c.model == "stg_submissions"] + [Q.Check("unique", "stg_accounts", "account_id")]
    got = {(r.check_name, r.model, r.column_name): r.failures for r in Q.run_checks(models, checks).collect()}
    for c in checks:
        df = models[c.model]
        rows = {"not_null": lambda: Q.not_null(df, c.column), "unique": lambda: Q.unique(df, c.column), "accepted_values": lambda: Q.accepted_values(df, c.column, c.values),
                "relationships": lambda: Q.relationships(df, c.column, models["stg_accounts"], "account_id")}[c.kind]().count()
        assert got[c.kind, c.model, c.column] == rows, c
    empty = Q.run_checks({n: df.limit(0) for n, df in models.items()}, checks)
    assert {r.failures for r in empty.collect()} == {0} and empty.count() == len(checks)


def test_observed_figures_equal_the_checks(spark, raw_small):
    watched = [c for c in Q.catalog(FIXTURE_CONFIG) if c.model == "stg_submissions" and c.kind in Q.COLUMN_KINDS]
    bad = dict(raw_small, submissions=raw_small["submissions"].withColumn("user_id", F.when(F.col("user_id") == "USR-3", None).otherwise(F.col("user_id"))))
    models = Models(bad, FIXTURE_CONFIG, watched)
    seen = {c.column: n for c, n in models.observed().items() if c.kind == "not_null"}
    exact = {r.column_name: r.failures for r in Q.run_checks(models, [c for c in watched if c.kind == "not_null"]).collect()}
    assert seen == exact and seen["user_id"] > 0 and seen["submission_id"] == 0


def test_a_version_is_published_only_if_all_checks_pass(spark, raw_small, tmp_path):
    good = {n: df.filter("segment IS NOT NULL") if n == "accounts" else df for n, df in raw_small.items()}
    summary = publish_version(good, f"{tmp_path}/mart", FIXTURE_CONFIG)
    assert summary.count() == 55 and summary.filter("failures > 0").isEmpty()
    version = V.current_version(spark, f"{tmp_path}/mart")
    assert V.read_current(spark, f"{tmp_path}/mart").columns == list(MART_COLUMNS)
    with pytest.raises(ChecksFailed, match="accepted_values"):
        publish_version(dict(good, subscriptions=good["subscriptions"].withColumn("product", F.lit("P9"))), f"{tmp_path}/mart", FIXTURE_CONFIG)
    assert V.current_version(spark, f"{tmp_path}/mart") == version
