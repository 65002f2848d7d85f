"""Arriving submission files are appended once; bad rows fail; nothing loaded is erased."""

import pytest

from acctpulse.config import FIXTURE_CONFIG
from acctpulse.operators.mart import score_accounts
from acctpulse.sources import raw as SRC
from acctpulse.streaming.refresh import load_submissions, read_loaded_submissions


def test_load_appends_each_file_once(spark, raw_small, tmp_path):
    SRC.write_raw_csv({"submissions": raw_small["submissions"]}, f"{tmp_path}/incoming")
    load = lambda ckpt, table: load_submissions(
        spark, f"{tmp_path}/incoming/submissions.csv", table, ckpt, available_now=True, null_value=SRC.NULL_MARK).awaitTermination(300)
    table, n = f"{tmp_path}/raw_submissions", raw_small["submissions"].count()
    load(f"{tmp_path}/ckpt", table)
    loaded = read_loaded_submissions(spark, table)
    assert loaded.columns == SRC.RAW_SCHEMAS["submissions"].fieldNames() and loaded.count() == n
    # a restart on the same checkpoint finds no new files
    load(f"{tmp_path}/ckpt", table)
    assert read_loaded_submissions(spark, table).count() == n
    mart = score_accounts(dict(raw_small, submissions=read_loaded_submissions(spark, table)), FIXTURE_CONFIG)
    assert mart.count() == score_accounts(raw_small, FIXTURE_CONFIG).count()


def test_a_second_query_erases_nothing(spark, tmp_path):
    header = ",".join(SRC.RAW_SCHEMAS["submissions"].fieldNames())
    for k in (1, 2):
        (tmp_path / f"in{k}").mkdir()
        (tmp_path / f"in{k}" / "a.csv").write_text(f"{header}\nS{k},2001-01-01,2001-01-01,A,P,U\n")
        load_submissions(spark, f"{tmp_path}/in{k}", f"{tmp_path}/raw", f"{tmp_path}/ckpt{k}", available_now=True).awaitTermination(300)
    assert {r.submission_id for r in read_loaded_submissions(spark, f"{tmp_path}/raw").collect()} == {"S1", "S2"}


def test_a_short_row_fails_the_load(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(",".join(SRC.RAW_SCHEMAS["submissions"].fieldNames()) + "\nS1,2001-01-01\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        load_submissions(spark, f"{tmp_path}/in", f"{tmp_path}/raw", f"{tmp_path}/ckpt", available_now=True).awaitTermination(300)
