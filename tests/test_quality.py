import os
import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from orderlake.operators import gold
from orderlake.operators import quality as qa

COLUMNS = "order_id string, user_id_hash string, status string, currency string, total_cents string"
GOOD = ("o1", "a" * 64, "placed", "USD", "100")


def suite(spark, *rows, strict=False, columns=COLUMNS):
    return {r.check_name: r for r in qa.dq_orders_suite(spark.createDataFrame(list(rows), columns), strict).collect()}


def failed(result):
    return sorted(n for n, r in result.items() if not r.passed)


def test_clean_rows_pass_all_nine(spark):
    result = suite(spark, GOOD)
    assert len(result) == 9 and failed(result) == []


@pytest.mark.parametrize("row,check", [
    ((None, *GOOD[1:]), "order_id_not_null"), (("nan", *GOOD[1:]), "order_id_not_null"), (("  ", *GOOD[1:]), "order_id_not_null"),
    (("o2", None, *GOOD[2:]), "user_id_hash_not_null"), (("o2", "short", *GOOD[2:]), "user_id_hash_length"), (("o2", GOOD[1], "lost", *GOOD[3:]), "status_valid"),
    ((*GOOD[:3], "XXX", "5"), "currency_valid"), (("o2", *GOOD[1:4], "0"), "total_cents_positive"), (("o2", *GOOD[1:4], "abc"), "total_cents_positive"),
    (("o2", *GOOD[1:4], None), "total_cents_positive")])
def test_each_fault_is_found(spark, row, check):
    result = suite(spark, ("first", *GOOD[1:]), row)
    assert failed(result) == [check]
    assert result[check].failed_rows == 1


def test_duplicates(spark):
    assert suite(spark, GOOD, GOOD, GOOD)["order_id_unique"].failed_rows == 2


def test_erased_is_exempt_unless_strict(spark):
    row = ("o", "ERASED", *GOOD[2:])
    assert failed(suite(spark, row)) == []
    assert failed(suite(spark, row, strict=True)) == ["user_id_hash_length"]


def test_raw_user_column_is_critical(spark):
    assert failed(suite(spark, (*GOOD, "u"), columns=COLUMNS + ", user_id string")) == ["no_raw_user_id"]


def test_no_rows_fails_volume_only(spark):
    result = {r.check_name: r.passed for r in qa.dq_orders_suite(spark.createDataFrame([], COLUMNS)).collect()}
    assert [n for n, ok in result.items() if not ok] == ["row_volume"]


def test_summary(spark):
    row = qa.suite_result(qa.dq_orders_suite(spark.createDataFrame([GOOD, ("x", "short", "lost", "USD", "1")], COLUMNS)), 3).first()
    assert (row.success, row.files_checked, row.rows, row.checks_run, row.checks_passed, row.failures) == (False, 3, 2, 9, 7, "status_valid,user_id_hash_length")


def test_suite_needs_one_shuffle(spark, plan):
    text = plan(qa.dq_orders_suite(spark.range(100).selectExpr("cast(id as string) order_id", "'x' user_id_hash", "'placed' status", "'USD' currency", "id total_cents")))
    assert text.count("Exchange hashpartitioning") == 1


def fact(spark, counts, day0=date(2024, 1, 20)):
    rows = [(datetime.combine(day0 - timedelta(days=back), datetime.min.time()), i) for back, n in counts.items() for i in range(n)]
    return spark.createDataFrame(rows, "order_date timestamp, i int")


@pytest.mark.parametrize("today,status", [(10, "pass"), (7, "pass"), (6, "fail"), (0, "fail")])
def test_volume(spark, today, status):
    row = qa.volume_anomaly(fact(spark, {0: today, 1: 10, 3: 10, 8: 10, 9: 500}), date(2024, 1, 20)).first()
    assert (row.status, row.today_count, row.rolling_avg) == (status, today, 10.0)


def test_volume_without_history_is_skipped(spark):
    assert qa.volume_anomaly(fact(spark, {0: 3}), date(2024, 1, 20)).first().status == "skip"


def test_gold_counts(spark):
    f, d = fact(spark, {1: 2}), fact(spark, {0: 1})
    assert qa.gold_row_counts(f, d, date(2024, 1, 20)).first().status == "pass"
    assert qa.gold_row_counts(fact(spark, {2: 2}), d, date(2024, 1, 20)).first().status == "fail"
    assert qa.gold_row_counts(f, d.limit(0), date(2024, 1, 20)).first().status == "fail"


@pytest.mark.parametrize("hours,status", [(0.5, "pass"), (2, "warn"), (7, "error")])
def test_source_freshness(spark, hours, status):
    at = datetime(2024, 1, 1, 12)
    df = spark.createDataFrame([(at - timedelta(hours=hours),), (at - timedelta(days=9),)], "updated_at timestamp")
    assert qa.source_freshness(df, F.lit(at)).first().status == status


def test_file_freshness(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    assert qa.silver_freshness(spark, str(tmp_path / "t"), F.current_timestamp()).first().status == "pass"
    old = time.time() - 3600
    for f in (tmp_path / "t").glob("*.parquet"):
        os.utime(f, (old, old))
    assert qa.silver_freshness(spark, str(tmp_path / "t"), F.current_timestamp()).first().status == "fail"


def test_pii_scan_ignores_case(spark):
    got = {(r.table_name, r.column_name) for r in qa.pii_scan({"a": spark.range(1).selectExpr("id EMail", "id user_id_hash"), "b": spark.range(1)}).collect()}
    assert got == {("a", "EMail")}


def test_reconciliation(spark, sf):
    from orderlake.plans import marts
    f = marts.lean_fact(spark, sf)
    assert qa.agg_reconciles(f, gold.daily_revenue(f)).first().reconciled
    assert not qa.agg_reconciles(f, gold.daily_revenue(f.filter("order_month <> 3"))).first().reconciled
