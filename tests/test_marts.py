from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from orderlake.operators import features as ft
from orderlake.operators import gold, serving
from orderlake.operators import models as ml
from orderlake.plans import marts

S = ("order_id string, user_id_hash string, warehouse_id string, status string, currency string, subtotal_cents bigint, discount_cents bigint, "
     "shipping_cents bigint, total_cents bigint, cdc_op string, cdc_ts_ms bigint, created_at string, updated_at string")


def row(i, user="u", status="placed", total=1000, at="2024-01-01T10:00:00Z", discount=0, ts=1):
    return (i, user, "w", status, "USD", total, discount, 0, total, "c", ts, at, at)


def fact(spark, *rows):
    return gold.fact_orders(gold.stg_orders(spark.createDataFrame(list(rows), S)))


def test_staging_filters_and_net(spark):
    f = fact(spark, row("a", discount=100), row("b", total=0), row(None), row("c", user=None)).collect()
    assert [(r.order_id, r.net_revenue_cents, r.order_date) for r in f] == [("a", 900, datetime(2024, 1, 1))]


def test_staging_across_dates(spark):
    df = spark.createDataFrame([row("a", status="placed", ts=1), row("a", status="shipped", ts=2)], S)
    assert gold.stg_orders(df).count() == 2
    assert [r.order_status for r in gold.stg_orders(df, latest_across_dates=True).collect()] == ["shipped"]


def test_average_rounds_half_to_even_and_app_floors(spark):
    f = fact(spark, row("a", total=2), row("b", total=3))
    assert gold.daily_revenue(f).first().avg_order_value_cents == 2
    f = fact(spark, row("a", total=3), row("b", total=4))
    assert gold.daily_revenue(f).first().avg_order_value_cents == 4
    assert gold.daily_revenue_app(f).first().avg_order_value_cents == 3


def test_refund_rate_and_erased_buyer(spark):
    d = gold.daily_revenue(fact(spark, row("a", status="refunded"), row("b", status="cancelled", user="ERASED"), row("c", status="delivered"))).first()
    assert (d.refunded_order_count, d.refund_rate_pct, d.delivered_order_count, d.unique_buyers) == (2, 66.67, 1, 2)


def test_cohorts(spark):
    f = fact(spark, row("a", "u1", at="2024-01-31T00:00:00Z"), row("b", "u1", at="2024-02-01T00:00:00Z"), row("c", "u2", at="2024-01-05T00:00:00Z"),
             row("d", "u3", status="refunded"), row("e", "ERASED"), row("f", "u2", at="2025-01-05T00:00:00Z"))
    got = {(r.cohort_month, r.period_offset): (r.cohort_size, r.retained_users, r.retention_rate_pct) for r in gold.user_cohorts(f).collect()}
    assert got == {("2024-01-01 00:00:00", 0): (2, 2, 100.0), ("2024-01-01 00:00:00", 1): (2, 1, 50.0), ("2024-01-01 00:00:00", 12): (2, 1, 50.0)}


def test_active_months_ignore_the_year_unless_asked(spark):
    f = fact(spark, row("a", at="2023-01-01T00:00:00Z"), row("b", at="2024-01-01T00:00:00Z"), row("c", at="2024-03-01T00:00:00Z"))
    assert ft.user_features(f, date(2024, 4, 1)).first().active_months == 2
    assert ft.user_features(f, date(2024, 4, 1), year_aware=True).first().active_months == 3


def test_training_label_boundary(spark):
    f = fact(spark, row("a", "x", at="2024-01-01T23:00:00Z"))
    assert ft.churn_training_features(f, date(2024, 3, 1)).first().is_churned == 0
    assert ft.churn_training_features(f, date(2024, 3, 2)).first().is_churned == 1


def test_limits_and_ids(spark):
    f = fact(spark, row("a"))
    for bad in (0, 366):
        with pytest.raises(ValueError):
            serving.daily_revenue_latest(gold.daily_revenue(f), bad)
    assert serving.daily_revenue_latest(gold.daily_revenue(f), 365).count() == 1
    for bad in ("", "a", "' OR 1=1 --", "x" * 36, "../../etc/passwd"):
        with pytest.raises(ValueError):
            serving.order_by_id(f, bad)
    assert serving.order_by_id(f, "c1b2c3d4-0001-0001-0001-00000000000A").count() == 0


def test_score_requests_report_errors(spark):
    df = spark.createDataFrame([("a", 95, 1, 500), ("b", -1, 1, 1), ("c", 3651, 1, 1), ("d", 1, -1, 1), ("e", 1, 1, -1), ("f", 2, 20, 25000), ("g", None, 1, 1)],
                               "user_id_hash string, days_since_last_order int, total_orders int, avg_order_value_cents int")
    out = {r.user_id_hash: r for r in serving.score_requests(df).collect()}
    assert out["a"].churn_probability >= 0.7 and out["a"].risk_tier == "high" and out["f"].churn_probability <= 0.35
    assert all(out[k].error and out[k].churn_probability is None for k in "bcdeg")


def test_table_counts_mark_missing(spark):
    got = {r.table_name: r.row_count for r in serving.table_counts({"a": spark.range(4), "b": None}).collect()}
    assert got == {"a": 4, "b": -1}


# --- plans

def test_scan_reads_needed_columns_only(spark, sf, plan):
    text = plan(gold.daily_revenue(marts.lean_fact(spark, sf)))
    schema = text.split("ReadSchema: ")[1].split("\n")[0]
    assert "o_orderpriority" not in schema and "o_orderstatus" not in schema and "o_totalprice" in schema
    assert text.count("FileScan") == 1


def test_filter_reaches_the_scan(spark, sf, plan, tmp_path):
    fact_rows = marts.lean_fact(spark, sf)
    fact_rows.write.parquet(str(tmp_path / "fact"))
    text = plan(serving.since_days(spark.read.parquet(str(tmp_path / "fact")), date(2001, 8, 1), 30).select("order_id"))
    assert "GreaterThanOrEqual(order_date" in text and "ReadSchema: struct<order_id:string,order_date:timestamp>" in text


def test_cohorts_need_no_join(spark, sf, plan):
    assert "Join" not in plan(gold.user_cohorts(marts.lean_fact(spark, sf)))


def test_no_nested_loop_in_lookups(spark, sf, plan):
    from orderlake.plans import QUERIES
    for name in ("scd2_point_in_time", "asof_features", "retention_with_size"):
        text = plan(QUERIES[name](spark, sf))
        assert "NestedLoop" not in text and "Cartesian" not in text


def test_latest_uses_top_k(spark, sf, plan):
    assert "TakeOrderedAndProject" in plan(serving.recent_orders(marts.fact(spark, sf), 10))


# --- models

def test_folds_are_stratified(spark):
    df = spark.range(103).selectExpr("cast(id as string) user_id_hash", "cast(id % 4 = 0 as int) is_churned", *[f"cast(id as double) {c}" for c in ft.FEATURE_COLUMNS])
    rows = ml.training_rows(df, 5).groupBy("label", "fold").count().collect()
    for label in (0.0, 1.0):
        sizes = [r["count"] for r in rows if r.label == label]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_auc_matches_pair_counting(spark):
    data = [(0, (i * 37 % 50) / 50, float(i % 3 == 0)) for i in range(60)]
    scored = spark.createDataFrame([(f, p, y) for f, p, y in data], "fold int, p double, label double")
    pos, neg = [p for _, p, y in data if y], [p for _, p, y in data if not y]
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert ml.fold_metrics(scored).first().roc_auc == pytest.approx(want)


def test_training_learns_and_needs_rows(spark):
    df = spark.range(200).selectExpr("cast(id as string) user_id_hash", "cast(id % 5 > 2 as int) is_churned",
                                     *[f"cast({'id % 5' if c == 'total_orders' else 'id'} as double) {c}" for c in ft.FEATURE_COLUMNS])
    model, table = ml.train_churn(df, trees=2, folds=2, exclude_leaky=True)
    got = {r.metric: r.mean for r in table.collect()}
    assert got["cv_roc_auc"] > 0.95 and "feature_importance_days_since_last_order" not in got
    assert ml.score_churn(model, df).count() == 200
    with pytest.raises(ValueError):
        ml.train_churn(df.limit(5), trees=1, folds=2)


def test_forecast(spark):
    daily = spark.range(120).selectExpr("'a' k", "date_add(date'2024-01-01', cast(id as int)) ds", "100 + 20 * cast(id % 7 = 0 as int) y").unionByName(
        spark.range(13).selectExpr("'short' k", "date_add(date'2024-01-01', cast(id as int)) ds", "5 y"))
    rows = ml.forecast_demand(daily, ["k"], horizon=14).orderBy("ds").collect()
    assert sum(r.k == "a" for r in rows) == 134 and {r.status for r in rows if r.k == "a"} == {"ok"}
    short = [r for r in rows if r.k == "short"]
    assert len(short) == 13 and all(r.status == "too_short" and r.yhat is None for r in short)
    rows = [r for r in rows if r.k == "a"]
    future = [r for r in rows if r.is_future]
    assert len(future) == 14 and all(0 <= r.yhat_lower <= r.yhat <= r.yhat_upper for r in future)
    peaks = [r.yhat for r in future if (r.ds - date(2024, 1, 1)).days % 7 == 0]
    assert min(peaks) > max(r.yhat for r in future if (r.ds - date(2024, 1, 1)).days % 7 != 0)


def test_forecast_keeps_null_keys_and_empty_days(spark):
    daily = spark.range(40).selectExpr("cast(null as bigint) k", "date_add(date'2024-01-01', cast(2 * id as int)) ds", "4 y").unionByName(
        spark.range(40).selectExpr("7L k", "date_add(date'2024-01-01', cast(id as int)) ds", "4 y"))
    rows = ml.forecast_demand(daily, ["k"], horizon=5).collect()
    assert {k: sum(r.k == k for r in rows) for k in (None, 7)} == {None: 79 + 5, 7: 45}
    assert sum(r.yhat for r in rows if r.k is None and not r.is_future) < 0.6 * 79 * 4


def test_clustered_facts_are_skipped_by_date_and_by_user(spark, tmp_path):
    from pathlib import Path

    import pyarrow.parquet as pq

    from orderlake.operators import gold
    from orderlake.sources import sinks
    fact = spark.range(40_000).select(
        F.col("id").cast("string").alias("order_id"), F.date_add(F.lit("2020-01-01"), (F.col("id") % 997).cast("int")).cast("timestamp").alias("order_date"),
        F.when(F.col("id") % 5 == 0, F.sha2(F.lit("hot"), 256)).otherwise(F.sha2((F.col("id") % 2000).cast("string"), 256)).alias("user_id_hash"))
    sinks.write_clustered_fact(fact, str(tmp_path / "z"), 64)
    fact.repartitionByRange(64, "order_date").write.parquet(str(tmp_path / "by_date"))
    user = fact.where("user_id_hash <> sha2('hot', 256)").first().user_id_hash

    def share(name, column, value):
        groups = [pq.ParquetFile(p).metadata for p in Path(tmp_path / name).glob("*.parquet")]
        stats = [g.row_group(i).column(j).statistics for g in groups for i in range(g.num_row_groups) for j in range(g.num_columns) if g.row_group(i).column(j).path_in_schema == column]
        return sum(s.min <= value <= s.max for s in stats) / len(stats)
    from datetime import timezone
    by_day = share("z", "order_date", datetime(2021, 3, 1, tzinfo=timezone.utc))
    assert by_day < 0.35 and share("z", "user_id_hash", user) < 0.35 and share("by_date", "user_id_hash", user) > 0.9
    assert spark.read.parquet(str(tmp_path / "z")).count() == 40_000
    assert gold.z_order_fact(fact.limit(0), 4).count() == 0
