"""Parameterised read queries over the marts."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.functions import churn_recommendation, churn_score, churn_tier

ORDER_ID_PATTERNS = {"serving": r"[0-9a-f-]{36}", "app": r"[0-9a-f-]{32,36}"}


def check_limit(limit: int, top: int = 365) -> int:
    if not 1 <= limit <= top:
        raise ValueError(f"limit must be between 1 and {top}")
    return limit


def daily_revenue_latest(daily: DataFrame, limit: int = 30) -> DataFrame:
    return serving_daily_row(daily.orderBy(F.col("order_date").desc()).limit(check_limit(limit)))


def serving_daily_row(daily: DataFrame) -> DataFrame:
    counts = ["order_count", "unique_buyers", "gross_revenue_cents", "net_revenue_cents", "avg_order_value_cents"]
    return daily.select(
        F.date_format("order_date", "yyyy-MM-dd HH:mm:ss").alias("order_date"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
        F.coalesce("refund_rate_pct", F.lit(0.0)).alias("refund_rate_pct"),
    )


def order_by_id(fact: DataFrame, order_id: str, style: str = "serving") -> DataFrame:
    if not re.fullmatch(ORDER_ID_PATTERNS[style], order_id.lower()):
        raise ValueError("invalid order_id format")
    return fact.filter(F.col("order_id") == F.lit(order_id)).select(
        "order_id", "user_id_hash", "order_status", "total_cents", "net_revenue_cents", "currency",
        F.date_format("order_date", "yyyy-MM-dd HH:mm:ss").alias("order_date"))


def orders_list(fact: DataFrame, status: str | None = None) -> DataFrame:
    rows = fact if status is None else fact.filter(F.col("order_status") == F.lit(status))
    return rows.select("order_id", "user_id_hash", "warehouse_id", "order_status", "total_cents", "currency", "channel",
                       "order_date", "created_at")


def recent_orders(fact: DataFrame, limit: int = 20, status: str | None = None) -> DataFrame:
    return orders_list(fact, status).orderBy(F.col("created_at").desc(), "order_id").limit(check_limit(limit, 100))


def since_days(df: DataFrame, as_of: date, days: int, column: str = "order_date") -> DataFrame:
    return df.filter(F.col(column) >= F.date_sub(F.lit(as_of), days).cast("timestamp"))


def revenue_by_channel(fact: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    return since_days(fact, as_of, days).groupBy("channel").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("total_cents").alias("revenue_cents"),
        F.avg("total_cents").alias("avg_order_value_cents")).orderBy(F.col("revenue_cents").desc(), "channel")


def kpi_summary(daily: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """Totals over the daily table. The two averages are unweighted over days; ``weighted_aov_cents`` is the exact one."""
    return since_days(daily, as_of, days).agg(
        F.sum("order_count").alias("total_orders"), F.sum("gross_revenue_cents").alias("gross_revenue_cents"),
        F.sum("net_revenue_cents").alias("net_revenue_cents"), F.sum("total_discount_cents").alias("discount_cents"),
        F.avg("avg_order_value_cents").alias("avg_order_value_cents"), F.avg("refund_rate_pct").alias("avg_refund_rate_pct"),
        F.sum("delivered_order_count").alias("delivered_count"),
        F.try_divide(F.sum("gross_revenue_cents").cast("double"), F.sum("order_count").cast("double")).alias("weighted_aov_cents"))


def low_stock(inventory: DataFrame, status: str | None = None) -> DataFrame:
    rows = inventory if status is None else inventory.filter(F.col("status") == F.lit(status))
    return rows.orderBy("days_remaining", "sku", "warehouse")


def pipeline_history(runs: DataFrame, limit: int = 30) -> DataFrame:
    return runs.groupBy("run_date").agg(
        F.count_if(F.col("status") == "success").alias("success_count"),
        F.count_if(F.col("status") == "failed").alias("failed_count"),
        F.sum("records").alias("total_records")).orderBy(F.col("run_date").desc()).limit(limit)


def latest_run_rows(runs: DataFrame, column: str = "run_date") -> DataFrame:
    """Rows of the newest run, through a scalar subquery evaluated once."""
    return runs.filter(F.col(column) == runs.agg(F.max(column)).scalar())


def pipeline_status(runs: DataFrame, checks: DataFrame) -> DataFrame:
    """Tasks of the latest run (by start) followed by the latest quality checks, in one long table."""
    tasks = latest_run_rows(runs).select(
        F.lit("task").alias("section"), F.col("task_name").alias("name"), "status", F.col("duration_s").cast("bigint").alias("duration_s"),
        F.col("records").cast("bigint").alias("rows"), F.lit(None).cast("bigint").alias("failed_rows"), F.col("started_at"))
    quality = latest_run_rows(checks, "check_date").select(
        F.lit("check").alias("section"), F.col("check_name").alias("name"),
        F.when(F.col("passed") == 1, "success").otherwise("failed").alias("status"), F.lit(None).cast("bigint").alias("duration_s"),
        F.col("rows_checked").cast("bigint").alias("rows"), F.col("failed_rows").cast("bigint").alias("failed_rows"),
        F.lit(None).cast("string").alias("started_at"))
    return tasks.unionByName(quality).orderBy(F.col("section").desc(), "started_at", "name")


def table_counts(tables: dict[str, DataFrame | None]) -> DataFrame:
    """Row count per table; -1 where the table is not available. One job for all tables."""
    spark = next(df.sparkSession for df in tables.values() if df is not None)
    counted = None
    for name, df in tables.items():
        one = (spark.range(1).select(F.lit(name).alias("table_name"), F.lit(-1).cast("bigint").alias("row_count")) if df is None
               else df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count"))
        counted = one if counted is None else counted.unionByName(one)
    return counted


def score_customers(features: DataFrame, wording: str = "serving") -> DataFrame:
    score = churn_score(F.col("days_since_last_order"), F.col("total_orders"), F.col("avg_order_value_cents"))
    tier = churn_tier(score)
    return features.select(
        "user_id_hash", F.round(score, 4).alias("churn_probability"), tier.alias("risk_tier"),
        churn_recommendation(tier, wording).alias("recommendation"))


def score_requests(requests: DataFrame, wording: str = "app") -> DataFrame:
    """Batch form of the scoring request: out-of-range input gets an error text and no score."""
    days, orders, aov = F.col("days_since_last_order"), F.col("total_orders"), F.col("avg_order_value_cents")
    error = (F.when(days.isNull() | orders.isNull() | aov.isNull(), "invalid input - expected integers")
             .when(~days.between(0, 3650), "days_since_last_order must be 0-3650")
             .when(orders < 0, "total_orders must be >= 0")
             .when(aov < 0, "avg_order_value_cents must be >= 0"))
    score = churn_score(days, orders, aov)
    ok = F.col("error").isNull()
    return requests.withColumn("error", error).select(
        "user_id_hash", F.when(ok, F.round(score, 4)).alias("churn_probability"), F.when(ok, churn_tier(score)).alias("risk_tier"),
        F.when(ok, churn_recommendation(churn_tier(score), wording)).alias("recommendation"), "error")


def order_dimensions(orders: DataFrame, users: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Foreign-key lookups. No broadcast hints: the optimizer broadcasts a side only below its size threshold, and a busy
    user's partition is split at run time otherwise."""
    return orders.join(users, "user_id_hash", "left").join(warehouses, "warehouse_id", "left")

