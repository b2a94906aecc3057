"""Per-user features, training table and demand series."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions import ERASED, FEATURE_COLUMNS, churn_score, ltv_segment, safe_divide


def _active_months(year_aware: bool) -> Column:
    """Distinct month numbers as a 12-bit set, which keeps the aggregate to one pass without a distinct shuffle."""
    if year_aware:
        return F.count_distinct("order_year", "order_month")
    return F.expr("cast(bit_count(bit_or(shiftleft(1, order_month))) as bigint)")


def user_features(fact: DataFrame, as_of: date, year_aware: bool = False) -> DataFrame:
    today = F.lit(as_of)
    refunded = F.count_if("is_refunded_or_cancelled")
    return fact.filter(F.col("user_id_hash") != ERASED).groupBy("user_id_hash").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.max("order_date").alias("event_timestamp"),
        F.datediff(today, F.to_date(F.max("order_date"))).cast("bigint").alias("days_since_last_order"),
        F.bround(F.avg("total_cents"), 0).cast("bigint").alias("avg_order_value_cents"),
        F.sum("total_cents").alias("lifetime_value_cents"),
        F.round(refunded / F.count(F.lit(1)), 4).alias("refund_rate"),
        _active_months(year_aware).alias("active_months"),
        F.datediff(F.to_date(F.max("order_date")), F.to_date(F.min("order_date"))).cast("bigint").alias("customer_age_days"),
    )


def materialize_features(fact: DataFrame, as_of: date) -> DataFrame:
    score = F.round(churn_score(F.col("days_since_last_order"), F.col("total_orders"), F.col("avg_order_value_cents")), 4)
    return user_features(fact, as_of).withColumns({"ltv_segment": ltv_segment("lifetime_value_cents"), "churn_risk_score": score})


def churn_training_features(fact: DataFrame, as_of: date, churn_days: int = 60, year_aware: bool = False) -> DataFrame:
    stats = fact.filter(F.col("user_id_hash") != ERASED).groupBy("user_id_hash").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.max("created_at").alias("last_order_date"),
        F.min("created_at").alias("first_order_date"),
        F.avg("total_cents").alias("avg_order_value_cents"),
        F.sum("total_cents").alias("lifetime_value_cents"),
        F.count_if("is_refunded_or_cancelled").alias("refund_count"),
        _active_months(year_aware).alias("active_months"),
        F.max(F.when(F.col("is_delivered"), F.col("order_date"))).alias("last_delivered_date"),
    )
    idle = F.datediff(F.lit(as_of), F.to_date("last_order_date")).cast("bigint")
    return stats.select(
        "user_id_hash", "total_orders", "avg_order_value_cents", "lifetime_value_cents", "refund_count", "active_months",
        F.datediff(F.to_date("last_order_date"), F.to_date("first_order_date")).cast("bigint").alias("customer_age_days"),
        idle.alias("days_since_last_order"),
        safe_divide("refund_count", "total_orders").alias("refund_rate"),
        safe_divide("lifetime_value_cents", "active_months").alias("avg_monthly_spend"),
        "last_delivered_date",
        F.when(idle > churn_days, 1).otherwise(0).alias("is_churned"),
    )


def daily_demand(fact: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Orders per day (optionally per series key), refunded and cancelled orders left out."""
    kept = fact.filter(F.col("order_date").isNotNull() & ~F.col("is_refunded_or_cancelled"))
    return kept.groupBy(*(keys or []), F.to_date("order_date").alias("ds")).agg(F.count(F.lit(1)).alias("y"))


def product_daily_demand(fact: DataFrame, items: DataFrame) -> DataFrame:
    """Units per product and day. Items are first reduced to one row per (order, product)."""
    kept = fact.filter(~F.col("is_refunded_or_cancelled")).select("order_id", F.to_date("order_date").alias("ds"))
    units = items.groupBy("order_id", "product_id").agg(F.sum("quantity").alias("units"))
    return units.join(kept, "order_id").groupBy("product_id", "ds").agg(F.sum("units").alias("y"))
