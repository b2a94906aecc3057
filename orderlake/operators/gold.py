"""Staging, facts, daily revenue and cohort retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from orderlake.functions import ERASED, cents_to_dollars, day_name, month_offset, safe_divide, value_tier
from orderlake.operators.keyed import latest_per_key


def stg_orders(silver: DataFrame, latest_across_dates: bool = False) -> DataFrame:
    """Typed staging rows with a key, a user and a positive total.

    ``latest_across_dates`` keeps only the newest change when an order appears under several run dates.
    """
    kept = silver.filter(F.col("order_id").isNotNull() & F.col("user_id_hash").isNotNull() & (F.col("total_cents") > 0))
    if latest_across_dates:
        kept = latest_per_key(kept, ["order_id"], [F.col("cdc_ts_ms"), F.col("updated_at"), F.xxhash64(*kept.columns)])
    created = F.col("created_at").cast("timestamp")
    columns = [
        F.col("order_id"), F.col("user_id_hash"), F.col("warehouse_id"), F.col("status").alias("order_status"), F.col("currency"),
        *[F.col(c).cast("bigint").alias(c) for c in ("subtotal_cents", "discount_cents", "shipping_cents", "total_cents")],
        (F.col("total_cents") - F.col("discount_cents")).cast("bigint").alias("net_revenue_cents"),
        F.col("cdc_op"), F.col("cdc_ts_ms").cast("bigint").alias("cdc_ts_ms"),
        created.alias("created_at"), F.col("updated_at").cast("timestamp").alias("updated_at"),
        F.date_trunc("day", created).alias("order_date"),
    ]
    if "channel" in silver.columns:
        columns.append(F.col("channel"))
    return kept.select(*columns)


def _flags() -> dict[str, Column]:
    return {
        "is_delivered": F.col("order_status") == "delivered",
        "is_refunded_or_cancelled": F.col("order_status").isin("refunded", "cancelled"),
    }


def _calendar() -> dict[str, Column]:
    return {
        "order_year": F.year("created_at"),
        "order_month": F.month("created_at"),
        "order_day_of_week": F.dayofweek("created_at") - F.lit(1),
    }


def orders_enriched(staged: DataFrame) -> DataFrame:
    rows = staged.withColumns(_calendar()).withColumns({
        **_flags(),
        "has_discount": F.col("discount_cents") > 0,
        "is_free_shipping": F.col("shipping_cents") == 0,
        "order_value_tier": value_tier("total_cents"),
        "order_day_name": day_name("order_day_of_week"),
        "discount_rate": safe_divide("discount_cents", "total_cents"),
    })
    return rows.drop("cdc_ts_ms", "channel")


def fact_orders(staged: DataFrame, load_time: Column | None = None) -> DataFrame:
    """One row per order. ``load_time`` adds the load timestamp column."""
    rows = staged.withColumns({**_flags(), **_calendar()}).drop("cdc_ts_ms")
    return rows if load_time is None else rows.withColumn("dbt_loaded_at", load_time)


def item_count(staged: DataFrame) -> DataFrame:
    """Rows per order id next to each row, by aggregate and join so repeated ids never gather in one window."""
    counts = staged.groupBy("order_id").agg(F.count(F.lit(1)).alias("item_count"))
    return staged.join(counts, "order_id")


def daily_revenue(fact: DataFrame) -> DataFrame:
    refunded = F.count_if("is_refunded_or_cancelled")
    return fact.groupBy("order_date", "order_year", "order_month").agg(
        F.count_distinct("order_id").alias("order_count"),
        F.count_distinct("user_id_hash").alias("unique_buyers"),
        F.sum("total_cents").alias("gross_revenue_cents"),
        F.sum("net_revenue_cents").alias("net_revenue_cents"),
        F.sum("discount_cents").alias("total_discount_cents"),
        F.sum("shipping_cents").alias("total_shipping_cents"),
        F.bround(F.avg("total_cents"), 0).cast("bigint").alias("avg_order_value_cents"),
        refunded.alias("refunded_order_count"),
        F.round(F.lit(100.0) * refunded / F.count(F.lit(1)), 2).alias("refund_rate_pct"),
        F.count_if("is_delivered").alias("delivered_order_count"),
    )


def daily_revenue_app(fact: DataFrame) -> DataFrame:
    """Application variant: floored average order value and no year / month columns."""
    refunded = F.count_if("is_refunded_or_cancelled")
    return fact.groupBy("order_date").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.count_distinct("user_id_hash").alias("unique_buyers"),
        F.sum("total_cents").alias("gross_revenue_cents"),
        F.sum("net_revenue_cents").alias("net_revenue_cents"),
        F.sum("discount_cents").alias("discount_cents"),
        F.sum("shipping_cents").alias("shipping_cents"),
        F.expr("sum(total_cents) div count(1)").alias("avg_order_value_cents"),
        refunded.alias("refunded_order_count"),
        F.round(refunded / F.count(F.lit(1)) * F.lit(100.0), 2).alias("refund_rate_pct"),
        F.count_if("is_delivered").alias("delivered_order_count"),
    )


def exclude_erased_refunded(fact: DataFrame) -> DataFrame:
    return fact.filter(~F.col("is_refunded_or_cancelled") & (F.col("user_id_hash") != ERASED))


def first_orders(fact: DataFrame) -> DataFrame:
    first = exclude_erased_refunded(fact).groupBy("user_id_hash").agg(F.min("order_date").alias("first_order_date"))
    return first.select("user_id_hash", F.date_trunc("month", "first_order_date").alias("cohort_month"), "first_order_date")


def distinct_activity(fact: DataFrame) -> DataFrame:
    return exclude_erased_refunded(fact).select("user_id_hash", F.date_trunc("month", "order_date").alias("activity_month")).distinct()


def order_months(fact: DataFrame) -> DataFrame:
    """(user, cohort month, active month). A user's cohort month is the earliest of their active months, so no join back to
    the fact is needed: after the distinct, a user has at most one row per month."""
    months = distinct_activity(fact)
    cohort = F.min("activity_month").over(Window.partitionBy("user_id_hash"))
    return months.select("user_id_hash", cohort.alias("cohort_month"), "activity_month")


def cohort_sizes(fact: DataFrame) -> DataFrame:
    return first_orders(fact).groupBy("cohort_month").agg(F.count(F.lit(1)).alias("cohort_size"))


def user_cohorts(fact: DataFrame) -> DataFrame:
    """Retention per cohort and month. Every member is active in the cohort's own month, so that row carries the size."""
    retained = order_months(fact).groupBy("cohort_month", "activity_month").agg(F.count(F.lit(1)).alias("retained_users"))
    size = F.max(F.when(F.col("cohort_month") == F.col("activity_month"), F.col("retained_users"))).over(Window.partitionBy("cohort_month"))
    return retained.withColumn("cohort_size", size).select(
        F.date_format("cohort_month", "yyyy-MM-dd HH:mm:ss").alias("cohort_month"),
        month_offset("cohort_month", "activity_month").alias("period_offset"),
        F.date_format("activity_month", "yyyy-MM-dd HH:mm:ss").alias("activity_month"),
        "cohort_size",
        "retained_users",
        (safe_divide("retained_users", "cohort_size") * F.lit(100.0)).alias("retention_rate_pct"),
    )


def retention_with_size(retention: DataFrame, sizes: DataFrame) -> DataFrame:
    """Retention rows joined to cohort sizes (both are one row per month or month pair)."""
    return retention.join(sizes, "cohort_month")


def gmv_metrics(daily: DataFrame) -> DataFrame:
    """Daily KPIs in currency units."""
    return daily.select(
        "order_date",
        cents_to_dollars("gross_revenue_cents").alias("gmv"),
        cents_to_dollars("net_revenue_cents").alias("net_revenue"),
        cents_to_dollars("avg_order_value_cents").alias("aov"),
        F.col("refund_rate_pct").alias("refund_rate"),
        "unique_buyers",
    )


def cluster_fact(fact: DataFrame, files: int) -> DataFrame:
    """Layout for date and user lookups: range partitions on (date, user, order), sorted inside each.

    The order id is part of the range key so that one busy day or user still spreads over several files.
    """
    keys = ["order_date", "user_id_hash", "order_id"]
    return fact.repartitionByRange(files, *keys).sortWithinPartitions(*keys)


def range_ranks(df: DataFrame, values: dict[str, Column], bits: int) -> DataFrame:
    """Columns that say in which of ``2 ** bits`` ranges, of about equal numbers of rows, each numeric value falls; null is in the first. A value with
    many rows may fill several ranges."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = df.agg(F.struct(*[F.percentile_approx(v, shares, 1 << (bits + 4)).alias(n) for n, v in values.items()])).scalar()
    rows = df.withColumn("_cuts", cuts).withColumns({f"_v_{n}": v for n, v in values.items()})

    def rank(name: str) -> Column:
        passed = F.filter(F.col(f"_cuts.{name}"), lambda cut: cut <= F.col(f"_v_{name}"))
        return F.greatest(F.coalesce(F.size(passed), F.lit(0)), F.lit(0)).cast("bigint")
    return rows.withColumns({n: rank(n) for n in values}).drop("_cuts", *[f"_v_{n}" for n in values])


def z_value(ranks: list[Column], bits: int) -> Column:
    """The bits of all ranks in turn, highest first, as one number: rows that are near in every rank are near in it."""
    parts = [F.shiftleft(F.shiftright(rank, b).bitwiseAND(1), b * len(ranks) + i) for b in range(bits) for i, rank in enumerate(ranks)]
    out = parts[0]
    for part in parts[1:]:
        out = out + part
    return out


def z_order_fact(fact: DataFrame, files: int, bits: int = 6) -> DataFrame:
    """Layout in which a date filter and a user filter each meet only a part of the row groups: range partitions on the interleaved bits of the
    ranks of ``order_date`` and ``user_id_hash``, sorted inside each. The order id spreads a busy (day, user) cell over files."""
    day = F.unix_date(F.col("order_date").cast("date"))
    user = F.conv(F.substring("user_id_hash", 1, 8), 16, 10).cast("bigint")
    ranked = range_ranks(fact, {"_user": user, "_day": day}, bits)
    rows = ranked.withColumn("_z", z_value([F.col("_user"), F.col("_day")], bits))
    return rows.repartitionByRange(files, "_z", "order_id").sortWithinPartitions("_z", "order_date", "user_id_hash").drop("_z", "_user", "_day")
