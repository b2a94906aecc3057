"""Quality suite, schema tests, freshness and volume checks. Each check set is one pass over its table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.functions import CURRENCIES, ERASED, ORDER_STATUSES, PII_COLUMNS

SUITE_CHECKS = [
    "order_id_not_null", "order_id_unique", "user_id_hash_not_null", "user_id_hash_length", "no_raw_user_id",
    "status_valid", "total_cents_positive", "currency_valid", "row_volume",
]


def _blank(name: str) -> Column:
    text = F.trim(F.coalesce(F.col(name).cast("string"), F.lit("")))
    return text.isin("", "None", "nan")


def dq_orders_suite(orders: DataFrame, strict: bool = False) -> DataFrame:
    """One row per check: name, passed, failed_rows, rows_checked.

    Erased users are exempt from the hash length check unless ``strict``. A total that is not a number counts as failing.
    All row checks and the duplicate count share one aggregate; the count of distinct ids is its only shuffle.
    """
    have = set(orders.columns)

    def count(test: Column, *needs: str) -> Column:
        return F.count_if(test) if have.issuperset(needs) else F.lit(0).cast("bigint")

    hash_col = F.coalesce(F.col("user_id_hash"), F.lit("")) if "user_id_hash" in have else F.lit("")
    bad_length = (hash_col != "") & (F.length(hash_col) != 64)
    if not strict:
        bad_length = bad_length & (hash_col != ERASED)

    def unlisted(name: str, allowed: list[str]) -> Column:
        # An absent value reads as the text 'None' and fails; an empty one is ignored.
        return ~F.coalesce(F.col(name), F.lit("None")).isin([*allowed, ""]) if name in have else F.lit(False)

    some_id = F.coalesce(F.col("order_id").cast("string"), F.lit("")) != ""
    total = F.col("total_cents").try_cast("bigint") if "total_cents" in have else F.lit(1)
    one = orders.agg(
        F.count(F.lit(1)).alias("rows"),
        count(_blank("order_id"), "order_id").alias("order_id_not_null"),
        (F.count_if(some_id) - F.count_distinct(F.when(some_id, F.col("order_id")))).alias("order_id_unique"),
        count(_blank("user_id_hash") if "user_id_hash" in have else F.lit(False), "user_id_hash").alias("user_id_hash_not_null"),
        count(bad_length, "user_id_hash").alias("user_id_hash_length"),
        F.lit(1 if "user_id" in have else 0).cast("bigint").alias("no_raw_user_id"),
        count(unlisted("status", ORDER_STATUSES), "status").alias("status_valid"),
        count(~F.coalesce(total > 0, F.lit(False)), "total_cents").alias("total_cents_positive"),
        count(unlisted("currency", CURRENCIES), "currency").alias("currency_valid"),
    ).withColumn("row_volume", F.when(F.col("rows") == 0, 1).otherwise(0).cast("bigint"))
    pairs = F.array(*[F.struct(F.lit(c).alias("check_name"), F.col(c).alias("failed_rows")) for c in SUITE_CHECKS])
    return one.select("rows", F.inline(pairs)).select(
        "check_name", (F.col("failed_rows") == 0).alias("passed"), "failed_rows", F.col("rows").alias("rows_checked"))


def suite_result(checks: DataFrame, files_checked: int) -> DataFrame:
    """Summary row: success, files, rows, checks run / passed, failed check names."""
    return checks.agg(
        F.every("passed").alias("success"), F.lit(files_checked).cast("bigint").alias("files_checked"), F.max("rows_checked").alias("rows"),
        F.count(F.lit(1)).alias("checks_run"), F.count_if("passed").alias("checks_passed"),
        F.array_join(F.array_sort(F.collect_list(F.when(~F.col("passed"), F.col("check_name")))), ",").alias("failures"))


def quality_history(checks: DataFrame, check_date: date) -> DataFrame:
    return checks.select(F.lit(check_date).alias("check_date"), "check_name", F.col("passed").cast("int").alias("passed"), "rows_checked", "failed_rows")


def run_log(metrics: DataFrame, run_id: str, run_date: date, task: str, duration_s: int) -> DataFrame:
    """One run record from transform metrics."""
    return metrics.select(
        F.lit(run_id).alias("run_id"), F.lit(run_date).alias("run_date"), F.lit(task).alias("task_name"),
        F.when(F.col("valid") > 0, "success").otherwise("failed").alias("status"), F.lit(duration_s).alias("duration_s"),
        F.col("processed").alias("records"))


def test_unique(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def test_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def test_accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.filter(~F.col(column).isin(values)).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def test_no_negative_revenue(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("net_revenue_cents") < 0)


def invalid_values(df: DataFrame, column: str, valid: list[str]) -> DataFrame:
    text = F.coalesce(F.col(column).cast("string"), F.lit("None"))
    return df.select(text.alias(column)).filter(~F.col(column).isin([*valid, ""])).distinct()


def duplicate_count(df: DataFrame, column: str) -> DataFrame:
    return df.agg((F.count(column) - F.count_distinct(column)).alias("duplicates"))


def source_freshness(df: DataFrame, as_of: Column, column: str = "updated_at", warn_hours: int = 1, error_hours: int = 6) -> DataFrame:
    age = (F.unix_micros(as_of) - F.unix_micros(F.max(F.col(column).cast("timestamp")))) / F.lit(3_600_000_000.0)
    return df.agg(age.alias("age_hours")).select(
        "age_hours", F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_hours), "error")
        .when(F.col("age_hours") > warn_hours, "warn").otherwise("pass").alias("status"))


def silver_freshness(spark: SparkSession, path: str, as_of: Column, max_age_minutes: int = 30) -> DataFrame:
    """Age of the newest file of a table. Only file metadata is needed, so no column is read."""
    newest = spark.read.parquet(path).select(F.col("_metadata.file_modification_time").alias("t")).agg(F.max("t").alias("t"))
    age = (F.unix_micros(as_of) - F.unix_micros("t")) / F.lit(60_000_000.0)
    return newest.select(
        F.lit("silver_freshness").alias("check_name"),
        F.when(F.coalesce(age <= max_age_minutes, F.lit(False)), "pass").otherwise("fail").alias("status"),
        F.round(age, 1).alias("age_minutes"))


def gold_row_counts(fact: DataFrame, daily: DataFrame, as_of: date) -> DataFrame:
    yesterday = F.date_sub(F.lit(as_of), 1).cast("timestamp")
    f = fact.agg(F.count(F.lit(1)).alias("fact_rows"), F.count_if(F.col("order_date") >= yesterday).alias("recent_rows"))
    days = daily.agg(F.count(F.lit(1)).alias("n")).scalar()
    return f.withColumn("daily_rows", days).withColumn(
        "status", F.when((F.col("fact_rows") == 0) | (F.col("daily_rows") == 0) | (F.col("recent_rows") == 0), "fail").otherwise("pass"))


def volume_anomaly(fact: DataFrame, as_of: date, threshold_pct: float = 30.0) -> DataFrame:
    """Today's orders against the average of the days present among the eight before; an absent today counts as zero."""
    today = F.lit(as_of)
    daily = fact.filter(F.col("order_date") >= F.date_sub(today, 8).cast("timestamp")).groupBy(F.to_date("order_date").alias("day")).agg(
        F.count(F.lit(1)).alias("n"))
    stats = daily.agg(F.avg(F.when(F.col("day") < today, F.col("n"))).alias("average"),
                      F.coalesce(F.max(F.when(F.col("day") == today, F.col("n"))), F.lit(0)).alias("today_count"))
    change = (F.col("today_count") - F.col("average")) / F.col("average") * F.lit(100.0)
    return stats.select(
        "today_count", F.round("average", 1).alias("rolling_avg"), F.round(change, 1).alias("pct_change"),
        F.when(F.col("average").isNull(), "skip").when(change < -threshold_pct, "fail").otherwise("pass").alias("status"))


def pii_scan(tables: dict[str, DataFrame]) -> DataFrame:
    """Columns named like personal data, and in how many rows they are filled; only those columns are read."""
    spark = next(iter(tables.values())).sparkSession
    found = spark.createDataFrame([], "table_name string, column_name string, filled bigint, row_count bigint")
    for name, df in tables.items():
        for c in df.columns:
            if c.lower() in PII_COLUMNS:
                found = found.union(df.agg(F.count(f"`{c}`").alias("filled"), F.count(F.lit(1)).alias("n")).select(F.lit(name), F.lit(c), "filled", "n"))
    return found


def agg_reconciles(fact: DataFrame, daily: DataFrame) -> DataFrame:
    f = fact.agg(F.sum("total_cents")).scalar()
    return daily.agg(F.sum("gross_revenue_cents").alias("daily_gross"),
                     F.count_if(F.col("unique_buyers") > F.col("order_count")).alias("days_with_more_buyers_than_orders")).withColumn(
        "fact_gross", f).withColumn("reconciled", (F.col("daily_gross") == F.col("fact_gross")) & (F.col("days_with_more_buyers_than_orders") == 0))
