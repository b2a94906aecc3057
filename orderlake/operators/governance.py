"""Right to erasure, audit records, retention, salt rotation and backfill."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.functions import ERASED, hash_pii
from orderlake.operators.clicks import parse_click_events, session_parts
from orderlake.operators.orders import SILVER_COLUMNS, dedup_latest, parse_cdc_orders, transform_metrics, validate_orders
from orderlake.session import scratch
from orderlake.sources.bronze import read_bronze_events, read_bronze_orders
from orderlake.sources.sinks import STORED, append_jsonl, rewrite_partitions, write_partitioned


def erasure_requests(requests: DataFrame, salt: str) -> DataFrame:
    """Request ids with the user's hash; the raw id goes no further than this projection."""
    return requests.filter(F.coalesce("user_id", F.lit("")) != "").select("request_id", hash_pii("user_id", salt).alias("user_id_hash"))


def erase_users(rows: DataFrame, requests: DataFrame) -> DataFrame:
    """Rows with the hash of every requested user replaced by the tombstone; no row is removed."""
    wanted = requests.select("user_id_hash").distinct().withColumn("_erase", F.lit(True))
    joined = rows.join(wanted, "user_id_hash", "left")
    return joined.withColumn("user_id_hash", F.when(F.col("_erase"), F.lit(ERASED)).otherwise(F.col("user_id_hash"))).select(*rows.columns)


def erasure_counts(rows: DataFrame, requests: DataFrame, partition: str) -> DataFrame:
    """Rows to erase per (user, partition)."""
    wanted = requests.select("user_id_hash").distinct()
    return rows.join(wanted, "user_id_hash", "left_semi").groupBy("user_id_hash", partition).agg(F.count(F.lit(1)).alias("affected_rows"))


def erase_table(spark: SparkSession, path: str, requests: DataFrame, partition: str) -> tuple[int, int]:
    """Erase in a stored table, rewriting only the partitions that hold a requested user. (partitions, rows) affected.

    Any failure surfaces: an erasure that could not be done must not look finished. Repeating it changes nothing.
    """
    table = spark.read.parquet(path)
    hit = erasure_counts(table, requests, partition).groupBy(partition).agg(F.sum("affected_rows").alias("n")).collect()
    if not hit:
        return 0, 0
    affected = table.filter(F.col(partition).isin([r[0] for r in hit]))
    rewrite_partitions(spark, erase_users(affected, requests), path, partition)
    return len(hit), sum(r["n"] for r in hit)


def erasure_audit(requests: DataFrame, silver: DataFrame, gold: DataFrame, partition: str, completed_at: Column, run_id: str) -> DataFrame:
    """One audit record per request, also when nothing matched. Only a short prefix of the hash is kept."""
    s = silver.groupBy("user_id_hash").agg(F.count_distinct(partition).alias("silver_parts"), F.sum("affected_rows").alias("silver_rows"))
    g = gold.groupBy("user_id_hash").agg(F.sum("affected_rows").alias("gold_rows"))

    def known(name: str) -> Column:
        return F.coalesce(name, F.lit(0)).cast("bigint")

    return requests.join(s, "user_id_hash", "left").join(g, "user_id_hash", "left").select(
        F.lit("gdpr_erasure").alias("event"), "request_id", F.concat(F.substring("user_id_hash", 1, 8), F.lit("...")).alias("user_id_hash_prefix"),
        completed_at.alias("completed_at"),
        F.struct(known("silver_parts").alias("affected_files"), known("silver_rows").alias("affected_rows")).alias("silver"),
        F.struct(known("gold_rows").alias("deleted_rows")).alias("gold"), F.lit(run_id).alias("dag_run_id"))


def write_audit(audit: DataFrame, path: str, run_id: str) -> None:
    append_jsonl(audit, path, run_id)


def expire_partitions(rows: DataFrame, as_of: date, keep_days: int, column: str = "run_date") -> DataFrame:
    """Rows of partitions still inside the retention period (a partition filter, so expired files are not opened)."""
    return rows.filter(F.col(column) >= F.lit(as_of - timedelta(days=keep_days)))


def rotate_salt(lines: DataFrame, new_salt: str) -> DataFrame:
    """Clean orders rebuilt from raw events under a new salt: the only way to change every hash."""
    checked = validate_orders(parse_cdc_orders(lines.filter("v is not null"), new_salt))
    return dedup_latest(checked.filter(F.size("errors") == 0).select(*SILVER_COLUMNS))


def check_range(start: date, end: date) -> int:
    if end < start:
        raise ValueError("end must be on or after start")
    return (end - start).days + 1


def checked_lines(spark: SparkSession, bronze_root: str, start: date, end: date, salt: str, pattern: str) -> DataFrame:
    """Order lines of an inclusive range, parsed and validated once: written to the shared folder, and read by whatever needs them."""
    lines = read_bronze_orders(spark, bronze_root, start, end, pattern)
    path = scratch(spark, "checked")
    checked = validate_orders(parse_cdc_orders(lines.filter("v is not null"), salt)).select(*SILVER_COLUMNS, "run_date", "errors")
    checked.write.option("compression", STORED).parquet(path)
    return spark.read.schema(checked.schema).parquet(path)


def write_valid(checked: DataFrame, silver_path: str) -> None:
    valid = checked.filter(F.size("errors") == 0).select(*SILVER_COLUMNS, "run_date")
    write_partitioned(dedup_latest(valid, ["run_date", "order_id"]), silver_path, ["run_date"])


def backfill(spark: SparkSession, bronze_root: str, silver_path: str, start: date, end: date, salt: str, dry_run: bool = False,
             pattern: str = "*.jsonl") -> DataFrame:
    """Rebuild clean orders of an inclusive date range as one job; per-date metrics.

    Dates are folders, so only those of the range are listed; the write replaces just those dates. Lines are parsed once.
    """
    check_range(start, end)
    checked = checked_lines(spark, bronze_root, start, end, salt, pattern)
    if not dry_run:
        write_valid(checked, silver_path)
    return transform_metrics(checked, ["run_date"])


def backfill_ledger(spark: SparkSession, bronze_root: str, silver_path: str, parts_path: str, start: date, end: date, salt: str, dry_run: bool = False,
                    pattern: str = "*.jsonl") -> DataFrame:
    """Rebuild clean orders and session parts of an inclusive date range; one row per date asked for: order metrics, ``events``, ``untimed`` and whether it failed.

    A date fails if no order line of it can be read, because it is absent or unreadable. Session parts are replaced date by date; ``stitch_sessions`` of the
    parts table gives whole sessions, also over the borders of the range.
    """
    check_range(start, end)
    metrics = backfill(spark, bronze_root, silver_path, start, end, salt, dry_run, pattern)
    clicks = parse_click_events(read_bronze_events(spark, bronze_root, start, end, pattern), salt).withColumn("occurred_at", F.try_to_timestamp("occurred_at"))
    path = scratch(spark, "clicks")
    clicks.write.parquet(path)
    clicks = spark.read.schema(clicks.schema).parquet(path)
    if not dry_run:
        write_partitioned(session_parts(clicks), parts_path, ["run_date"])
    events = clicks.groupBy("run_date").agg(F.count(F.lit(1)).alias("events"), F.count_if(F.col("occurred_at").isNull()).alias("untimed"))
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("run_date"))
    known = days.join(metrics, "run_date", "left").join(events, "run_date", "left")
    counts = ("processed", "valid", "invalid", "deduplicated", "events", "untimed")
    return known.select("run_date", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts], F.col("processed").isNull().alias("failed"))


def backfill_summary(ledger: DataFrame, sessions: DataFrame) -> DataFrame:
    """One row: dates attempted and failed, the failed dates themselves, totals, and how many of ``sessions`` begin within the dates."""
    span = ledger.agg(
        F.count(F.lit(1)).alias("dates_attempted"), F.count_if("failed").alias("dates_failed"), F.array_sort(F.collect_list(F.when(F.col("failed"), F.col("run_date")))).alias("failed_dates"),
        *[F.sum(c).alias(f"total_{c}") for c in ("processed", "valid", "events")], F.min("run_date").alias("_first"), F.max("run_date").alias("_last"))
    begun = sessions.groupBy(F.to_date("session_start").alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
    within = span.join(begun, (F.col("_day") >= F.col("_first")) & (F.col("_day") <= F.col("_last")), "left")
    kept = [c for c in span.columns if not c.startswith("_")]
    return within.groupBy(*kept).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total_sessions"))


def backfill_totals(metrics: DataFrame, start: date, end: date) -> DataFrame:
    """Totals over every date that was asked for. A date without a processed row, absent or unreadable, has failed."""
    check_range(start, end)
    days = metrics.sparkSession.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("run_date"))
    return days.join(metrics, "run_date", "left").agg(
        F.count(F.lit(1)).alias("dates_attempted"),
        F.count_if(F.coalesce("processed", F.lit(0)) == 0).alias("dates_failed"),
        F.coalesce(F.sum("processed"), F.lit(0)).alias("total_processed"), F.coalesce(F.sum("valid"), F.lit(0)).alias("total_valid"))
