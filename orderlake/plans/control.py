"""Registered queries: quality, monitoring, governance, models, skew-safe building blocks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from orderlake.functions import CURRENCIES, ORDER_STATUSES
from orderlake.operators import clicks as ck
from orderlake.operators import features as ft
from orderlake.operators import governance as gv
from orderlake.operators import models as ml
from orderlake.operators import orders as od
from orderlake.operators import quality as qa
from orderlake.plans import ingest, marts
from orderlake.plans import tables as t
from orderlake.plans.registry import query
from orderlake.session import scratch
from orderlake.sources import bronze, merge, sinks

CHECK_DATE = "CAST('2001-08-01' AS DATE)"


def silver(spark, d):
    return t.silver_orders(spark, d, dims=False)


def damaged(spark, d):
    """Clean orders with faults put in: duplicate, blank, mistyped and unlisted values."""
    rows = silver(spark, d).withColumn("k", F.col("order_id").cast("bigint"))
    return rows.select(
        F.when(F.col("k") % 41 == 0, F.lit("dup")).when(F.col("k") % 43 == 0, F.lit("")).otherwise(F.col("order_id")).alias("order_id"),
        F.when(F.col("k") % 47 == 0, F.lit("short")).otherwise(F.col("user_id_hash")).alias("user_id_hash"),
        F.when(F.col("k") % 53 == 0, F.lit("lost")).otherwise(F.col("status")).alias("status"),
        F.when(F.col("k") % 59 == 0, F.lit("XXX")).otherwise(F.col("currency")).alias("currency"),
        F.col("total_cents").cast("string").alias("total_cents"))


DAMAGED = """(SELECT CASE WHEN k % 41 = 0 THEN 'dup' WHEN k % 43 = 0 THEN '' ELSE order_id END AS order_id, CASE WHEN k % 47 = 0 THEN 'short' ELSE user_id_hash END AS user_id_hash,
    CASE WHEN k % 53 = 0 THEN 'lost' ELSE status END AS status, CASE WHEN k % 59 = 0 THEN 'XXX' ELSE currency END AS currency, total_cents FROM silver)"""
CHECKS = f"""SELECT check_name, failed_rows = 0 AS passed, failed_rows, rows_checked FROM (
    SELECT unnest(['order_id_not_null', 'order_id_unique', 'user_id_hash_not_null', 'user_id_hash_length', 'no_raw_user_id', 'status_valid', 'total_cents_positive', 'currency_valid', 'row_volume']) AS check_name,
        unnest([count_if(order_id = ''), count_if(order_id <> '') - count(DISTINCT CASE WHEN order_id <> '' THEN order_id END), 0, count_if(length(user_id_hash) <> 64 AND user_id_hash <> 'ERASED'), 0,
            count_if(status = 'lost'), count_if(total_cents <= 0), count_if(currency = 'XXX'), 0])::BIGINT AS failed_rows, count(*) AS rows_checked FROM {DAMAGED})"""

query("dq_orders_suite", CHECKS)(lambda s, d: qa.dq_orders_suite(damaged(s, d)))
query("dq_suite_result", f"""SELECT bool_and(passed) AS success, CAST(1 AS BIGINT) AS files_checked, max(rows_checked) AS rows, count(*) AS checks_run, CAST(count_if(passed) AS BIGINT) AS checks_passed,
    string_agg(CASE WHEN NOT passed THEN check_name END, ',' ORDER BY check_name) AS failures FROM ({CHECKS})""")(
    lambda s, d: qa.suite_result(qa.dq_orders_suite(damaged(s, d)), 1))
query("quality_history", f"SELECT {CHECK_DATE} AS check_date, check_name, CAST(passed AS INT) AS passed, rows_checked, failed_rows FROM ({CHECKS})")(
    lambda s, d: qa.quality_history(qa.dq_orders_suite(damaged(s, d)), t.AS_OF))
query("run_log", f"""SELECT 'run-1' AS run_id, {CHECK_DATE} AS run_date, 'bronze_to_silver' AS task_name, 'success' AS status, 12 AS duration_s, count(*) AS records FROM checked""")(
    lambda s, d: qa.run_log(od.transform_metrics(ingest.checked(s, d)), "run-1", t.AS_OF, "bronze_to_silver", 12))
query("test_unique", f"SELECT order_id, count(*) AS n FROM {DAMAGED} GROUP BY 1 HAVING count(*) > 1")(lambda s, d: qa.test_unique(damaged(s, d), "order_id"))
query("test_not_null", "SELECT order_id, op AS cdc_op FROM checked WHERE user_id_hash IS NULL")(
    lambda s, d: qa.test_not_null(ingest.checked(s, d), "user_id_hash").select("order_id", "cdc_op"))
query("test_accepted_values", f"SELECT status, count(*) AS n FROM {DAMAGED} WHERE status = 'lost' GROUP BY 1")(
    lambda s, d: qa.test_accepted_values(damaged(s, d), "status", ORDER_STATUSES))
query("test_no_negative_revenue", "SELECT order_id, net - 5000000 AS net_revenue_cents FROM (SELECT order_id, net_revenue_cents AS net FROM fact) WHERE net < 5000000")(
    lambda s, d: qa.test_no_negative_revenue(marts.lean_fact(s, d).select("order_id", (F.col("net_revenue_cents") - 5000000).alias("net_revenue_cents"))))
query("invalid_values", f"SELECT DISTINCT currency FROM {DAMAGED} WHERE currency = 'XXX'")(lambda s, d: qa.invalid_values(damaged(s, d), "currency", CURRENCIES))
query("concat_files", "SELECT order_id, status FROM silver UNION ALL SELECT order_id, NULL FROM live")(
    lambda s, d: bronze.concat_files([silver(s, d).select("order_id", "status"), t.live_orders(s, d).select("order_id")]))
query("duplicate_count", f"SELECT count(order_id) - count(DISTINCT order_id) AS duplicates FROM {DAMAGED}")(lambda s, d: qa.duplicate_count(damaged(s, d), "order_id"))
query("source_freshness", """SELECT round(age, 6) AS age_hours, CASE WHEN age > 6 THEN 'error' WHEN age > 1 THEN 'warn' ELSE 'pass' END AS status FROM
    (SELECT (epoch_us(TIMESTAMP '2001-08-01 08:00:00') - max(epoch_us(updated_at))) / 3600000000.0::DOUBLE AS age FROM silver)""")(
    lambda s, d: qa.source_freshness(silver(s, d), F.lit("2001-08-01 08:00:00").cast("timestamp")).withColumn("age_hours", F.round("age_hours", 6)))


@query("silver_freshness", "SELECT 'silver_freshness' AS check_name, 'pass' AS status")
def _silver_freshness(spark, d):
    """Age of a table just written."""
    path = scratch(spark, "silver")
    silver(spark, d).write.parquet(path)
    return qa.silver_freshness(spark, path, F.current_timestamp()).select("check_name", "status")


query("gold_row_counts", f"""SELECT count(*) AS fact_rows, CAST(count_if(order_date >= TIMESTAMP '{t.AS_OF}' - INTERVAL 1 DAY) AS BIGINT) AS recent_rows, (SELECT count(*) FROM daily) AS daily_rows, 'pass' AS status FROM fact""")(
    lambda s, d: qa.gold_row_counts(marts.lean_fact(s, d), marts.daily(s, d), t.AS_OF))
query("volume_anomaly", f"""SELECT today_count, round(a, 1) AS rolling_avg, round((today_count - a) / a * 100, 1) AS pct_change, CASE WHEN (today_count - a) / a * 100 < -30 THEN 'fail' ELSE 'pass' END AS status FROM
    (SELECT avg(n) FILTER (day < DATE '{t.AS_OF}') AS a, coalesce(max(n) FILTER (day = DATE '{t.AS_OF}'), 0) AS today_count FROM
        (SELECT CAST(order_date AS DATE) AS day, count(*) AS n FROM fact WHERE order_date >= TIMESTAMP '{t.AS_OF}' - INTERVAL 8 DAY GROUP BY 1))""")(
    lambda s, d: qa.volume_anomaly(marts.lean_fact(s, d), t.AS_OF))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
query("pii_scan", "SELECT 'events' AS table_name, 'user_id' AS column_name, count(user_id) AS filled, count(*) AS row_count FROM events")(
    lambda s, d: qa.pii_scan({n: t.table(s, d, n) for n in TABLES}))
query("agg_reconciles", """SELECT CAST((SELECT sum(gross_revenue_cents) FROM daily) AS BIGINT) AS daily_gross, CAST((SELECT count_if(unique_buyers > order_count) FROM daily) AS BIGINT) AS days_with_more_buyers_than_orders,
    CAST(sum(total_cents) AS BIGINT) AS fact_gross, true AS reconciled FROM fact""")(lambda s, d: qa.agg_reconciles(marts.lean_fact(s, d), marts.daily(s, d)))


# --- governance

def requests(spark, d):
    """Every 30th customer asks to be erased."""
    c = t.table(spark, d, "customer").filter("c_custkey % 30 = 7")
    return gv.erasure_requests(c.select(F.concat(F.lit("req-"), F.col("c_custkey").cast("string")).alias("request_id"), F.col("c_custkey").cast("string").alias("user_id")), t.SALT)


WANTED = f"(SELECT 'req-' || c_custkey AS request_id, sha256('{t.SALT}|' || c_custkey) AS user_id_hash FROM customer WHERE c_custkey % 30 = 7)"
query("erase_match", f"SELECT order_id, CASE WHEN user_id_hash IN (SELECT user_id_hash FROM {WANTED}) THEN 'ERASED' ELSE user_id_hash END AS user_id_hash FROM silver")(
    lambda s, d: gv.erase_users(silver(s, d), requests(s, d)).select("order_id", "user_id_hash"))


def by_month(spark, d):
    return silver(spark, d).withColumn("run_date", F.trunc("created_at", "MM"))


@query("erase_users", f"""SELECT order_id, CASE WHEN user_id_hash IN (SELECT user_id_hash FROM {WANTED}) THEN 'ERASED' ELSE user_id_hash END AS user_id_hash, total_cents,
    CAST(date_trunc('month', created_at) AS DATE) AS run_date FROM silver""")
def _erase(spark, d):
    """Erasure in a stored, partitioned table, run twice."""
    path = scratch(spark, "silver")
    sinks.write_silver_orders(by_month(spark, d), path)
    gv.erase_table(spark, path, requests(spark, d), "run_date")
    gv.erase_table(spark, path, requests(spark, d), "run_date")
    return spark.read.parquet(path).select("order_id", "user_id_hash", "total_cents", "run_date")


@query("erasure_audit", f"""SELECT 'gdpr_erasure' AS event, request_id, r.user_id_hash[1:8] || '...' AS user_id_hash_prefix, count(DISTINCT date_trunc('month', created_at)) AS affected_files,
    count(order_id) AS affected_rows, CAST(count_if(total_cents > 0) AS BIGINT) AS deleted_rows FROM {WANTED} r LEFT JOIN silver s ON r.user_id_hash = s.user_id_hash GROUP BY 1, 2, 3""")
def _audit(spark, d):
    """Audit records appended as JSON lines and read back."""
    path = scratch(spark, "audit")
    wanted = requests(spark, d)
    s = gv.erasure_counts(by_month(spark, d), wanted, "run_date")
    g = gv.erasure_counts(marts.lean_fact(spark, d), wanted, "order_year")
    audit = gv.erasure_audit(wanted, s, g, "run_date", F.lit("2001-08-01 00:00:00").cast("timestamp"), "run-1")
    gv.write_audit(audit, path, "run-1")
    return spark.read.schema(audit.schema).json(path).select("event", "request_id", "user_id_hash_prefix", "silver.affected_files", "silver.affected_rows", "gold.deleted_rows")


query("expire_partitions", f"SELECT order_id, CAST(date_trunc('month', created_at) AS DATE) AS run_date FROM silver WHERE date_trunc('month', created_at) >= DATE '{t.AS_OF}' - 365")(
    lambda s, d: gv.expire_partitions(by_month(s, d), t.AS_OF, 365).select("order_id", "run_date"))
query("rotate_salt", f"""SELECT order_id, CASE WHEN k % 23 <> 0 THEN sha256('next-salt|' || o_custkey) END AS user_id_hash FROM (SELECT l.order_id, l.k, s.o_custkey FROM latest l JOIN silver s ON l.order_id = s.order_id)""")(
    lambda s, d: gv.rotate_salt(ingest.order_lines(s, d), "next-salt").select("order_id", "user_id_hash"))


def backfilled(spark, d, path):
    return gv.backfill(spark, ingest.line_folder(spark, d), path, date(1995, 1, 1), date(2001, 12, 31), t.SALT, pattern="*")


@query("backfill", f"SELECT run_date, {ingest.METRICS} FROM checked GROUP BY 1")
def _backfill(spark, d):
    """All run dates rebuilt as one job; metrics per date."""
    return backfilled(spark, d, scratch(spark, "silver"))


@query("backfill_totals", """SELECT CAST(2557 AS BIGINT) AS dates_attempted, 2557 - count(DISTINCT run_date) AS dates_failed, CAST(sum(processed) AS BIGINT) AS total_processed, CAST(sum(valid) AS BIGINT) AS total_valid
    FROM (SELECT run_date, """ + ingest.METRICS + """ FROM checked GROUP BY 1)""")
def _backfill_totals(spark, d):
    metrics = backfilled(spark, d, scratch(spark, "silver"))
    return gv.backfill_totals(metrics, date(1995, 1, 1), date(2001, 12, 31))


# --- stored tables changed by partition

def month(column):
    return f"CAST(date_trunc('month', {column}) AS DATE)"


HOLDERS = f"""SELECT 'orders' AS name, user_id_hash, {month('created_at')} AS part FROM silver UNION ALL SELECT 'fact', user_id_hash, {month('order_date')} FROM fact
    UNION ALL SELECT 'sessions', user_id_hash, CAST(session_start AS DATE) FROM sessions UNION ALL SELECT 'features', user_id_hash, {month('event_timestamp')} FROM features"""


def holders(spark, d):
    """Four stored tables that carry the hash."""
    rows = {
        "orders": by_month(spark, d), "fact": marts.lean_fact(spark, d).withColumn("run_date", F.trunc("order_date", "MM")),
        "sessions": ck.sessionize(t.clicks(spark, d)).withColumn("run_date", F.to_date("session_start")),
        "features": ft.user_features(marts.lean_fact(spark, d), t.AS_OF).withColumn("run_date", F.trunc("event_timestamp", "MM"))}
    out = {}
    for name, frame in rows.items():
        out[name] = merge.Holder("silver" if name in ("orders", "sessions") else "gold", scratch(spark, name), "run_date")
        sinks.write_partitioned(frame, out[name].path, ["run_date"])
    return out


@query("erase_everywhere", f"""SELECT name, CASE WHEN user_id_hash IN (SELECT user_id_hash FROM {WANTED}) THEN 'ERASED' ELSE user_id_hash END AS user_id_hash, count(*) AS n FROM ({HOLDERS}) GROUP BY 1, 2""")
def _erase_all(spark, d):
    """Erasure in all tables that carry the hash, read back."""
    stored = holders(spark, d)
    merge.erase_everywhere(spark, stored, requests(spark, d))
    parts = [spark.read.parquet(h.path).select(F.lit(n).alias("name"), "user_id_hash") for n, h in stored.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).groupBy("name", "user_id_hash").agg(F.count(F.lit(1)).alias("n"))


@query("erasure_records", f"""SELECT request_id, r.user_id_hash[1:8] || '...' AS user_id_hash_prefix,
    count(DISTINCT CASE WHEN name = 'orders' THEN part END) + count(DISTINCT CASE WHEN name = 'sessions' THEN part END) AS silver_files, CAST(count_if(name IN ('orders', 'sessions')) AS BIGINT) AS silver_rows,
    count(DISTINCT CASE WHEN name = 'fact' THEN part END) + count(DISTINCT CASE WHEN name = 'features' THEN part END) AS gold_files, CAST(count_if(name IN ('fact', 'features')) AS BIGINT) AS gold_rows
    FROM {WANTED} r LEFT JOIN ({HOLDERS}) h ON r.user_id_hash = h.user_id_hash GROUP BY 1, 2""")
def _erasure_records(spark, d):
    """Audit records counted in what the erasure rewrote."""
    wanted = requests(spark, d)
    ledger = merge.erase_everywhere(spark, holders(spark, d), wanted)
    records = merge.erasure_records(wanted, ledger, F.lit("2001-08-01 00:00:00").cast("timestamp"), "run-1")
    return records.select("request_id", "user_id_hash_prefix", F.col("silver.affected_files").alias("silver_files"), F.col("silver.affected_rows").alias("silver_rows"),
                          F.col("gold.affected_files").alias("gold_files"), F.col("gold.affected_rows").alias("gold_rows"))


SYNC = "k % 97 = 0 AND created_at >= TIMESTAMP '1997-01-01' AND created_at < TIMESTAMP '1997-07-01'"


def synced(spark, d):
    """A keyed table of all orders and a sync of a hundredth of half a year: every second of these deleted, the others shipped."""
    rows = by_month(spark, d).select("order_id", "status", "total_cents", "cdc_ts_ms", "run_date")
    stored = merge.KeyedTable(scratch(spark, "keyed"), ["order_id"], "run_date")
    stored.write(rows)
    k = F.col("order_id").cast("bigint")
    some = rows.where((k % 97 == 0) & (F.col("run_date") >= "1997-01-01") & (F.col("run_date") < "1997-07-01"))
    changes = some.withColumns({"status": F.lit("shipped"), "cdc_ts_ms": F.col("cdc_ts_ms") + 1, "op": F.when(k % 2 == 0, "d").otherwise("u")})
    return stored, stored.merge(changes, ["cdc_ts_ms"], F.col("op") == "d")


@query("merge_by_partition", f"""SELECT order_id, CASE WHEN {SYNC} THEN 'shipped' ELSE status END AS status, total_cents, {month('created_at')} AS run_date FROM silver WHERE NOT ({SYNC} AND k % 2 = 0)""")
def _merge_rows(spark, d):
    return synced(spark, d)[0].read(spark).select("order_id", "status", "total_cents", "run_date")


@query("merge_opened_partitions", f"""SELECT count(DISTINCT {month('created_at')}) AS partitions, count(DISTINCT CASE WHEN {SYNC} THEN {month('created_at')} END) AS opened FROM silver""")
def _merge_opened(spark, d):
    """How many of the table's partitions the sync opened."""
    told = synced(spark, d)[1]
    return spark.range(1).select(*[F.lit(told[c]).cast("bigint").alias(c) for c in ("partitions", "opened")])


@query("expire_stored", f"SELECT order_id, {month('created_at')} AS run_date FROM silver WHERE date_trunc('month', created_at) >= DATE '{t.AS_OF}' - 365")
def _expire_stored(spark, d):
    """Partitions past their retention are deleted."""
    path = scratch(spark, "silver")
    sinks.write_silver_orders(by_month(spark, d).select("order_id", "run_date"), path)
    merge.expire_stored(spark, path, "run_date", "2000-08-01")
    return spark.read.parquet(path)


@query("write_clustered_fact", "SELECT order_id, CAST(order_date AS TIMESTAMP) AS order_date, total_cents FROM fact WHERE order_date >= TIMESTAMP '1997-01-01' AND order_date < TIMESTAMP '1997-02-01' OR user_id_hash < '1'")
def _clustered(spark, d):
    """Facts in Z-order, read back by a month and by a range of users."""
    path = scratch(spark, "clustered")
    sinks.write_clustered_fact(marts.lean_fact(spark, d), path, 8, 1 << 20)
    rows = spark.read.parquet(path).where((F.col("order_date") >= "1997-01-01") & (F.col("order_date") < "1997-02-01") | (F.col("user_id_hash") < "1"))
    return rows.select("order_id", "order_date", "total_cents")


def event_folder(spark, d, root):
    t.click_lines(spark, d).hint("rebalance", "run_date").write.partitionBy("run_date").text(f"{root}/events")


# Readable clicks of the range, as the lines carry them.
RANGE = "FROM clicks WHERE k % 13 <> 0 AND CAST(occurred_at AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'"


@query("backfill_sessions", f"""WITH c AS (SELECT * {RANGE}),
    gaps AS (SELECT *, CASE WHEN epoch_us(occurred_at) - epoch_us(lag(occurred_at) OVER s) > 1800000000 THEN 1 ELSE 0 END AS cut FROM c WINDOW s AS (PARTITION BY session_id ORDER BY occurred_at, event_id)),
    seq AS (SELECT *, 1 + sum(cut) OVER (PARTITION BY session_id ORDER BY occurred_at, event_id ROWS UNBOUNDED PRECEDING) AS q FROM gaps)
    SELECT session_id, CAST(q AS BIGINT) AS session_seq, min(occurred_at) AS session_start, max(occurred_at) AS session_end, count(*) AS event_count, bool_or(event_type = 'purchase' AND k % 17 <> 0) AS converted,
    arg_min(page_url, (occurred_at, event_id)) AS entry_page, arg_max(page_url, (occurred_at, event_id)) AS exit_page FROM seq GROUP BY session_id, q""")
def _backfill_sessions(spark, d):
    """Session parts of January backfilled in three ranges, the middle one twice, and stitched over their borders."""
    root, silver_path, parts = scratch(spark, "bronze"), scratch(spark, "silver"), scratch(spark, "parts")
    event_folder(spark, d, root)
    for first, last in ((1, 10), (11, 20), (11, 20), (21, 31)):
        gv.backfill_ledger(spark, root, silver_path, parts, date(2024, 1, first), date(2024, 1, last), t.SALT, pattern="*")
    whole = ck.stitch_sessions(spark.read.parquet(parts))
    return whole.select("session_id", "session_seq", "session_start", "session_end", "event_count", "converted", "entry_page", "exit_page")


@query("backfill_summary", """WITH m AS (SELECT run_date, """ + ingest.METRICS + """ FROM checked WHERE run_date BETWEEN DATE '1995-01-01' AND DATE '1995-12-31' GROUP BY 1),
    days AS (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '1995-12-31', INTERVAL 1 DAY)) AS DATE) AS run_date)
    SELECT count(*) AS dates_attempted, CAST(count_if(processed IS NULL) AS BIGINT) AS dates_failed, string_agg(CASE WHEN processed IS NULL THEN strftime(days.run_date, '%Y-%m-%d') END, ',' ORDER BY days.run_date) AS failed_dates,
    CAST(sum(processed) AS BIGINT) AS total_processed, CAST(sum(valid) AS BIGINT) AS total_valid, CAST(0 AS BIGINT) AS total_events, CAST(0 AS BIGINT) AS total_sessions FROM days LEFT JOIN m USING (run_date)""")
def _backfill_summary(spark, d):
    """A year of daily dates over monthly folders: the days without a folder have failed and are named."""
    root, parts = ingest.line_folder(spark, d), scratch(spark, "parts")
    ledger = gv.backfill_ledger(spark, root, scratch(spark, "silver"), parts, date(1995, 1, 1), date(1995, 12, 31), t.SALT, pattern="*")
    sessions = ck.sessionize(t.clicks(spark, d))
    return gv.backfill_summary(ledger, sessions).withColumn("failed_dates", F.array_join("failed_dates", ","))


# --- models

def training(spark, d):
    """Training table at the fixed date."""
    return ft.churn_training_features(marts.lean_fact(spark, d), t.AS_OF)


@query("train_churn")
def _train(spark, d):
    """Cross-validated metrics and importances: 200 trees, five folds."""
    return ml.train_churn(training(spark, d))[1]


@query("score_churn")
def _score(spark, d):
    """Scores of a model that was saved and loaded again."""
    rows, path = training(spark, d), scratch(spark, "churn-model")
    ml.fit_churn(rows, path, exclude_leaky=True)
    return ml.score_churn(ml.load_churn(path), rows)


@query("training_folds", """SELECT label, CAST(r % 5 AS INT) AS fold, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY label) AS r FROM
    (SELECT CASE WHEN days_since_last_order > 60 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label FROM features)) GROUP BY 1, 2""")
def _folds(spark, d):
    """Sizes of the stratified folds."""
    return ml.training_rows(training(spark, d), 5).groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n"))


@query("forecast_demand")
def _forecast(spark, d):
    """Per warehouse."""
    return ml.forecast_demand(ft.daily_demand(marts.fact(spark, d), ["warehouse_id"]), ["warehouse_id"])


@query("forecast_product_demand")
def _forecast_products(spark, d):
    """Per product."""
    return ml.forecast_demand(ft.product_daily_demand(marts.lean_fact(spark, d), t.order_items(spark, d)), ["product_id"])


@query("write_forecast")
def _write_forecast(spark, d):
    """One aggregate series, written and read back."""
    path = scratch(spark, "forecast")
    daily = ft.daily_demand(marts.lean_fact(spark, d)).withColumn("series", F.lit("all"))
    sinks.write_forecast(ml.forecast_demand(daily, ["series"]), path)
    return spark.read.parquet(path)
