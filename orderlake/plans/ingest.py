"""Registered queries: raw events, change handling, clean tables, sinks, sessions, history."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from orderlake.operators import clicks as ck
from orderlake.operators import history as hs
from orderlake.operators import orders as od
from orderlake.plans import marts
from orderlake.plans import tables as t
from orderlake.plans.registry import query
from orderlake.schemas import CAMPAIGN_PERFORMANCE
from orderlake.session import scratch
from orderlake.sources import bronze, sinks
from orderlake.streaming import live as sl

FIRST, LAST = date(1995, 1, 1), date(1995, 12, 31)
LINES = "lz4"  # JSON lines repeat their keys: stored plainly they are most of what a query writes
YEAR = "run_date BETWEEN DATE '1995-01-01' AND DATE '1995-12-31'"
SILVER = ", ".join(od.SILVER_COLUMNS).replace("cdc_op", "op AS cdc_op").replace("cdc_ts_ms", "ts_ms AS cdc_ts_ms")


def line_folder(spark, d):
    """Order change lines written as one folder per run date, the way they arrive."""
    root = scratch(spark, "bronze")
    t.order_lines(spark, d).hint("rebalance", "run_date").write.partitionBy("run_date").option("compression", LINES).text(f"{root}/orders")
    return root


def order_lines(spark, d):
    return od.parse_json_lines(t.order_lines(spark, d))


def changes(spark, d):
    """Typed change envelopes read back from JSON lines with an explicit schema."""
    path = scratch(spark, "changes")
    t.order_lines(spark, d).select("value").write.option("compression", LINES).text(path)
    return bronze.read_bronze_json(spark, path).filter("op is not null and (after.order_id is not null or before.order_id is not null)")


def checked(spark, d):
    return od.validate_orders(od.parse_cdc_orders(order_lines(spark, d).filter("v is not null"), t.SALT))


@query("read_bronze_orders", f"SELECT order_id, op AS cdc_op, ts_ms AS cdc_ts_ms, status, run_date FROM checked WHERE {YEAR}")
def _read_orders(spark, d):
    """A year of dated folders, read by date range."""
    lines = bronze.read_bronze_orders(spark, line_folder(spark, d), FIRST, LAST, "*")
    return od.parse_cdc_orders(lines.filter("v is not null"), t.SALT).select("order_id", "cdc_op", "cdc_ts_ms", "status", "run_date")


@query("read_bronze_json", "SELECT order_id, op, ts_ms, 'shop' AS db FROM changes")
def _read_json(spark, d):
    return changes(spark, d).select(F.coalesce("after.order_id", "before.order_id").alias("order_id"), "op", "ts_ms", F.col("source.db").alias("db"))


@query("read_bronze_events", "SELECT event_id, session_id FROM clicks WHERE k % 13 <> 0")
def _read_events(spark, d):
    root = scratch(spark, "bronze")
    t.click_lines(spark, d).hint("rebalance", "run_date").write.partitionBy("run_date").text(f"{root}/events")
    lines = bronze.read_bronze_events(spark, root, date(2024, 1, 1), date(2024, 1, 31), "*")
    return ck.parse_click_events(lines, t.SALT).select("event_id", "session_id")


@query("cdc_stream", "SELECT order_id, op AS cdc_op, ts_ms AS cdc_ts_ms FROM checked")
def _cdc_stream(spark, d):
    """Live change lines from a folder source, parsed as they arrive."""
    src, out = scratch(spark, "topic"), scratch(spark, "parsed")
    t.order_lines(spark, d).select("value").write.option("compression", LINES).text(src)
    lines = od.parse_json_lines(bronze.change_stream(spark, "text", src)).filter("v is not null")
    sl.run_available(od.parse_cdc_orders(lines, t.SALT).select("order_id", "cdc_op", "cdc_ts_ms"), out, scratch(spark, "ckpt"))
    return spark.read.parquet(out)


query("cdc_unwrap", """SELECT order_id, op AS __op, ts_ms AS __ts_ms, 'shop' AS __source_db, 'orders' AS __source_table,
    CASE WHEN op = 'd' THEN 'true' ELSE 'false' END AS __deleted, '1.0' AS pipeline_version, total_cents FROM changes""")(
    lambda s, d: bronze.cdc_unwrap(changes(s, d)).select("order_id", "__op", "__ts_ms", "__source_db", "__source_table", "__deleted", "pipeline_version", "total_cents"))


@query("dead_letter_split", """SELECT kind, errors, count(*) AS n FROM (
    SELECT 'valid' AS kind, '' AS errors FROM checked WHERE ok
    UNION ALL SELECT 'rejected', concat_ws(',', CASE WHEN user_id_hash IS NULL THEN 'user_id_hash is null' END, CASE WHEN status = 'lost' THEN 'invalid status: lost' END)
        FROM checked WHERE NOT ok
    UNION ALL SELECT 'rejected', 'not a JSON object' FROM silver WHERE k % 13 = 0) GROUP BY 1, 2""")
def _dead_letters(spark, d):
    valid, rejected = od.dead_letter_split(t.order_lines(spark, d), t.SALT)
    rows = valid.select(F.lit("valid").alias("kind"), F.lit("").alias("errors")).unionByName(
        rejected.select(F.lit("rejected").alias("kind"), F.array_join("errors", ",").alias("errors")))
    return rows.groupBy("kind", "errors").agg(F.count(F.lit(1)).alias("n"))


@query("topic_fanout", """SELECT "table", count(*) AS n FROM (SELECT 'orders' AS "table" FROM orders UNION ALL SELECT 'order_items' FROM lineitem UNION ALL SELECT 'users' FROM customer) GROUP BY 1""")
def _fanout(spark, d):
    """Messages of several topics written to one folder per table; unlisted topics are left out."""
    def topic(name, frame, key):
        return frame.select(F.lit(f"shop.{name}").alias("topic"), F.to_json(F.struct(key)).alias("value"))
    messages = (topic("orders", t.table(spark, d, "orders"), "o_orderkey").unionByName(topic("order_items", t.table(spark, d, "lineitem"), "l_orderkey"))
                .unionByName(topic("users", t.table(spark, d, "customer"), "c_custkey")).unionByName(topic("audit", t.table(spark, d, "supplier"), "s_suppkey")))
    path = scratch(spark, "fanout")
    sinks.write_partitioned(bronze.topic_fanout(messages), path, ["table"])
    return spark.read.parquet(path).groupBy("table").agg(F.count(F.lit(1)).alias("n"))


@query("write_bronze_partitioned", """SELECT CAST(date_part('year', ts) AS INT) AS year, CAST(date_part('month', ts) AS INT) AS month, CAST(date_part('day', ts) AS INT) AS day,
    CAST(date_part('hour', ts) AS INT) AS hour, count(*) AS n FROM events GROUP BY 1, 2, 3, 4""")
def _write_bronze(spark, d):
    """Events laid out by the hour of their own time, by two runs, one of them written twice."""
    path = scratch(spark, "hourly")
    rows = t.live_orders(spark, d).select("event_id", "order_id", F.unix_millis("occurred_at").alias("ts_ms"))
    late = F.col("event_id").cast("bigint") % 2 == 1
    for run, part in (("a", ~late), ("b", late), ("b", late)):
        sinks.write_bronze_partitioned(rows.filter(part), path, run)
    return spark.read.parquet(path).groupBy(*[F.col(c).cast("int").alias(c) for c in sinks.HOUR]).agg(F.count(F.lit(1)).alias("n"))


@query("write_silver_orders", f"SELECT {SILVER}, run_date FROM latest")
def _write_silver(spark, d):
    """Clean orders per run date, written twice to show that a rerun replaces its own dates only."""
    path = scratch(spark, "silver")
    rows = od.silver_orders(order_lines(spark, d), t.SALT)
    sinks.write_silver_orders(rows, path)
    sinks.write_silver_orders(rows.filter(F.col("run_date") >= "2000-01-01"), path)
    return spark.read.parquet(path)


query("silver_orders", f"SELECT {SILVER}, run_date FROM latest")(lambda s, d: od.silver_orders(order_lines(s, d), t.SALT))


@query("write_silver_by_status", f"""SELECT order_id, user_id_hash, status, total_cents, ts_ms AS cdc_ts_ms FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ts_ms DESC) AS rn
    FROM (SELECT * REPLACE (coalesce(user_id_hash, 'none') AS user_id_hash) FROM changes WHERE op IN ('c', 'u') AND total_cents > 0 AND status <> 'lost')) WHERE rn = 1""")
def _write_by_status(spark, d):
    path = scratch(spark, "by-status")
    sinks.write_silver_by_status(od.clean_changes(changes(spark, d), t.SALT), path)
    return bronze.read_silver(spark, path).select("order_id", F.coalesce("user_id_hash", F.lit("none")).alias("user_id_hash"), "status", "total_cents", "cdc_ts_ms")


@query("read_silver", "SELECT order_id, status, total_cents FROM silver")
def _read_silver(spark, d):
    path = scratch(spark, "silver")
    t.silver_orders(spark, d, dims=False).write.parquet(path)
    return bronze.read_silver(spark, path).select("order_id", "status", "total_cents")


@query("read_silver_mixed", "SELECT order_id, status, total_cents FROM silver")
def _read_mixed(spark, d):
    """Half of the rows as Parquet, half as CSV."""
    rows = t.silver_orders(spark, d, dims=False).select("order_id", "status", "total_cents")
    pq, csv = scratch(spark, "mixed-parquet"), scratch(spark, "mixed-csv")
    odd = F.col("order_id").cast("bigint") % 2 == 1
    rows.filter(odd).write.parquet(pq)
    rows.filter(~odd).write.option("header", "true").csv(csv)
    return bronze.read_silver_mixed(spark, pq, csv, rows.schema)


@query("write_silver_sessions", "SELECT session_id, session_seq, event_count, CAST(session_start AS DATE) AS run_date FROM sessions")
def _write_sessions(spark, d):
    path = scratch(spark, "sessions")
    sinks.write_silver_sessions(ck.sessionize(t.clicks(spark, d)).withColumn("run_date", F.to_date("session_start")), path)
    return spark.read.parquet(path).select("session_id", "session_seq", "event_count", "run_date")


@query("incremental_append_dedup", """SELECT campaign_id, date, impressions + CASE WHEN date >= DATE '2000-01-01' THEN 1 ELSE 0 END AS impressions, clicks FROM campaigns""")
def _incremental(spark, d):
    """Target up to a cursor date, then a batch that restates everything from there on with one more impression."""
    ads = t.campaigns(spark, d)
    target = ads.filter(F.col("date") <= "2000-01-01")
    batch = ads.withColumn("impressions", F.col("impressions") + 1)
    return hs.incremental_append_dedup(target, batch, ["campaign_id", "date"], "date").select("campaign_id", "date", "impressions", "clicks")


query("campaign_performance", f"SELECT * FROM campaigns WHERE date >= DATE '{t.AS_OF}' - 30")(
    lambda s, d: hs.campaign_performance(t.campaigns(s, d), F.lit(t.AS_OF)).select(*CAMPAIGN_PERFORMANCE.fieldNames()))


@query("materialize", "SELECT order_date, order_count FROM daily")
def _materialize(spark, d):
    """Staging as a view, enrichment inlined, daily revenue as a rebuilt table."""
    sinks.materialize(marts.stg(spark, d, dims=False), "stg_orders_view", "view")
    fact = sinks.materialize(marts.gold.fact_orders(spark.table("stg_orders_view")), "fact", "ephemeral")
    return sinks.materialize(marts.gold.daily_revenue(fact), "daily", "table").select("order_date", "order_count")


@query("upsert_last_wins", "SELECT order_id, CASE WHEN k % 4 = 0 THEN 'refunded' ELSE status END AS status, total_cents FROM silver WHERE k % 2 = 0 OR k % 3 = 0")
def _upsert(spark, d):
    rows = t.silver_orders(spark, d, dims=False).select("order_id", "status", "total_cents")
    k = F.col("order_id").cast("bigint")
    incoming = rows.filter((k % 4 == 0) | (k % 3 == 0)).withColumn("status", F.when(k % 4 == 0, "refunded").otherwise(F.col("status")))
    return sinks.upsert_last_wins(rows.filter(k % 2 == 0), incoming, ["order_id"])


@query("insert_first_wins", "SELECT order_id, event_id FROM live WHERE k % 2 = 1")
def _insert_first(spark, d):
    """Every event arrives twice (the second time later); even ones are already in the target."""
    rows = t.live_orders(spark, d)
    again = rows.withColumns({"event_id": F.concat("event_id", F.lit("-again")), "occurred_at": F.timestamp_micros(F.unix_micros("occurred_at") + 1)})
    target = rows.filter(F.col("event_id").cast("bigint") % 2 == 0)
    return sinks.insert_first_wins(target, rows.unionByName(again), "order_id", "occurred_at", "event_id").select("order_id", "event_id")


@query("append_jsonl", "SELECT order_id, total_cents FROM silver")
def _append_jsonl(spark, d):
    path = scratch(spark, "log")
    rows = t.silver_orders(spark, d, dims=False).select("order_id", "total_cents")
    odd = F.col("order_id").cast("bigint") % 2 == 1
    for run, part in (("a", odd), ("b", ~odd), ("b", ~odd)):
        sinks.append_jsonl(rows.filter(part), path, run)
    return spark.read.schema(rows.schema).json(path).select("order_id", "total_cents")


query("write_keyed_json", """SELECT order_id AS key, '{"order_id":"' || order_id || '","status":"' || status || '","total_cents":' || total_cents || '}' AS value FROM silver""")(
    lambda s, d: sinks.keyed_json(t.silver_orders(s, d, dims=False).select("order_id", "status", "total_cents"), "order_id"))
query("replay_events", """SELECT 'replay-' || order_id AS event_id, order_id, 'c' AS op, user_id_hash, 'REPLAY' AS sku, warehouse_id, order_status AS status, currency, channel,
    1 AS qty, total_cents AS unit_price_cents, discount_cents, shipping_cents, total_cents, created_at AS occurred_at FROM fact
    WHERE order_date BETWEEN TIMESTAMP '1999-01-01' AND TIMESTAMP '1999-12-31'""")(
    lambda s, d: sinks.replay_events(marts.fact(s, d), date(1999, 1, 1), date(1999, 12, 31)))


def snapshot_and_changes(spark, d):
    rows = changes(spark, d)
    flat = rows.select(F.coalesce("after.order_id", "before.order_id").alias("order_id"), "op", "ts_ms",
                       F.coalesce("after.status", "before.status").alias("status"))
    snapshot = flat.filter("op = 'c'").withColumn("op", F.lit("r"))
    return snapshot, flat.filter("op <> 'c'")


@query("cdc_merge_latest", """SELECT order_id, CASE WHEN k % 19 = 0 THEN 'lost' WHEN k % 3 = 0 THEN 'shipped' ELSE status END AS status,
    CASE WHEN k % 3 = 0 THEN 'u' ELSE 'r' END AS op FROM silver WHERE k % 11 <> 0""")
def _merge(spark, d):
    """Initial snapshot plus changes; orders whose newest change is a delete are gone."""
    snapshot, later = snapshot_and_changes(spark, d)
    return hs.cdc_merge_latest(snapshot, later, "order_id").select("order_id", "status", "op")


# --- change parsing
query("parse_cdc_orders", f"SELECT {SILVER} FROM checked")(lambda s, d: od.parse_cdc_orders(order_lines(s, d).filter("v is not null"), t.SALT).select(*od.SILVER_COLUMNS))
query("flatten_after", "SELECT order_id, op AS cdc_op, ts_ms AS cdc_ts_ms, user_id_hash, status, currency FROM (SELECT * REPLACE (CASE WHEN k % 17 = 0 THEN NULL ELSE currency END AS currency) FROM changes) WHERE op IN ('c', 'u')")(
    lambda s, d: od.flatten_after(changes(s, d), t.SALT).select("order_id", "cdc_op", "cdc_ts_ms", "user_id_hash", "status", "currency"))
query("drop_pii", "SELECT event_id, session_id, page_url FROM clicks")(lambda s, d: od.drop_pii(t.clicks(s, d)).select("*").drop("user_id_hash", "event_type", "occurred_at"))
query("strip_internal", "SELECT order_id, total_cents FROM silver")(
    lambda s, d: od.strip_internal(t.silver_orders(s, d, dims=False).select("order_id", "total_cents", F.col("status").alias("_status"))))
query("validate_orders", """SELECT order_id, op AS cdc_op, concat_ws(',', CASE WHEN user_id_hash IS NULL THEN 'user_id_hash is null' END, CASE WHEN status = 'lost' THEN 'invalid status: lost' END) AS errors
    FROM checked""")(lambda s, d: checked(s, d).select("order_id", "cdc_op", F.array_join("errors", ",").alias("errors")))
query("dedup_latest", f"SELECT {SILVER} FROM latest")(
    lambda s, d: od.dedup_latest(checked(s, d).filter("size(errors) = 0").select(*od.SILVER_COLUMNS)))
query("dedup_any", "SELECT DISTINCT order_id, user_id_hash FROM checked WHERE ok")(
    lambda s, d: od.dedup_any(checked(s, d).filter("size(errors) = 0")).select("order_id", "user_id_hash"))
METRICS = "count(*) AS processed, CAST(count_if(NOT ok) AS BIGINT) AS invalid, count(DISTINCT CASE WHEN ok THEN order_id END) AS valid, CAST(count_if(ok) AS BIGINT) - count(DISTINCT CASE WHEN ok THEN order_id END) AS deduplicated"
query("transform_metrics", f"SELECT {METRICS} FROM checked")(lambda s, d: od.transform_metrics(checked(s, d)))

# --- sessions
query("parse_click_events", "SELECT event_id, session_id, user_id_hash, CASE WHEN k % 17 = 0 THEN 'page_view' ELSE event_type END AS event_type, page_url, strftime(occurred_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS occurred_at FROM clicks WHERE k % 13 <> 0")(
    lambda s, d: ck.parse_click_events(od.parse_json_lines(t.click_lines(s, d)).filter("v is not null"), t.SALT).drop("product_id", "run_date"))
query("sessionize", "SELECT * FROM sessions")(lambda s, d: ck.sessionize(t.clicks(s, d)))
query("sessions", "SELECT session_id, session_seq, event_count, page_views, product_views, add_to_cart_count, search_count, converted FROM sessions")(
    lambda s, d: ck.sessionize(t.clicks(s, d)).select("session_id", "session_seq", "event_count", "page_views", "product_views", "add_to_cart_count", "search_count", "converted"))
query("entry_exit_page", "SELECT session_id, session_seq, user_id_hash, entry_page, exit_page FROM sessions")(lambda s, d: ck.entry_exit_page(t.clicks(s, d)))
query("session_metrics", "SELECT CAST(sum(event_count) AS BIGINT) AS events, count(*) AS sessions FROM sessions")(
    lambda s, d: ck.session_metrics(ck.sessionize(t.clicks(s, d))))

# --- history
query("scd2_users", "SELECT * FROM scd2")(lambda s, d: hs.scd2_users(t.user_versions(s, d)))


@query("scd2_apply", """WITH cut AS (SELECT * FROM versions WHERE updated_at < TIMESTAMP '1997-01-01'),
    alive AS (SELECT DISTINCT user_id_hash FROM versions WHERE c_custkey % 10 <> 0),
    line AS (SELECT * FROM versions WHERE updated_at < TIMESTAMP '1997-01-01' OR c_custkey % 10 <> 0),
    h AS (SELECT user_id_hash, acquisition_channel, updated_at AS valid_from, lead(updated_at) OVER (PARTITION BY user_id_hash ORDER BY updated_at) AS valid_to FROM line)
    SELECT user_id_hash, acquisition_channel, valid_from, CASE WHEN valid_to IS NULL AND user_id_hash NOT IN (SELECT user_id_hash FROM alive) THEN TIMESTAMP '2002-01-01' ELSE valid_to END AS valid_to FROM h""")
def _scd2_apply(spark, d):
    """History up to 1997, then a snapshot without every tenth user."""
    v = t.user_versions(spark, d)
    removed = t.customers(spark, d).filter("c_custkey % 10 = 0").select(t.hash_pii("c_custkey", t.SALT).alias("user_id_hash"))
    history = hs.scd2_users(v.filter(F.col("updated_at") < "1997-01-01"))
    out = hs.scd2_apply(history, v.join(removed, "user_id_hash", "left_anti"), F.lit("2002-01-01 00:00:00").cast("timestamp"))
    return out.select("user_id_hash", "acquisition_channel", "valid_from", "valid_to")


@query("scd2_point_in_time", """SELECT order_id, f.user_id_hash, country_code, acquisition_channel FROM fact f LEFT JOIN scd2 s
    ON f.user_id_hash = s.user_id_hash AND f.created_at >= valid_from AND (valid_to IS NULL OR f.created_at < valid_to)""")
def _point_in_time(spark, d):
    facts = marts.lean_fact(spark, d).select("order_id", "user_id_hash", "created_at")
    out = hs.scd2_point_in_time(facts, hs.scd2_users(t.user_versions(spark, d)), "created_at", ["country_code", "acquisition_channel"])
    return out.select("order_id", "user_id_hash", "country_code", "acquisition_channel")


@query("asof_features", """WITH e AS (SELECT k AS event_id, user_id_hash, occurred_at FROM live WHERE k % 2 = 0), f AS (SELECT k AS fid, user_id_hash, occurred_at AS event_timestamp, total_cents FROM live WHERE k % 2 = 1)
    SELECT event_id, CASE WHEN epoch_us(occurred_at) - epoch_us(event_timestamp) <= 172800000000 THEN event_timestamp END AS feature_timestamp,
    CASE WHEN epoch_us(occurred_at) - epoch_us(event_timestamp) <= 172800000000 THEN f.total_cents END AS total_cents
    FROM e ASOF LEFT JOIN f ON e.user_id_hash = f.user_id_hash AND e.occurred_at >= f.event_timestamp""")
def _asof(spark, d):
    """Even events look up the latest odd event of their user within two days."""
    rows = t.live_orders(spark, d).withColumn("k", F.col("event_id").cast("bigint"))
    entities = rows.filter("k % 2 = 0").select(F.col("k").alias("event_id"), "user_id_hash", "occurred_at")
    feats = rows.filter("k % 2 = 1").select("user_id_hash", F.col("occurred_at").alias("event_timestamp"), "total_cents")
    out = hs.asof_features(entities, feats, "user_id_hash", "occurred_at", "event_timestamp", ["total_cents"], ttl_seconds=2 * 86400)
    return out.select("event_id", "feature_timestamp", "total_cents")
