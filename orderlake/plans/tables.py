"""Canonical tables derived from the supplied Parquet tables, each as a Spark expression and as the same SQL."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.functions import CHANNELS, LIVE_STATUSES, ORDER_STATUSES, hash_pii

SALT = "catalog-salt"
AS_OF = date(2001, 8, 1)
ORDERS_PER_FILE = 250_000
LIVE_AS_OF = "2024-01-31 00:00:00"
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
HUBS = ["east-coast-hub", "west-coast-hub", "central-hub"]
CLICK_TYPES = {"view": "page_view", "click": "product_view", "signup": "add_to_cart", "error": "search", "purchase": "purchase"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table; its zone-less times are UTC."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*[F.col(c).cast("timestamp").alias(c) if t == "timestamp_ntz" else F.col(c) for c, t in df.dtypes])


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _plus_seconds(ts: Column, seconds: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + seconds * F.lit(1_000_000))


def _map(column: str, pairs: dict[str, str]) -> Column:
    expr = None
    for key, value in pairs.items():
        expr = F.when(F.col(column) == key, value) if expr is None else expr.when(F.col(column) == key, value)
    return expr


def customers(spark: SparkSession, d: str) -> DataFrame:
    """custkey, channel, country and home warehouse of every customer."""
    nation = table(spark, d, "nation")
    return table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        "c_custkey", _map("c_mktsegment", dict(zip(SEGMENTS, CHANNELS))).alias("channel"), F.col("n_name").alias("country_code"),
        F.concat(F.lit("wh-"), F.col("n_regionkey").cast("string")).alias("warehouse_id"))


def silver_orders(spark: SparkSession, d: str, dims: bool = True, user: Column | None = None) -> DataFrame:
    """Clean orders. ``dims=False`` skips the customer lookup for queries that need neither channel nor warehouse."""
    o = table(spark, d, "orders")
    key = F.col("o_orderkey")
    total = F.when(key % 101 == 0, 0).otherwise(F.round(F.col("o_totalprice") * 100.0)).cast("bigint")
    discount = F.when(key % 7 == 0, F.expr("total_cents div 10")).otherwise(F.lit(0)).cast("bigint")
    shipping = F.when(key % 5 == 0, 0).otherwise(499).cast("bigint")
    hashed = F.when(F.col("o_custkey") % 50 == 0, F.lit("ERASED")).otherwise(hash_pii("o_custkey", SALT))
    rows = o.withColumns({"total_cents": total, "created_at": _plus_seconds(F.col("o_orderdate"), key % 86400)})
    if dims:
        rows = rows.join(customers(spark, d), F.col("o_custkey") == F.col("c_custkey"), "left")
    else:
        rows = rows.withColumns({"warehouse_id": F.lit(None).cast("string"), "channel": F.lit(None).cast("string")})
    return rows.withColumns({"discount_cents": discount, "shipping_cents": shipping}).select(
        key.cast("string").alias("order_id"), hashed.alias("user_id_hash"), "warehouse_id", _pick(ORDER_STATUSES, key % 6).alias("status"),
        F.lit("USD").alias("currency"), (F.col("total_cents") + F.col("discount_cents") - F.col("shipping_cents")).alias("subtotal_cents"),
        "discount_cents", "shipping_cents", "total_cents", F.lit("c").alias("cdc_op"),
        F.unix_millis("created_at").alias("cdc_ts_ms"), "created_at",
        _plus_seconds(F.col("created_at"), (key % 5) * 3600).alias("updated_at"), "channel")


def users(spark: SparkSession, d: str) -> DataFrame:
    return customers(spark, d).select(
        F.col("c_custkey").cast("string").alias("user_id"), hash_pii("c_custkey", SALT).alias("user_id_hash"), "country_code",
        F.col("channel").alias("acquisition_channel"))


def user_versions(spark: SparkSession, d: str) -> DataFrame:
    """Two versions per user (three for every third): the channel moves on with time."""
    base = customers(spark, d).select("*", F.explode(F.sequence(F.lit(0), F.when(F.col("c_custkey") % 3 == 0, 2).otherwise(1))).alias("i"))
    start = F.lit("1995-01-01 00:00:00").cast("timestamp")
    segment = F.array_position(F.array(*[F.lit(c) for c in CHANNELS]), F.col("channel")) - 1
    return base.select(
        hash_pii("c_custkey", SALT).alias("user_id_hash"), "country_code",
        _pick(CHANNELS, (segment + F.col("i")) % 5).alias("acquisition_channel"), start.alias("created_at"),
        _plus_seconds(start, (F.col("i") * 700 + F.col("c_custkey") % 300) * 86400).alias("updated_at"))


def live_orders(spark: SparkSession, d: str) -> DataFrame:
    """Events as live order events; every 11th has a status, every 97th a total the live path rejects."""
    e = table(spark, d, "events")
    key = F.col("event_id")
    total = F.when(key % 97 == 0, 0).otherwise(F.round(F.col("value") * 100.0)).cast("bigint")
    return e.withColumn("total_cents", total).select(
        key.cast("string").alias("event_id"), F.md5(key.cast("string").cast("binary")).alias("order_id"), F.lit("c").alias("op"),
        hash_pii("user_id", SALT).alias("user_id_hash"), F.concat(F.lit("SKU-"), (key % 8).cast("string")).alias("sku"),
        _pick(HUBS, key % 3).alias("warehouse_id"),
        F.when(key % 11 == 0, "cancelled").otherwise(_pick(LIVE_STATUSES, key % 5)).alias("status"), F.lit("USD").alias("currency"),
        _pick(CHANNELS, F.expr("event_id div 5 % 5")).alias("channel"), (key % 3 + 1).cast("int").alias("qty"),
        F.col("total_cents").alias("unit_price_cents"),
        F.when(key % 7 == 0, F.expr("total_cents div 10")).otherwise(F.lit(0)).cast("bigint").alias("discount_cents"),
        F.lit(499).cast("bigint").alias("shipping_cents"), "total_cents", F.col("ts").alias("occurred_at"))


def clicks(spark: SparkSession, d: str) -> DataFrame:
    """Events as click events of ten shared sessions keys, so that sessions of many lengths occur."""
    e = table(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    return e.select(
        F.col("event_id").cast("string").alias("event_id"), (F.col("user_id") % 10).cast("string").alias("session_id"),
        hash_pii("user_id", SALT).alias("user_id_hash"), F.col("user_id").cast("string").alias("user_id"),
        _map("event_type", CLICK_TYPES).alias("event_type"), F.concat(F.lit("/products/"), (k % 50).cast("string")).alias("page_url"),
        F.col("ts").alias("occurred_at"))


def click_lines(spark: SparkSession, d: str) -> DataFrame:
    """Clicks as JSON lines by day: every 4th inside an envelope, every 13th unreadable, every 17th without type."""
    row = F.struct("event_id", "session_id", "user_id", F.when(F.col("event_id").cast("bigint") % 17 != 0, F.col("event_type")).alias("event_type"),
                   "page_url", F.date_format("occurred_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("occurred_at"))
    key = F.col("event_id").cast("bigint")
    text = F.when(key % 13 == 0, F.lit('{"event_id": ')).when(key % 4 == 0, F.to_json(F.struct(row.alias("after")))).otherwise(F.to_json(row))
    return clicks(spark, d).select(text.alias("value"), F.to_date("occurred_at").alias("run_date"))


def order_lines(spark: SparkSession, d: str, files: int | None = None) -> DataFrame:
    """Orders as change-event JSON lines by month of creation (their run date).

    Every order is created; every 3rd is updated, every 11th deleted, every 13th followed by an unreadable line. Every 17th has
    no currency, every 19th an unknown status, every 23rd no user. With ``files``, the lines of an order are dealt out over so many partitions.
    """
    o = silver_orders(spark, d, dims=True).withColumn("k", F.col("order_id").cast("bigint"))
    o = o.join(table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), "o_custkey"), "k")
    kinds = F.array_compact(F.array(F.lit("c"), *[F.when(F.col("k") % every == 0, kind) for kind, every in (("u", 3), ("d", 11), ("bad", 13))]))
    if files is None:
        # The supplied file is one split; real lines arrive as many files, and their number grows with the orders.
        o = o.repartition(max(spark.sparkContext.defaultParallelism, table(spark, d, "orders").count() // ORDERS_PER_FILE))
    o = o.withColumn("kind", F.explode(kinds))
    if files is not None:
        o = o.repartition(files)  # before they are text, which takes several times the room

    def row(status: Column) -> Column:
        return F.struct(
            "order_id", F.when(F.col("k") % 23 != 0, F.col("o_custkey").cast("string")).alias("user_id"), "warehouse_id",
            F.when(F.col("k") % 19 == 0, F.lit("lost")).otherwise(status).alias("status"),
            F.when(F.col("k") % 17 != 0, F.col("currency")).alias("currency"), "subtotal_cents", "discount_cents", "shipping_cents", "total_cents",
            F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("created_at"),
            F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("updated_at"))

    source = F.struct(F.lit("shop").alias("db"), F.lit("public").alias("schema"), F.lit("orders").alias("table"), F.lit("postgresql").alias("connector"))
    nothing = F.lit(None).cast("string")

    def change(op: str, after_ms: int, before: Column, after: Column) -> Column:
        return F.to_json(F.struct(F.lit("shop").alias("schema"), F.lit("orders").alias("table"), F.lit(op).alias("op"),
                                  (F.col("cdc_ts_ms") + after_ms).alias("ts_ms"), before.alias("before"), after.alias("after"), source.alias("source")))

    kind = F.col("kind")
    line = F.when(kind == "c", change("c", 0, nothing, row(F.col("status")))).when(
        kind == "u", change("u", 1000, row(F.col("status")), row(F.lit("shipped")))).when(
        kind == "d", change("d", 2000, row(F.col("status")), nothing)).otherwise(F.lit('{"op": "c", "after": {'))
    return o.select(line.alias("value"), F.trunc("created_at", "MM").alias("run_date"))


def order_items(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"), F.col("l_partkey").alias("product_id"), F.col("l_quantity").cast("bigint").alias("quantity"))


def products(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("brand"), F.col("p_type").alias("category"))


def inventory(spark: SparkSession, d: str) -> DataFrame:
    """Stock per part from its attributes, with the status bands of the stock report."""
    days = (F.col("p_partkey") * 7 % 100).cast("int")
    return table(spark, d, "part").select(
        F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"), F.col("p_name").alias("name"), F.col("p_type").alias("category"),
        _pick(HUBS, F.col("p_partkey") % 3).alias("warehouse"), F.col("p_size").alias("qty_on_hand"), F.lit(15).alias("reorder_point"),
        days.alias("days_remaining"), F.when(days <= 5, "critical").when(days <= 20, "warning").otherwise("healthy").alias("status"))


def runs(spark: SparkSession, d: str) -> DataFrame:
    """Run records: one task per (order day, priority)."""
    task = F.col("o_orderpriority")
    return table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("run_date"), task.alias("task_name")).agg(
        F.count(F.lit(1)).alias("records"), F.max("o_orderkey").alias("mx")).select(
        "run_date", "task_name", F.when(F.col("mx") % 25 == 0, "failed").otherwise("success").alias("status"),
        (F.col("mx") % 60).alias("duration_s"), "records",
        F.concat(F.date_format("run_date", "yyyy-MM-dd"), F.lit("T02:0"), F.substring("task_name", 1, 1), F.lit(":00")).alias("started_at"))


def campaigns(spark: SparkSession, d: str) -> DataFrame:
    """Ads performance per (supplier as campaign, ship date)."""
    li = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").cast("string").alias("campaign_id"), F.to_date("l_shipdate").alias("date")).agg(
        F.count(F.lit(1)).alias("clicks"), F.sum(F.col("l_quantity").cast("bigint")).alias("impressions"), F.max("l_orderkey").alias("mx"))
    return li.select(
        "campaign_id", F.concat(F.lit("campaign "), "campaign_id").alias("campaign_name"), F.lit("ENABLED").alias("campaign_status"),
        "impressions", "clicks", (F.col("mx") * 1000).alias("cost_micros"), (F.col("clicks") / F.lit(10.0)).alias("conversions"), "date")


def _sql_list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


CTES = {
    "customers": f"""SELECT c_custkey, {_sql_list(CHANNELS)}[list_position({_sql_list(SEGMENTS)}, c_mktsegment)] AS channel,
        list_position({_sql_list(SEGMENTS)}, c_mktsegment) - 1 AS seg, n_name AS country_code, 'wh-' || n_regionkey AS warehouse_id
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "base_orders": """SELECT *, CASE WHEN o_orderkey % 101 = 0 THEN 0 ELSE CAST(round(o_totalprice * 100) AS BIGINT) END AS total_cents,
        o_orderdate + to_seconds(o_orderkey % 86400) AS created_at FROM orders""",
    "silver": f"""SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderkey AS k, o_custkey,
        CASE WHEN o_custkey % 50 = 0 THEN 'ERASED' ELSE sha256('{SALT}|' || o_custkey) END AS user_id_hash, warehouse_id,
        {_sql_list(ORDER_STATUSES)}[o_orderkey % 6 + 1] AS status, 'USD' AS currency,
        total_cents + CASE WHEN o_orderkey % 7 = 0 THEN total_cents // 10 ELSE 0 END - CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE 499 END AS subtotal_cents,
        CAST(CASE WHEN o_orderkey % 7 = 0 THEN total_cents // 10 ELSE 0 END AS BIGINT) AS discount_cents,
        CAST(CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE 499 END AS BIGINT) AS shipping_cents, total_cents, 'c' AS cdc_op,
        epoch_ms(created_at) AS cdc_ts_ms, created_at, created_at + to_seconds(o_orderkey % 5 * 3600) AS updated_at, channel
        FROM base_orders LEFT JOIN customers ON o_custkey = c_custkey""",
    "stg": """SELECT order_id, user_id_hash, warehouse_id, status AS order_status, currency, subtotal_cents, discount_cents, shipping_cents,
        total_cents, total_cents - discount_cents AS net_revenue_cents, cdc_op, cdc_ts_ms, created_at, updated_at,
        date_trunc('day', created_at) AS order_date, channel FROM silver
        WHERE order_id IS NOT NULL AND user_id_hash IS NOT NULL AND total_cents > 0""",
    "fact": """SELECT * EXCLUDE (cdc_ts_ms), order_status = 'delivered' AS is_delivered, order_status IN ('refunded', 'cancelled') AS is_refunded_or_cancelled,
        CAST(date_part('year', created_at) AS INT) AS order_year, CAST(date_part('month', created_at) AS INT) AS order_month,
        CAST(date_part('dow', created_at) AS INT) AS order_day_of_week FROM stg""",
    "daily": """SELECT CAST(order_date AS TIMESTAMP) AS order_date, order_year, order_month, count(DISTINCT order_id) AS order_count, count(DISTINCT user_id_hash) AS unique_buyers,
        CAST(sum(total_cents) AS BIGINT) AS gross_revenue_cents, CAST(sum(net_revenue_cents) AS BIGINT) AS net_revenue_cents,
        CAST(sum(discount_cents) AS BIGINT) AS total_discount_cents, CAST(sum(shipping_cents) AS BIGINT) AS total_shipping_cents,
        CAST(avg(total_cents) AS BIGINT) AS avg_order_value_cents, CAST(count_if(is_refunded_or_cancelled) AS BIGINT) AS refunded_order_count,
        round(100.0::DOUBLE * count_if(is_refunded_or_cancelled) / count(*), 2) AS refund_rate_pct,
        CAST(count_if(is_delivered) AS BIGINT) AS delivered_order_count FROM fact GROUP BY 1, 2, 3""",
    "kept": "SELECT * FROM fact WHERE NOT is_refunded_or_cancelled AND user_id_hash <> 'ERASED'",
    "first_o": """SELECT user_id_hash, CAST(date_trunc('month', min(order_date)) AS TIMESTAMP) AS cohort_month, CAST(min(order_date) AS TIMESTAMP) AS first_order_date
        FROM kept GROUP BY 1""",
    "months": """SELECT DISTINCT k.user_id_hash, cohort_month, CAST(date_trunc('month', order_date) AS TIMESTAMP) AS activity_month
        FROM kept k JOIN first_o f ON k.user_id_hash = f.user_id_hash""",
    "user_dim": f"SELECT c_custkey AS user_id, sha256('{SALT}|' || c_custkey) AS user_id_hash, country_code, channel AS acquisition_channel FROM customers",
    "versions": f"""SELECT sha256('{SALT}|' || c_custkey) AS user_id_hash, country_code, {_sql_list(CHANNELS)}[(seg + i) % 5 + 1] AS acquisition_channel,
        TIMESTAMP '1995-01-01' AS created_at, TIMESTAMP '1995-01-01' + to_seconds((i * 700 + c_custkey % 300) * 86400) AS updated_at, c_custkey
        FROM customers, (VALUES (0), (1), (2)) v(i) WHERE i < 2 OR c_custkey % 3 = 0""",
    "scd2": """SELECT user_id_hash, country_code, acquisition_channel, created_at, updated_at, updated_at AS valid_from,
        lead(updated_at) OVER (PARTITION BY user_id_hash ORDER BY updated_at) AS valid_to FROM versions""",
    "base_live": """SELECT *, CAST(CASE WHEN event_id % 97 = 0 THEN 0 ELSE round(value * 100) END AS BIGINT) AS total_cents FROM events""",
    "live": f"""SELECT CAST(event_id AS VARCHAR) AS event_id, event_id AS k, md5(CAST(event_id AS VARCHAR)) AS order_id, 'c' AS op,
        sha256('{SALT}|' || user_id) AS user_id_hash, 'SKU-' || (event_id % 8) AS sku, {_sql_list(HUBS)}[event_id % 3 + 1] AS warehouse_id,
        CASE WHEN event_id % 11 = 0 THEN 'cancelled' ELSE {_sql_list(LIVE_STATUSES)}[event_id % 5 + 1] END AS status, 'USD' AS currency,
        {_sql_list(CHANNELS)}[event_id // 5 % 5 + 1] AS channel, CAST(event_id % 3 + 1 AS INT) AS qty, total_cents AS unit_price_cents,
        CAST(CASE WHEN event_id % 7 = 0 THEN total_cents // 10 ELSE 0 END AS BIGINT) AS discount_cents, CAST(499 AS BIGINT) AS shipping_cents,
        total_cents, ts AS occurred_at FROM base_live""",
    "live_ok": f"""SELECT *, status = 'delivered' AS is_delivered, status = 'refunded' AS is_refunded, discount_cents > 0 AS has_discount,
        CASE WHEN total_cents >= 10000 THEN 'high' WHEN total_cents >= 3000 THEN 'mid' ELSE 'low' END AS value_tier,
        CAST(trunc(total_cents * 0.35::DOUBLE) AS BIGINT) AS margin_cents FROM live
        WHERE order_id <> '' AND user_id_hash IS NOT NULL AND total_cents > 0 AND status IN ({", ".join(f"'{s}'" for s in LIVE_STATUSES)})""",
    "state": """SELECT *, count(*) OVER u AS order_count, CAST(sum(total_cents) OVER u AS BIGINT) AS total_spend, CAST(count_if(is_refunded) OVER u AS BIGINT) AS refunds,
        min(occurred_at) OVER u AS first_seen, lag(occurred_at) OVER (PARTITION BY user_id_hash ORDER BY occurred_at, event_id) AS previous_seen
        FROM live_ok WINDOW u AS (PARTITION BY user_id_hash ORDER BY occurred_at, event_id ROWS UNBOUNDED PRECEDING)""",
    "scored": """SELECT *, round(least(1.0::DOUBLE, 0.5::DOUBLE * CASE WHEN days > 90 THEN 1.0::DOUBLE WHEN days > 60 THEN 0.7::DOUBLE WHEN days > 30 THEN 0.4::DOUBLE ELSE 0.1::DOUBLE END
        + 0.3::DOUBLE * greatest(0.0::DOUBLE, 1.0::DOUBLE - order_count * 0.1::DOUBLE)
        + 0.2::DOUBLE * CASE WHEN total_spend / order_count < 1000 THEN 0.6::DOUBLE WHEN total_spend / order_count < 5000 THEN 0.3::DOUBLE ELSE 0.1::DOUBLE END), 4) AS churn_score
        FROM (SELECT *, coalesce((epoch_us(occurred_at) - epoch_us(previous_seen)) / 86400000000.0::DOUBLE, 0) AS days FROM state)""",
    "clicks": """SELECT CAST(event_id AS VARCHAR) AS event_id, event_id AS k, CAST(user_id % 10 AS VARCHAR) AS session_id,
        sha256('""" + SALT + """|' || user_id) AS user_id_hash,
        CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'product_view' WHEN 'signup' THEN 'add_to_cart' WHEN 'error' THEN 'search' ELSE 'purchase' END AS event_type,
        '/products/' || (CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) % 50) AS page_url, ts AS occurred_at FROM events""",
    "click_gaps": """SELECT *, CASE WHEN epoch_us(occurred_at) - epoch_us(lag(occurred_at) OVER (PARTITION BY session_id ORDER BY occurred_at, event_id)) > 1800000000 THEN 1 ELSE 0 END AS fresh FROM clicks""",
    "click_seq": """SELECT *, 1 + sum(fresh) OVER (PARTITION BY session_id ORDER BY occurred_at, event_id ROWS UNBOUNDED PRECEDING) AS session_seq FROM click_gaps""",
    "sessions": """SELECT session_id, CAST(session_seq AS BIGINT) AS session_seq, arg_min(user_id_hash, (occurred_at, event_id)) AS user_id_hash, min(occurred_at) AS session_start, max(occurred_at) AS session_end,
        CAST(trunc((epoch_us(max(occurred_at)) - epoch_us(min(occurred_at))) / 1000000.0) AS BIGINT) AS duration_seconds, count(*) AS event_count,
        CAST(count_if(event_type = 'page_view') AS BIGINT) AS page_views, CAST(count_if(event_type = 'product_view') AS BIGINT) AS product_views,
        CAST(count_if(event_type = 'add_to_cart') AS BIGINT) AS add_to_cart_count, CAST(count_if(event_type = 'search') AS BIGINT) AS search_count,
        bool_or(event_type = 'purchase') AS converted, arg_min(page_url, (occurred_at, event_id)) AS entry_page, arg_max(page_url, (occurred_at, event_id)) AS exit_page
        FROM click_seq GROUP BY 1, 2""",
    "changes": f"""SELECT order_id, k, CASE WHEN k % 23 <> 0 THEN sha256('{SALT}|' || o_custkey) END AS user_id_hash, warehouse_id,
        CASE WHEN k % 19 = 0 THEN 'lost' WHEN op = 'u' THEN 'shipped' ELSE status END AS status, currency, subtotal_cents, discount_cents, shipping_cents, total_cents,
        strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') AS created_at, strftime(updated_at, '%Y-%m-%dT%H:%M:%SZ') AS updated_at, op, cdc_ts_ms + off_ms AS ts_ms,
        CAST(date_trunc('month', silver.created_at) AS DATE) AS run_date
        FROM silver, (VALUES ('c', 0, 1), ('u', 1000, 3), ('d', 2000, 11)) v(op, off_ms, every) WHERE k % every = 0""",
    "checked": """SELECT *, user_id_hash IS NOT NULL AND status <> 'lost' AS ok FROM changes WHERE op <> 'd'""",
    "latest": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ts_ms DESC) AS rn FROM checked WHERE ok) WHERE rn = 1""",
    "runs": """SELECT run_date, task_name, CASE WHEN mx % 25 = 0 THEN 'failed' ELSE 'success' END AS status, mx % 60 AS duration_s, records,
        strftime(run_date, '%Y-%m-%d') || 'T02:0' || task_name[1] || ':00' AS started_at FROM
        (SELECT CAST(o_orderdate AS DATE) AS run_date, o_orderpriority AS task_name, count(*) AS records, max(o_orderkey) AS mx FROM orders GROUP BY 1, 2)""",
    "campaigns": """SELECT CAST(l_suppkey AS VARCHAR) AS campaign_id, 'campaign ' || l_suppkey AS campaign_name, 'ENABLED' AS campaign_status,
        CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS impressions, count(*) AS clicks, max(l_orderkey) * 1000 AS cost_micros, count(*) / 10.0::DOUBLE AS conversions,
        CAST(l_shipdate AS DATE) AS date FROM lineitem GROUP BY 1, 2, 3, 8""",
    "inv": f"""SELECT 'SKU-' || p_partkey AS sku, p_name AS name, p_type AS category, {_sql_list(HUBS)}[p_partkey % 3 + 1] AS warehouse, p_size AS qty_on_hand, 15 AS reorder_point,
        CAST(p_partkey * 7 % 100 AS INT) AS days_remaining, CASE WHEN p_partkey * 7 % 100 <= 5 THEN 'critical' WHEN p_partkey * 7 % 100 <= 20 THEN 'warning' ELSE 'healthy' END AS status FROM part""",
    "items": "SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantity FROM lineitem",
    "features": f"""SELECT user_id_hash, count(*) AS total_orders, CAST(max(order_date) AS TIMESTAMP) AS event_timestamp, date_diff('day', max(order_date), TIMESTAMP '{AS_OF}') AS days_since_last_order,
        CAST(avg(total_cents) AS BIGINT) AS avg_order_value_cents, CAST(sum(total_cents) AS BIGINT) AS lifetime_value_cents,
        round(count_if(is_refunded_or_cancelled) / count(*)::DOUBLE, 4) AS refund_rate, count(DISTINCT order_month) AS active_months,
        date_diff('day', min(order_date), max(order_date)) AS customer_age_days FROM fact WHERE user_id_hash <> 'ERASED' GROUP BY 1""",
}


def with_ctes(body: str) -> str:
    """``body`` preceded by the table definitions it (transitively) uses."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in order and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(CTES[name])
                order.append(name)

    visit(body)
    if not order:
        return body
    head = "RECURSIVE " if "RECURSIVE" in body else ""
    own = body.replace("WITH RECURSIVE ", ", ", 1) if "WITH RECURSIVE" in body else body.replace("WITH ", ", ", 1) if body.startswith("WITH ") else body
    return f"WITH {head}" + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + "\n" + own
