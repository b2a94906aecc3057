"""Registered queries: staging, marts, features, serving reads."""

from __future__ import annotations


from pyspark.sql import functions as F

from orderlake.functions import churn_score, day_name, hash_pii, ltv_segment, register_sql_functions, safe_divide, value_tier
from orderlake.operators import features as ft
from orderlake.operators import gold, serving
from orderlake.plans import tables as t
from orderlake.plans.registry import query

STG = """order_id, user_id_hash, warehouse_id, order_status, currency, subtotal_cents, discount_cents, shipping_cents, total_cents,
    net_revenue_cents, cdc_op"""
TIMES = "CAST(created_at AS TIMESTAMP) AS created_at, CAST(updated_at AS TIMESTAMP) AS updated_at, CAST(order_date AS TIMESTAMP) AS order_date"
SCORE = """least(1.0::DOUBLE, 0.5::DOUBLE * CASE WHEN days_since_last_order > 90 THEN 1.0::DOUBLE WHEN days_since_last_order > 60 THEN 0.7::DOUBLE
    WHEN days_since_last_order > 30 THEN 0.4::DOUBLE ELSE 0.1::DOUBLE END
    + 0.3::DOUBLE * greatest(0.0::DOUBLE, 1.0::DOUBLE - total_orders * 0.1::DOUBLE)
    + 0.2::DOUBLE * CASE WHEN avg_order_value_cents < 1000 THEN 0.6::DOUBLE WHEN avg_order_value_cents < 5000 THEN 0.3::DOUBLE ELSE 0.1::DOUBLE END)"""
AS_OF = f"TIMESTAMP '{t.AS_OF}'"


def stg(spark, d, dims=True):
    return gold.stg_orders(t.silver_orders(spark, d, dims))


def fact(spark, d, dims=True):
    return gold.fact_orders(stg(spark, d, dims))


def lean_fact(spark, d):
    """Fact without the customer lookup, for queries that use neither channel nor warehouse."""
    return fact(spark, d, dims=False)


def daily(spark, d):
    return gold.daily_revenue(lean_fact(spark, d))


query("stg_orders", f"SELECT {STG}, cdc_ts_ms, {TIMES}, channel FROM stg")(stg)
query("fact_orders", f"""SELECT {STG}, {TIMES}, channel, is_delivered, is_refunded_or_cancelled, order_year, order_month, order_day_of_week
    FROM fact""")(fact)
query("orders_enriched", f"""SELECT {STG}, {TIMES}, order_year, order_month, order_day_of_week, is_delivered, is_refunded_or_cancelled,
    discount_cents > 0 AS has_discount, shipping_cents = 0 AS is_free_shipping,
    CASE WHEN total_cents >= 10000 THEN 'high' WHEN total_cents >= 3000 THEN 'mid' ELSE 'low' END AS order_value_tier,
    dayname(created_at) AS order_day_name, discount_cents / total_cents::DOUBLE AS discount_rate FROM fact""")(
    lambda s, d: gold.orders_enriched(stg(s, d)))
query("item_count", """SELECT i.order_id, count(*) OVER (PARTITION BY i.order_id) AS item_count, product_id FROM items i""")(
    lambda s, d: gold.item_count(t.order_items(s, d)).select("order_id", "item_count", "product_id"))
query("daily_revenue", "SELECT * FROM daily")(daily)
query("daily_revenue_app", """SELECT CAST(order_date AS TIMESTAMP) AS order_date, count(*) AS order_count, count(DISTINCT user_id_hash) AS unique_buyers,
    CAST(sum(total_cents) AS BIGINT) AS gross_revenue_cents, CAST(sum(net_revenue_cents) AS BIGINT) AS net_revenue_cents,
    CAST(sum(discount_cents) AS BIGINT) AS discount_cents, CAST(sum(shipping_cents) AS BIGINT) AS shipping_cents,
    CAST(sum(total_cents) // count(*) AS BIGINT) AS avg_order_value_cents, CAST(count_if(is_refunded_or_cancelled) AS BIGINT) AS refunded_order_count,
    round(count_if(is_refunded_or_cancelled) / count(*)::DOUBLE * 100, 2) AS refund_rate_pct,
    CAST(count_if(is_delivered) AS BIGINT) AS delivered_order_count FROM fact GROUP BY 1""")(
    lambda s, d: gold.daily_revenue_app(lean_fact(s, d)))
query("gmv_metrics", """SELECT order_date, round(gross_revenue_cents / 100.0::DOUBLE, 2) AS gmv, round(net_revenue_cents / 100.0::DOUBLE, 2) AS net_revenue,
    round(avg_order_value_cents / 100.0::DOUBLE, 2) AS aov, refund_rate_pct AS refund_rate, unique_buyers FROM daily""")(
    lambda s, d: gold.gmv_metrics(daily(s, d)))

# --- cohorts
query("exclude_erased_refunded", "SELECT order_id, user_id_hash, order_status, total_cents FROM kept")(
    lambda s, d: gold.exclude_erased_refunded(lean_fact(s, d)).select("order_id", "user_id_hash", "order_status", "total_cents"))
query("first_orders", "SELECT user_id_hash, cohort_month, first_order_date FROM first_o")(lambda s, d: gold.first_orders(lean_fact(s, d)))
query("distinct_activity", "SELECT DISTINCT user_id_hash, CAST(date_trunc('month', order_date) AS TIMESTAMP) AS activity_month FROM kept")(
    lambda s, d: gold.distinct_activity(lean_fact(s, d)))
query("order_months", "SELECT user_id_hash, cohort_month, activity_month FROM months")(lambda s, d: gold.order_months(lean_fact(s, d)))
query("cohort_sizes", "SELECT cohort_month, count(DISTINCT user_id_hash) AS cohort_size FROM first_o GROUP BY 1")(
    lambda s, d: gold.cohort_sizes(lean_fact(s, d)))
# From the definition: a user's month is active if they bought in it, and none of their active months is before their cohort's.
COHORTS = """WITH active AS (SELECT DISTINCT user_id_hash AS u, CAST(date_trunc('month', order_date) AS TIMESTAMP) AS m FROM kept)
    SELECT CAST(a.m AS VARCHAR) AS cohort_month, date_diff('month', a.m, b.m) AS period_offset, CAST(b.m AS VARCHAR) AS activity_month,
        max(count(*)) OVER (PARTITION BY a.m) AS cohort_size, count(*) AS retained_users, count(*) / max(count(*)) OVER (PARTITION BY a.m)::DOUBLE * 100 AS retention_rate_pct
    FROM active a JOIN active b ON a.u = b.u AND b.m >= a.m WHERE NOT EXISTS (SELECT 1 FROM active e WHERE e.u = a.u AND e.m < a.m) GROUP BY a.m, b.m"""
query("user_cohorts", COHORTS)(lambda s, d: gold.user_cohorts(lean_fact(s, d)))


@query("retention_with_size", """SELECT cohort_month, activity_month, retained_users, cohort_size FROM
    (SELECT cohort_month, activity_month, count(DISTINCT user_id_hash) AS retained_users FROM months GROUP BY 1, 2)
    JOIN (SELECT cohort_month, count(*) AS cohort_size FROM first_o GROUP BY 1) USING (cohort_month)""")
def _retention(spark, d):
    f = lean_fact(spark, d)
    retained = gold.order_months(f).groupBy("cohort_month", "activity_month").agg(F.count(F.lit(1)).alias("retained_users"))
    return gold.retention_with_size(retained, gold.cohort_sizes(f))


# --- scalar functions on whole tables
query("hash_pii", f"SELECT c_custkey, sha256('{t.SALT}|' || c_custkey) AS user_id_hash FROM customer")(
    lambda s, d: t.table(s, d, "customer").select("c_custkey", hash_pii("c_custkey", t.SALT).alias("user_id_hash")))
query("value_tier", "SELECT order_id, CASE WHEN total_cents >= 10000 THEN 'high' WHEN total_cents >= 3000 THEN 'mid' ELSE 'low' END AS tier FROM live")(
    lambda s, d: t.live_orders(s, d).select("order_id", value_tier("total_cents").alias("tier")))
query("ltv_segment", "SELECT user_id_hash, CASE WHEN spend >= 50000 THEN 'high' WHEN spend >= 10000 THEN 'mid' ELSE 'low' END AS segment FROM (SELECT user_id_hash, sum(total_cents) AS spend FROM live GROUP BY 1)")(
    lambda s, d: t.live_orders(s, d).groupBy("user_id_hash").agg(F.sum("total_cents").alias("spend")).select("user_id_hash", ltv_segment("spend").alias("segment")))
query("day_name", "SELECT o_orderkey, dayname(o_orderdate) AS name FROM orders")(
    lambda s, d: t.table(s, d, "orders").select("o_orderkey", day_name(F.dayofweek("o_orderdate") - 1).alias("name")))
query("discount_rate", "SELECT order_id, CASE WHEN total_cents = 0 THEN NULL ELSE discount_cents / total_cents::DOUBLE END AS discount_rate FROM silver")(
    lambda s, d: t.silver_orders(s, d, dims=False).select("order_id", safe_divide("discount_cents", "total_cents").alias("discount_rate")))


@query("sql_macros", """SELECT order_id, CASE WHEN total_cents = 0 THEN NULL ELSE subtotal_cents / total_cents::DOUBLE END AS ratio,
    round(total_cents / 100.0::DOUBLE, 2) AS dollars, CASE WHEN subtotal_cents < 0 THEN NULL ELSE subtotal_cents END AS subtotal FROM silver""")
def _macros(spark, d):
    """The three arithmetic helpers through SQL, checked against their column forms by the same rows."""
    register_sql_functions(spark)
    rows = t.silver_orders(spark, d, dims=False)
    return rows.select("order_id", F.expr("safe_divide(subtotal_cents, total_cents)").alias("ratio"),
                       F.expr("cents_to_dollars(total_cents)").alias("dollars"), F.expr("assert_not_negative(subtotal_cents)").alias("subtotal"))


# --- features and scores
query("user_features", "SELECT * FROM features")(lambda s, d: ft.user_features(lean_fact(s, d), t.AS_OF))
query("materialize_features", f"""SELECT *, CASE WHEN lifetime_value_cents >= 50000 THEN 'high' WHEN lifetime_value_cents >= 10000 THEN 'mid' ELSE 'low' END AS ltv_segment,
    round({SCORE}, 4) AS churn_risk_score FROM features""")(lambda s, d: ft.materialize_features(lean_fact(s, d), t.AS_OF))
query("churn_score", f"SELECT user_id_hash, round({SCORE}, 4) AS score FROM features")(
    lambda s, d: ft.user_features(lean_fact(s, d), t.AS_OF).select("user_id_hash", F.round(churn_score(
        F.col("days_since_last_order"), F.col("total_orders"), F.col("avg_order_value_cents")), 4).alias("score")))
TIER = "CASE WHEN s >= 0.7::DOUBLE THEN 'high' WHEN s >= 0.4::DOUBLE THEN 'medium' ELSE 'low' END"
query("churn_tier", f"""SELECT user_id_hash, round(s, 4) AS churn_probability, {TIER} AS risk_tier,
    CASE {TIER} WHEN 'high' THEN 'Send win-back offer with 20% discount immediately.' WHEN 'medium' THEN 'Enrol in re-engagement email sequence.'
    ELSE 'No action needed — monitor at next 30-day review.' END AS recommendation FROM (SELECT *, {SCORE} AS s FROM features)""")(
    lambda s, d: serving.score_customers(ft.user_features(lean_fact(s, d), t.AS_OF)))


@query("score_requests", f"""SELECT user_id_hash, CASE WHEN error IS NULL THEN round(s, 4) END AS churn_probability, CASE WHEN error IS NULL THEN {TIER} END AS risk_tier, error
    FROM (SELECT *, {SCORE} AS s, CASE WHEN days_since_last_order NOT BETWEEN 0 AND 3650 THEN 'days_since_last_order must be 0-3650'
        WHEN total_orders < 0 THEN 'total_orders must be >= 0' WHEN avg_order_value_cents < 0 THEN 'avg_order_value_cents must be >= 0' END AS error FROM
        (SELECT CAST(c_custkey AS VARCHAR) AS user_id_hash, c_custkey * 7 % 4000 - 5 AS days_since_last_order, c_custkey % 15 - 1 AS total_orders,
            CAST(round(c_acctbal) AS BIGINT) AS avg_order_value_cents FROM customer))""")
def _score_requests(spark, d):
    c = t.table(spark, d, "customer")
    key = F.col("c_custkey")
    requests = c.select(key.cast("string").alias("user_id_hash"), (key * 7 % 4000 - 5).alias("days_since_last_order"),
                        (key % 15 - 1).alias("total_orders"), F.round("c_acctbal").cast("bigint").alias("avg_order_value_cents"))
    return serving.score_requests(requests).select("user_id_hash", "churn_probability", "risk_tier", "error")


query("churn_training_features", f"""SELECT user_id_hash, count(*) AS total_orders, avg(total_cents) AS avg_order_value_cents, CAST(sum(total_cents) AS BIGINT) AS lifetime_value_cents,
    CAST(count_if(is_refunded_or_cancelled) AS BIGINT) AS refund_count, count(DISTINCT order_month) AS active_months,
    date_diff('day', min(created_at), max(created_at)) AS customer_age_days, date_diff('day', max(created_at), {AS_OF}) AS days_since_last_order,
    count_if(is_refunded_or_cancelled) / count(*)::DOUBLE AS refund_rate, sum(total_cents)::DOUBLE / count(DISTINCT order_month) AS avg_monthly_spend,
    CAST(max(order_date) FILTER (is_delivered) AS TIMESTAMP) AS last_delivered_date,
    CASE WHEN date_diff('day', max(created_at), {AS_OF}) > 60 THEN 1 ELSE 0 END AS is_churned FROM fact WHERE user_id_hash <> 'ERASED' GROUP BY 1""")(
    lambda s, d: ft.churn_training_features(lean_fact(s, d), t.AS_OF))
query("daily_demand", "SELECT CAST(order_date AS DATE) AS ds, count(*) AS y FROM fact WHERE NOT is_refunded_or_cancelled GROUP BY 1")(
    lambda s, d: ft.daily_demand(lean_fact(s, d)))
query("product_daily_demand", """SELECT product_id, CAST(order_date AS DATE) AS ds, CAST(sum(quantity) AS BIGINT) AS y FROM items JOIN fact USING (order_id)
    WHERE NOT is_refunded_or_cancelled GROUP BY 1, 2""")(lambda s, d: ft.product_daily_demand(lean_fact(s, d), t.order_items(s, d)))

# --- serving reads
query("daily_revenue_latest", """SELECT CAST(order_date AS VARCHAR) AS order_date, order_count, unique_buyers, gross_revenue_cents, net_revenue_cents, avg_order_value_cents,
    refund_rate_pct FROM (SELECT * FROM daily ORDER BY order_date DESC LIMIT 30)""")(lambda s, d: serving.daily_revenue_latest(daily(s, d), 30))
query("serving_daily_row", """SELECT CAST(order_date AS VARCHAR) AS order_date, order_count, unique_buyers, gross_revenue_cents, net_revenue_cents, avg_order_value_cents,
    refund_rate_pct FROM daily""")(lambda s, d: serving.serving_daily_row(daily(s, d)))


@query("order_by_id", """SELECT order_id, user_id_hash, order_status, total_cents, net_revenue_cents, currency, CAST(order_date AS VARCHAR) AS order_date FROM
    (SELECT * REPLACE (md5(order_id) AS order_id) FROM fact) WHERE order_id = md5('77')""")
def _order_by_id(spark, d):
    import hashlib
    f = lean_fact(spark, d).withColumn("order_id", F.md5(F.col("order_id").cast("binary")))
    return serving.order_by_id(f, hashlib.md5(b"77").hexdigest(), style="app")


query("orders_list", "SELECT order_id, user_id_hash, warehouse_id, order_status, total_cents, currency, channel, CAST(order_date AS TIMESTAMP) AS order_date, created_at FROM fact WHERE order_status = 'shipped'")(
    lambda s, d: serving.orders_list(fact(s, d), "shipped"))
query("recent_orders", """SELECT order_id, user_id_hash, warehouse_id, order_status, total_cents, currency, channel, CAST(order_date AS TIMESTAMP) AS order_date, created_at FROM fact
    ORDER BY created_at DESC, order_id LIMIT 100""")(lambda s, d: serving.recent_orders(fact(s, d), 100))
query("since_days", f"SELECT order_id, total_cents FROM fact WHERE order_date >= {AS_OF} - INTERVAL 90 DAY")(
    lambda s, d: serving.since_days(lean_fact(s, d), t.AS_OF, 90).select("order_id", "total_cents"))
query("revenue_by_channel", f"""SELECT channel, count(*) AS order_count, CAST(sum(total_cents) AS BIGINT) AS revenue_cents, avg(total_cents) AS avg_order_value_cents FROM fact
    WHERE order_date >= {AS_OF} - INTERVAL 90 DAY GROUP BY 1""")(lambda s, d: serving.revenue_by_channel(fact(s, d), t.AS_OF, 90))
query("kpi_summary", f"""SELECT CAST(sum(order_count) AS BIGINT) AS total_orders, CAST(sum(gross_revenue_cents) AS BIGINT) AS gross_revenue_cents,
    CAST(sum(net_revenue_cents) AS BIGINT) AS net_revenue_cents, CAST(sum(total_discount_cents) AS BIGINT) AS discount_cents, avg(avg_order_value_cents) AS avg_order_value_cents,
    round(avg(refund_rate_pct), 6) AS avg_refund_rate_pct, CAST(sum(delivered_order_count) AS BIGINT) AS delivered_count,
    sum(gross_revenue_cents) / sum(order_count)::DOUBLE AS weighted_aov_cents FROM daily WHERE order_date >= {AS_OF} - INTERVAL 90 DAY""")(
    lambda s, d: serving.kpi_summary(daily(s, d), t.AS_OF, 90).withColumn("avg_refund_rate_pct", F.round("avg_refund_rate_pct", 6)))
query("low_stock", "SELECT * FROM inv WHERE status = 'critical'")(lambda s, d: serving.low_stock(t.inventory(s, d), "critical"))
query("pipeline_history", """SELECT run_date, CAST(count_if(status = 'success') AS BIGINT) AS success_count, CAST(count_if(status = 'failed') AS BIGINT) AS failed_count,
    CAST(sum(records) AS BIGINT) AS total_records FROM runs GROUP BY 1 ORDER BY 1 DESC LIMIT 30""")(lambda s, d: serving.pipeline_history(t.runs(s, d)))
query("latest_run_rows", "SELECT * FROM runs WHERE run_date = (SELECT max(run_date) FROM runs)")(lambda s, d: serving.latest_run_rows(t.runs(s, d)))


@query("pipeline_status", """SELECT 'task' AS section, task_name AS name, status, duration_s, records AS rows, CAST(NULL AS BIGINT) AS failed_rows, started_at FROM runs
    WHERE run_date = (SELECT max(run_date) FROM runs)
    UNION ALL SELECT 'check', task_name, CASE WHEN status = 'success' THEN 'success' ELSE 'failed' END, NULL, records, duration_s, NULL FROM runs
    WHERE run_date = (SELECT max(run_date) FROM runs)""")
def _pipeline_status(spark, d):
    r = t.runs(spark, d)
    checks = r.select(F.col("run_date").alias("check_date"), F.col("task_name").alias("check_name"), F.when(F.col("status") == "success", 1).otherwise(0).alias("passed"),
                      F.col("records").alias("rows_checked"), F.col("duration_s").alias("failed_rows"))
    return serving.pipeline_status(r, checks)


query("table_counts", """SELECT 'orders' AS table_name, count(*) AS row_count FROM orders UNION ALL SELECT 'customer', count(*) FROM customer
    UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'missing', -1""")(
    lambda s, d: serving.table_counts({**{n: t.table(s, d, n) for n in ("orders", "customer", "events")}, "missing": None}))

@query("order_dimensions", """SELECT order_id, s.warehouse_id, r_name AS warehouse_name, country_code, acquisition_channel, total_cents FROM silver s
    LEFT JOIN user_dim u ON s.user_id_hash = u.user_id_hash LEFT JOIN region ON s.warehouse_id = 'wh-' || r_regionkey""")
def _order_dimensions(spark, d):
    warehouses = t.table(spark, d, "region").select(F.concat(F.lit("wh-"), F.col("r_regionkey").cast("string")).alias("warehouse_id"), F.col("r_name").alias("warehouse_name"))
    users = t.users(spark, d).drop("user_id")
    return serving.order_dimensions(t.silver_orders(spark, d), users, warehouses).select(
        "order_id", "warehouse_id", "warehouse_name", "country_code", "acquisition_channel", "total_cents")


query("cluster_fact", "SELECT order_id, user_id_hash, CAST(order_date AS TIMESTAMP) AS order_date, total_cents FROM fact")(
    lambda s, d: gold.cluster_fact(lean_fact(s, d), 8).select("order_id", "user_id_hash", "order_date", "total_cents"))
