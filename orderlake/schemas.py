"""Explicit schemas; nothing is inferred from data at read time."""

from pyspark.sql import types as T

ORDER_ROW = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("warehouse_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("subtotal_cents", T.LongType()),
    T.StructField("discount_cents", T.LongType()),
    T.StructField("shipping_cents", T.LongType()),
    T.StructField("total_cents", T.LongType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("updated_at", T.StringType()),
])

CHANGE_SOURCE = T.StructType([
    T.StructField("db", T.StringType()),
    T.StructField("schema", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("connector", T.StringType()),
])

ORDER_CHANGE = T.StructType([
    T.StructField("schema", T.StringType()),
    T.StructField("table", T.StringType()),
    T.StructField("op", T.StringType()),
    T.StructField("ts_ms", T.LongType()),
    T.StructField("before", ORDER_ROW),
    T.StructField("after", ORDER_ROW),
    T.StructField("source", CHANGE_SOURCE),
])

# The flattened form a change connector may write instead of the envelope.
ORDER_FLAT = T.StructType(ORDER_ROW.fields + [
    T.StructField("__op", T.StringType()),
    T.StructField("__ts_ms", T.LongType()),
    T.StructField("__source_db", T.StringType()),
    T.StructField("__source_table", T.StringType()),
    T.StructField("__deleted", T.StringType()),
    T.StructField("pipeline_version", T.StringType()),
])

LIVE_ORDER = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("op", T.StringType()),
    T.StructField("user_id_hash", T.StringType()),
    T.StructField("sku", T.StringType()),
    T.StructField("warehouse_id", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("currency", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("qty", T.IntegerType()),
    T.StructField("unit_price_cents", T.LongType()),
    T.StructField("discount_cents", T.LongType()),
    T.StructField("shipping_cents", T.LongType()),
    T.StructField("total_cents", T.LongType()),
    T.StructField("occurred_at", T.TimestampType()),
])

CLICK = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("user_id_hash", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("page_url", T.StringType()),
    T.StructField("occurred_at", T.StringType()),
])

CAMPAIGN_PERFORMANCE = T.StructType([
    T.StructField("campaign_id", T.StringType()),
    T.StructField("campaign_name", T.StringType()),
    T.StructField("campaign_status", T.StringType()),
    T.StructField("impressions", T.LongType()),
    T.StructField("clicks", T.LongType()),
    T.StructField("cost_micros", T.LongType()),
    T.StructField("conversions", T.DoubleType()),
    T.StructField("date", T.DateType()),
])
