"""Registered queries: change events of users, order items and inventory, from topics to current tables and history."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderlake.functions import CHANNELS
from orderlake.operators import changes as ch
from orderlake.plans import tables as t
from orderlake.plans.registry import query
from orderlake.session import scratch
from orderlake.sources import bronze, sinks

EPOCH, DAY = 1_700_000_000_000, 86_400_000


def envelope(op, ts, row):
    """The text of a change; deletes have the old row."""
    return F.to_json(F.struct(op.alias("op"), ts.alias("ts_ms"), F.when(op == "d", row).alias("before"), F.when(op != "d", row).alias("after")))


def flattened(op, ts, columns):
    return F.to_json(F.struct(*columns, op.alias("__op"), ts.alias("__ts_ms"), F.when(op == "d", "true").otherwise("false").alias("__deleted")))


def user_lines(spark, d):
    """Up to four versions of each customer, every second one flattened; deletes with their tombstones, rows without a key, and lines that are no JSON."""
    k = F.col("c_custkey").cast("bigint")
    steps = t.table(spark, d, "customer").withColumn("s", F.explode(F.concat(F.sequence(F.lit(0), (k % 4).cast("int")), F.when(k % 11 == 0, F.array(F.lit(10))).otherwise(F.array().cast("array<int>")))))
    s = F.col("s")
    op = F.when(s == 10, "d").when(s > 0, "u").when(k % 5 == 0, "r").otherwise("c")
    ts = F.lit(EPOCH) + k * 1000 + s * F.lit(DAY)
    iso = lambda ms: F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    channel = F.when((k + s) % 29 == 0, "pigeon").otherwise(F.element_at(F.array(*map(F.lit, CHANNELS)), ((k + s) % 5 + 1).cast("int")))
    columns = [F.when(k % 37 != 0, k.cast("string")).alias("user_id"), F.concat(F.lit("u"), k, F.lit("@example.org")).alias("email"), F.concat(F.lit("N"), "c_nationkey").alias("country_code"),
               channel.alias("acquisition_channel"), iso(F.lit(EPOCH) + k * 1000).alias("created_at"), iso(ts).alias("updated_at")]
    text = F.when(k % 2 == 1, flattened(op, ts, columns)).otherwise(envelope(op, ts, F.struct(*columns)))
    more = F.array(text, F.when(op == "d", F.lit(None)).when((k % 41 == 0) & (s == 0), F.concat(F.lit("oops "), k)).otherwise(F.lit("")))
    return steps.select(F.explode(more).alias("value"))


def item_lines(spark, d):
    """A create for each line item, an update for first lines, and flattened deletes for some second ones."""
    o, n = F.col("l_orderkey").cast("bigint"), F.col("l_linenumber").cast("int")
    base = F.lit(EPOCH) + o * 8 + n
    quantity = F.col("l_quantity").cast("int")
    row = lambda q: [F.concat_ws("-", o, n, "l_partkey", "l_suppkey", F.unix_date(F.col("l_shipdate").cast("date"))).alias("item_id"), o.cast("string").alias("order_id"), F.col("l_partkey").cast("string").alias("product_id"), q.alias("quantity"),
                     (F.col("l_partkey") % 9000 + 99).cast("bigint").alias("unit_price_cents"), (n * 10).cast("bigint").alias("discount_cents")]
    first = envelope(F.lit("c"), base, F.struct(*row(F.when((o + n) % 43 == 0, 0).otherwise(quantity))))
    then = F.when(n == 1, envelope(F.lit("u"), base + DAY, F.struct(*row(quantity + 1)))).when((n == 2) & (o % 13 == 0), flattened(F.lit("d"), base + DAY, row(quantity)))
    return t.table(spark, d, "lineitem").select(F.explode(F.array(first, then)).alias("value"))


def stock_lines(spark, d):
    """Stock of a product in a warehouse, as each line item leaves it; some below zero, some deleted."""
    o, n = F.col("l_orderkey").cast("bigint"), F.col("l_linenumber").cast("bigint")
    ts = F.unix_date(F.col("l_shipdate").cast("date")).cast("bigint") * DAY + o * 8 + n
    row = F.struct(F.col("l_partkey").cast("string").alias("product_id"), F.concat(F.lit("wh-"), F.col("l_suppkey") % 5).alias("warehouse_id"),
                   F.when(o % 31 == 0, -1).otherwise(F.col("l_quantity").cast("int")).alias("quantity_on_hand"), F.lit(10).alias("reorder_point"))
    op = F.when((o % 17 == 0) & (n == 3), "d").otherwise("u")
    return t.table(spark, d, "lineitem").select(envelope(op, ts, row).alias("value"))


LINES = {"users": user_lines, "order_items": item_lines, "inventory": stock_lines}


def topic_folder(spark, d, names):
    """Messages of the topics as a folder for each table, the way they arrive."""
    path = scratch(spark, "topics")
    for name in names:
        messages = LINES[name](spark, d).select(F.lit(f"shop.{name}").alias("topic"), "value")
        sinks.write_partitioned(bronze.topic_fanout(messages), path, ["table"])
    return path


def arrived(spark, d, name, path=None):
    """Parsed changes of one table; only its folder is read."""
    lines = spark.read.schema("topic string, value string, table string").parquet(path or topic_folder(spark, d, [name])).where(F.col("table") == name).select("value")
    return ch.parse_changes(lines, ch.sources()[name])


VERSIONS = f"""(SELECT c_custkey AS k, s, {EPOCH} + c_custkey * 1000 AS made, {EPOCH} + c_custkey * 1000 + s * {DAY} AS ts, 'N' || c_nationkey AS country_code,
    CASE WHEN (c_custkey + s) % 29 = 0 THEN 'pigeon' ELSE {CHANNELS}[(c_custkey + s) % 5 + 1] END AS acquisition_channel FROM customer, range(11) r(s)
    WHERE s <= c_custkey % 4 OR (s = 10 AND c_custkey % 11 = 0))"""
GOOD_USERS = "k % 37 <> 0 AND (s = 10 OR acquisition_channel <> 'pigeon')"
HASH = f"sha256('{t.SALT}|' || k) AS user_id_hash"
ITEMS = "(SELECT *, l_orderkey AS o, l_linenumber AS n FROM lineitem)"
STOCK = f"""(SELECT *, l_orderkey % 17 = 0 AND l_linenumber = 3 AS deleted, CASE WHEN l_orderkey % 31 = 0 THEN -1 ELSE CAST(l_quantity AS INT) END AS q,
    date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) * {DAY} + l_orderkey * 8 + l_linenumber AS ts, 'wh-' || l_suppkey % 5 AS w FROM lineitem)"""

query("silver_users", f"""SELECT {HASH}, country_code, acquisition_channel, make_timestamp(made * 1000) AS created_at, make_timestamp(ts * 1000) AS updated_at FROM (
    SELECT * FROM {VERSIONS} v WHERE {GOOD_USERS} QUALIFY row_number() OVER (PARTITION BY k ORDER BY s DESC) = 1) WHERE s < 10""")(
    lambda s, d: ch.users_table(arrived(s, d, "users"), t.SALT))
query("user_history", f"""SELECT {HASH}, acquisition_channel, make_timestamp(ts * 1000) AS valid_from, make_timestamp(following * 1000) AS valid_to FROM (
    SELECT *, lead(ts) OVER (PARTITION BY k ORDER BY ts) AS following FROM {VERSIONS} v WHERE {GOOD_USERS}) WHERE s < 10""")(
    lambda s, d: ch.user_history(arrived(s, d, "users"), t.SALT).select("user_id_hash", "acquisition_channel", "valid_from", "valid_to"))
query("silver_order_items", f"""SELECT concat_ws('-', o, n, l_partkey, l_suppkey, date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE))) AS item_id, CAST(o AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_quantity AS INT) + CASE WHEN n = 1 THEN 1 ELSE 0 END AS quantity,
    CAST(l_partkey % 9000 + 99 AS BIGINT) AS unit_price_cents, CAST(n * 10 AS BIGINT) AS discount_cents FROM {ITEMS} i
    WHERE NOT (n = 2 AND o % 13 = 0) AND (n = 1 OR (o + n) % 43 <> 0)""")(lambda s, d: ch.order_items_table(arrived(s, d, "order_items")))
query("silver_inventory", f"""SELECT CAST(l_partkey AS VARCHAR) AS product_id, w AS warehouse_id, q AS quantity_on_hand, 10 AS reorder_point, make_timestamp(ts * 1000) AS updated_at, q <= 10 AS below_reorder
    FROM (SELECT * FROM {STOCK} x WHERE deleted OR q >= 0 QUALIFY row_number() OVER (PARTITION BY l_partkey, w ORDER BY ts DESC) = 1) WHERE NOT deleted""")(
    lambda s, d: ch.inventory_table(arrived(s, d, "inventory")))


@query("rejected_changes", f"""SELECT "table", errors, count(*) AS n FROM (
    SELECT 'users' AS "table", concat_ws(',', CASE WHEN k % 37 = 0 THEN 'user_id is null' END, CASE WHEN s < 10 AND acquisition_channel = 'pigeon' THEN 'invalid acquisition_channel' END) AS errors
        FROM {VERSIONS} v WHERE NOT ({GOOD_USERS})
    UNION ALL SELECT 'users', 'not a change' FROM customer WHERE c_custkey % 41 = 0
    UNION ALL SELECT 'order_items', 'invalid quantity' FROM {ITEMS} i WHERE (o + n) % 43 = 0
    UNION ALL SELECT 'inventory', 'invalid quantity_on_hand' FROM {STOCK} x WHERE NOT deleted AND q < 0) GROUP BY 1, 2""")
def _rejected(spark, d):
    path = topic_folder(spark, d, list(LINES))
    parts = [ch.rejected(arrived(spark, d, name, path)).select(F.lit(name).alias("table"), F.array_join("errors", ",").alias("errors")) for name in LINES]
    return bronze.concat_files(parts).groupBy("table", "errors").agg(F.count(F.lit(1)).alias("n"))
