"""Registered queries: live operators, in batch form and as streams over the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderlake.operators import live as lv
from orderlake.plans import tables as t
from orderlake.plans.ingest import LINES
from orderlake.plans.registry import query
from orderlake.schemas import LIVE_ORDER
from orderlake.session import scratch, shuffles_dropped
from orderlake.sources import sinks
from orderlake.sources.bronze import change_stream
from orderlake.sources.merge import delete_folder
from orderlake.streaming import alerts as sa
from orderlake.streaming import kpis as sk
from orderlake.streaming import lake as lk
from orderlake.streaming import live as sl
from orderlake.streaming import sessions as ss
from orderlake.streaming import users as su

COOLDOWN = 86_400
THRESHOLD = 0.255
END = "2030-01-01 00:00:00"
ROWS_PER_FILE = 100_000


def valid(spark, d):
    return lv.valid_live(t.live_orders(spark, d))


def enriched(spark, d):
    return lv.enrich_live(valid(spark, d))


def state(spark, d):
    return lv.running_user_state(enriched(spark, d))


def scored(spark, d):
    return lv.live_churn_score(state(spark, d))


def now():
    return F.lit(t.LIVE_AS_OF).cast("timestamp")


ERRORS = "concat_ws(',', CASE WHEN total_cents <= 0 THEN 'invalid total_cents=' || total_cents END, CASE WHEN status = 'cancelled' THEN 'invalid status=cancelled' END)"
ENRICHED = "event_id, order_id, status, total_cents, is_delivered, is_refunded, has_discount, value_tier, margin_cents"
MONEY = "printf('$%.2f', total_cents / 100.0::DOUBLE)"

query("validate_live", f"SELECT event_id, {ERRORS} AS errors FROM live")(
    lambda s, d: lv.validate_live(t.live_orders(s, d)).select("event_id", F.array_join("errors", ",").alias("errors")))
query("enrich_live", f"SELECT {ENRICHED} FROM live_ok")(
    lambda s, d: enriched(s, d).select(*[c.strip() for c in ENRICHED.split(",")]))
query("high_value_orders", f"""SELECT 'high_value_order' AS type, order_id[1:8] AS order_id, {MONEY} AS amount, 'High-value order: ' || {MONEY} AS message, occurred_at AS ts
    FROM live_ok WHERE total_cents > 20000""")(lambda s, d: lv.high_value_orders(enriched(s, d)))
query("running_user_state", """SELECT event_id, order_count, total_spend, refunds, first_seen, previous_seen FROM state""")(
    lambda s, d: state(s, d).select("event_id", "order_count", "total_spend", "refunds", "first_seen", "previous_seen"))
query("user_channels", """SELECT user_id_hash, string_agg(channel, ',' ORDER BY f) AS channels FROM (
    SELECT user_id_hash, channel, min((occurred_at, event_id)) AS f FROM live_ok GROUP BY 1, 2) GROUP BY 1""")(
    lambda s, d: state(s, d).groupBy("user_id_hash").agg(F.max_by(F.array_join("channels", ","), "order_count").alias("channels")))
query("live_churn_score", "SELECT event_id, churn_score FROM scored")(lambda s, d: scored(s, d).select("event_id", "churn_score"))
query("live_order_card", """SELECT order_id[1:8] || '…' AS order_id, status, total_cents, channel, churn_score, value_tier, sku, occurred_at AS ts FROM scored""")(
    lambda s, d: lv.live_order_card(scored(s, d)))
query("event_envelope", """SELECT '{"type":"order","data":{"order_id":"' || order_id || '","total_cents":' || total_cents || '},"ts":"' || strftime(occurred_at, '%Y-%m-%dT%H:%M:%S.%fZ') || '"}' AS value FROM live_ok""")(
    lambda s, d: lv.event_envelope(valid(s, d).select("order_id", "total_cents", F.date_format("occurred_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("_at")), "order", F.col("_at"))
    .select(F.regexp_replace("value", r',"_at":"[^"]*"\}', "}").alias("value")))

TRAILING = """SELECT {key}occurred_at AS at, CAST(sum(total_cents) OVER (w RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW) AS BIGINT) AS revenue_60s_cents,
    CAST(sum(total_cents) OVER (w RANGE BETWEEN 299999999 PRECEDING AND CURRENT ROW) AS BIGINT) AS revenue_300s_cents,
    count(*) OVER (w RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW) AS orders_60s,
    round(count(*) OVER (w RANGE BETWEEN 4999999 PRECEDING AND CURRENT ROW) / 5.0::DOUBLE, 2) AS events_per_second
    FROM live_ok WINDOW w AS ({part}ORDER BY epoch_us(occurred_at))"""
query("trailing_revenue", TRAILING.format(key="", part=""))(lambda s, d: lv.trailing_revenue(valid(s, d)))
query("trailing_revenue_by_channel", TRAILING.format(key="channel, ", part="PARTITION BY channel "))(lambda s, d: lv.trailing_revenue(valid(s, d), ["channel"]))

COOL = """WITH RECURSIVE c AS (SELECT user_id_hash, epoch_us(occurred_at) AS t, event_id FROM scored WHERE churn_score >= {threshold}),
    chain AS (SELECT user_id_hash, min(t) AS t FROM c GROUP BY 1
        UNION ALL SELECT k.user_id_hash, (SELECT min(c.t) FROM c WHERE c.user_id_hash = k.user_id_hash AND c.t {op} k.t + {gap}) FROM chain k
        WHERE k.t IS NOT NULL)
    SELECT c.event_id, c.user_id_hash FROM chain JOIN c ON chain.user_id_hash = c.user_id_hash AND chain.t = c.t"""


def candidates(spark, d):
    return scored(spark, d).filter(F.col("churn_score") >= THRESHOLD).select("event_id", "user_id_hash", "occurred_at")


query("cooldown_alerts", COOL.format(threshold=THRESHOLD, op=">", gap=COOLDOWN * 1_000_000))(
    lambda s, d: lv.cooldown_alerts(candidates(s, d), "user_id_hash", "occurred_at", COOLDOWN, tie=["event_id"]).select("event_id", "user_id_hash"))
query("cooldown_alerts_inclusive", COOL.format(threshold=THRESHOLD, op=">=", gap=COOLDOWN * 1_000_000))(
    lambda s, d: lv.cooldown_alerts(candidates(s, d), "user_id_hash", "occurred_at", COOLDOWN, inclusive=True, tie=["event_id"]).select("event_id", "user_id_hash"))
# Latencies with a last digit of 3 microseconds never meet a half, so whole numbers show the rounding exactly.
query("latency_ewma", """SELECT warehouse_id, count(*) AS events, list_reduce(list(x ORDER BY occurred_at, event_id), lambda s, x: (90 * s + x + 50) // 100, CAST(0 AS BIGINT)) / 100.0::DOUBLE AS latency_ms
    FROM (SELECT *, total_cents % 10000 * 10 + 3 AS x FROM live_ok) GROUP BY 1""")(
    lambda s, d: lv.latency_ewma(valid(s, d).withColumn("latency", (F.col("total_cents") % 10000 * 10 + 3) / 1000.0), "warehouse_id", "occurred_at", "latency", "event_id"))

HOURS = 24 * 60
SINCE = f"occurred_at >= TIMESTAMP '{t.LIVE_AS_OF}' - INTERVAL {HOURS} MINUTE"
query("rt_stats", f"""SELECT count(*) AS total_orders, CAST(sum(total_cents) AS BIGINT) AS revenue_cents, avg(total_cents) AS avg_order_cents, round(avg(churn_score), 6) AS avg_churn_score,
    CAST(count_if(is_refunded) AS BIGINT) AS refunds, count(DISTINCT channel) AS channels_active FROM scored WHERE {SINCE}""")(
    lambda s, d: lv.rt_stats(lv.rt_window(scored(s, d), now(), HOURS)).withColumn("avg_churn_score", F.round("avg_churn_score", 6)))
query("rt_by_channel", f"SELECT channel, count(*) AS cnt, CAST(sum(total_cents) AS BIGINT) AS rev FROM live_ok WHERE {SINCE} GROUP BY 1")(
    lambda s, d: lv.rt_by_channel(lv.rt_window(enriched(s, d), now(), HOURS)))
query("rt_by_tier", f"SELECT value_tier, count(*) AS cnt FROM live_ok WHERE {SINCE} GROUP BY 1")(
    lambda s, d: lv.rt_by_tier(lv.rt_window(enriched(s, d), now(), HOURS)))
query("live_orders", "SELECT event_id, order_id, status, total_cents, occurred_at FROM live_ok ORDER BY occurred_at DESC LIMIT 200")(
    lambda s, d: lv.live_orders(valid(s, d), 200).select("event_id", "order_id", "status", "total_cents", "occurred_at"))
query("recent_anomalies", "SELECT order_id[1:8] AS order_id, occurred_at AS ts FROM live_ok WHERE total_cents > 20000 ORDER BY occurred_at DESC LIMIT 20")(
    lambda s, d: lv.newest(lv.high_value_orders(enriched(s, d)), 20, "ts", "order_id").select("order_id", "ts"))
query("recent_alerts", COOL.format(threshold=THRESHOLD, op=">", gap=COOLDOWN * 1_000_000).replace(
    "SELECT c.event_id, c.user_id_hash FROM", "SELECT c.user_id_hash[1:16] AS user_prefix, make_timestamp(c.t) AS ts FROM") + " ORDER BY ts DESC LIMIT 20")(
    lambda s, d: lv.newest(lv.churn_alerts(scored(s, d), THRESHOLD, COOLDOWN), 20, "ts", "user_prefix").select("user_prefix", "ts"))
query("ring_trim", "SELECT order_id, occurred_at FROM live_ok ORDER BY occurred_at DESC LIMIT 1000")(
    lambda s, d: lv.ring_trim(valid(s, d), 1000).select("order_id", "occurred_at"))
query("churn_histogram", "SELECT CAST(least(9, floor(churn_score * 10.0::DOUBLE)) AS INT) AS bucket, count(*) AS cnt FROM scored GROUP BY 1")(
    lambda s, d: lv.churn_histogram(scored(s, d)))
query("channel_counts", "SELECT channel, count(*) AS cnt FROM live_ok GROUP BY 1")(lambda s, d: lv.channel_counts(valid(s, d)))
BUCKETS = "SELECT CAST(date_trunc('second', occurred_at) AS TIMESTAMP) AS bucket_start, CAST(sum(total_cents) AS BIGINT) AS revenue_cents, count(*) AS orders FROM live_ok GROUP BY 1"
query("revenue_buckets", BUCKETS)(lambda s, d: lv.revenue_buckets(valid(s, d)))
BURSTS = """SELECT make_timestamp(epoch_us(occurred_at) // 3600000000 * 3600000000) AS bucket_start, CAST(sum(total_cents) AS BIGINT) AS revenue_cents, count(*) AS orders
    FROM live_ok GROUP BY 1 HAVING count(*) >= 15"""
query("burst_detect", BURSTS)(lambda s, d: lv.burst_detect(valid(s, d), 3600, 15))


# --- streams

def source(spark, d, rows=None, sentinel="occurred_at"):
    """The live orders as files, followed by a far-future row so that the last windows close."""
    path = scratch(spark, "live-source")
    rows = t.live_orders(spark, d) if rows is None else rows
    rows.write.parquet(path)
    last = {c: F.lit(None).cast(ty) for c, ty in rows.dtypes} | {sentinel: F.lit(END).cast("timestamp")}
    if "order_id" in rows.columns:
        last |= {"order_id": F.lit("sentinel"), "user_id_hash": F.lit("sentinel"), "event_id": F.lit("sentinel"), "status": F.lit("placed"),
                 "total_cents": F.lit(1).cast("bigint")}
    else:
        last |= {"session_id": F.lit("sentinel"), "event_id": F.lit("sentinel")}
    spark.range(1).select(*[c.alias(n) for n, c in last.items()]).select(*rows.columns).write.mode("append").parquet(path)
    return path, rows.schema


def run(spark, stream, **kw):
    out = scratch(spark, "live-out")
    sl.run_available(stream, out, scratch(spark, "ckpt"), **kw)
    return spark.read.parquet(out)


def live_stream(spark, d):
    sl.use_rocksdb(spark)
    path, schema = source(spark, d)
    return sl.read_live(spark, path, schema)


@query("stream_validate_enrich", f"SELECT {ENRICHED}, total_cents > 20000 AS is_anomaly FROM live_ok")
def _stream_enrich(spark, d):
    out = run(spark, sl.stream_validate_enrich(live_stream(spark, d)))
    return out.filter("order_id <> 'sentinel'").select(*[c.strip() for c in ENRICHED.split(",")], "is_anomaly")


@query("stream_user_state", """SELECT event_id, order_count, total_spend, refunds, churn_score FROM scored""")
def _stream_state(spark, d):
    out = run(spark, sl.stream_user_state(sl.stream_validate_enrich(live_stream(spark, d)), THRESHOLD, COOLDOWN))
    return out.filter("order_id <> 'sentinel'").select("event_id", "order_count", "total_spend", "refunds", "churn_score")


KPI = """SELECT make_timestamp(b * 20000000 - o * 20000000) AS window_start, make_timestamp(b * 20000000 - o * 20000000 + 60000000) AS window_end,
    CAST(sum(v) AS BIGINT) AS revenue_cents, CAST(sum(n) AS BIGINT) AS orders FROM
    (SELECT epoch_us(occurred_at) // 20000000 AS b, sum(total_cents) AS v, count(*) AS n FROM live_ok GROUP BY 1), (VALUES (0), (1), (2)) x(o) GROUP BY 1, 2"""


@query("stream_kpis", KPI)
def _stream_kpis(spark, d):
    return run(spark, sl.stream_kpis(sl.stream_validate_enrich(live_stream(spark, d)), 60, 20)).filter(F.col("window_end") < "2029-01-01")


@query("stream_dedup", "SELECT order_id FROM live")
def _stream_dedup(spark, d):
    """Every order arrives twice."""
    sl.use_rocksdb(spark)
    rows = t.live_orders(spark, d)
    path, schema = source(spark, d, rows.unionByName(rows))
    return run(spark, sl.stream_dedup(sl.read_live(spark, path, schema))).filter("order_id <> 'sentinel'").select("order_id")


@query("stream_revenue_buckets", BUCKETS)
def _stream_buckets(spark, d):
    stream = sl.bucket_columns(sl.stream_revenue_buckets(sl.stream_validate_enrich(live_stream(spark, d))))
    return run(spark, stream).filter(F.col("bucket_start") < "2029-01-01")


@query("stream_sessionize", """SELECT session_id, user_id_hash, session_start, session_end, event_count, page_views, product_views, add_to_cart_count, search_count, converted,
    entry_page, exit_page, duration_seconds FROM sessions""")
def _stream_sessions(spark, d):
    sl.use_rocksdb(spark)
    path, schema = source(spark, d, t.clicks(spark, d))
    return run(spark, sl.stream_sessionize(sl.read_live(spark, path, schema))).filter("session_id <> 'sentinel'")


@query("stream_missing_session", "SELECT event_id FROM clicks WHERE session_id IS NULL OR CAST(event_id AS BIGINT) % 10 = 0")
def _stream_missing(spark, d):
    """Every tenth click comes without a session."""
    sl.use_rocksdb(spark)
    path, schema = source(spark, d, t.clicks(spark, d).withColumn("session_id", F.when(F.col("event_id").cast("bigint") % 10 != 0, F.col("session_id"))))
    out = scratch(spark, "live-out")
    sl.run_batches(sl.read_live(spark, path, schema), sl.missing_session_sink(out), scratch(spark, "ckpt"))
    return spark.read.parquet(out).select("event_id")


@query("stream_late_rows", "SELECT CAST(0 AS BIGINT) AS late_rows")
def _stream_late(spark, d):
    """Clicks that the live sessions drop behind their watermark; all clicks come in one micro-batch here, so none is late."""
    sl.use_rocksdb(spark)
    path, schema = source(spark, d, t.clicks(spark, d))
    late = sl.LateRows(spark)
    sl.run_available(sl.stream_sessionize(sl.read_live(spark, path, schema)), scratch(spark, "live-out"), scratch(spark, "ckpt"), listener=late)
    return spark.range(1).select(F.lit(late.total()).cast("bigint").alias("late_rows"))


@query("stream_burst_detect", BURSTS)
def _stream_bursts(spark, d):
    stream = sl.stream_burst_detect(sl.stream_validate_enrich(live_stream(spark, d)), 3600, 15)
    return run(spark, stream).filter(F.col("bucket_start") < "2029-01-01")


@query("stream_recent_store", "SELECT order_id, occurred_at FROM live_ok ORDER BY occurred_at DESC LIMIT 1000")
def _stream_store(spark, d):
    """Newest orders kept across micro-batches."""
    store = scratch(spark, "store")
    path = scratch(spark, "live-source")
    rows = t.live_orders(spark, d)
    files = max(1, rows.count() // (3 * ROWS_PER_FILE))
    rows.repartitionByRange(3 * files, "occurred_at").write.parquet(path)
    stream = lv.valid_live(sl.read_live(spark, path, LIVE_ORDER, per_trigger=files)).select("order_id", "occurred_at")
    sl.run_batches(stream, sl.recent_store(store, 1000), scratch(spark, "ckpt"))
    return sl.read_recent_store(spark, store).select("order_id", "occurred_at")


def topic(spark, d, path, batches, early=False):
    """Order change lines as files for so many micro-batches; returns how many files a micro-batch has. ``early`` deals the lines out before they are text,
    which takes far less room; other lines then meet in a micro-batch."""
    files = max(1, t.table(spark, d, "orders").count() // (batches * ROWS_PER_FILE))
    with shuffles_dropped(spark):
        lines = t.order_lines(spark, d, batches * files) if early else t.order_lines(spark, d).select("value").repartition(batches * files)
        lines.select("value").write.option("compression", LINES).text(path)
    return files


@query("stream_to_silver", "SELECT order_id, user_id_hash, status, total_cents, ts_ms AS cdc_ts_ms FROM latest")
def _stream_silver(spark, d):
    """Change lines to clean orders in micro-batches."""
    src, out, bad = scratch(spark, "topic"), scratch(spark, "silver"), scratch(spark, "dead-letters")
    files = topic(spark, d, src, 2)
    sl.run_batches(change_stream(spark, "text", src, per_trigger=files), sl.silver_sink(out, bad, t.SALT), scratch(spark, "ckpt"))
    return sl.read_streamed_silver(spark, out).select("order_id", "user_id_hash", "status", "total_cents", "cdc_ts_ms")


@query("stream_alert_log", COOL.format(threshold=THRESHOLD, op=">", gap=COOLDOWN * 1_000_000).replace(
    "SELECT c.event_id, c.user_id_hash FROM", "SELECT 'churn' AS alert_type, 'warning' AS severity, 'High churn risk: user ' || c.user_id_hash[1:16] || '…' AS title, make_timestamp(c.t) AS fired_at FROM"))
def _stream_alerts(spark, d):
    """Alert records of the keyed state, appended as JSON lines per micro-batch."""
    log = scratch(spark, "alerts")
    stream = sl.stream_user_state(sl.stream_validate_enrich(live_stream(spark, d)), THRESHOLD, COOLDOWN)
    sl.run_batches(stream.filter("order_id <> 'sentinel'"), sl.alert_sink(log), scratch(spark, "ckpt"))
    schema = "alert_type string, severity string, title string, body string, data string, fired_at timestamp"
    return spark.read.schema(schema).option("recursiveFileLookup", "true").json(log).select("alert_type", "severity", "title", "fired_at")


# --- streams over several micro-batches, with rows out of order

def batches(spark, path, parts):
    """Each frame of ``parts`` as one micro-batch, written to ``path`` in order; returns how many files a batch has. A part is as many files as the
    largest one needs, so that no task reads or writes more than ``ROWS_PER_FILE`` rows by much; files without rows fill up a part that lacks some."""
    files = max(1, -(-max(rows for _, rows in parts) // ROWS_PER_FILE))
    done = 0
    for frame, _ in parts:
        frame.repartition(files).write.mode("append").option("compression", sinks.STORED).parquet(path)
        done += files
        while len(spark.read.schema(frame.schema).parquet(path).inputFiles()) < done:
            spark.createDataFrame([], frame.schema).write.mode("append").parquet(path)
    return files


def arrivals(spark, rows, files=4, jitter_seconds=0, key="event_id", last=True, then=None):
    """``rows`` in order of arrival, one micro-batch for each of ``files`` parts: their time plus up to ``jitter_seconds``, so a row is at most so late. A
    far-future row closes all; rows of ``then`` come after it."""
    path, staged = scratch(spark, "arrivals"), scratch(spark, "staged")
    jitter = F.pmod(F.xxhash64(key), F.lit(jitter_seconds)) * 1_000_000 if jitter_seconds else F.lit(0)
    at = F.coalesce((F.unix_micros("occurred_at") + jitter).cast("bigint"), F.lit(0))
    rows.withColumn("_at", at).write.option("compression", sinks.STORED).parquet(staged)  # the rows may come from a long plan, which the cuts and parts would each run again
    placed = spark.read.schema(rows.withColumn("_at", at).schema).parquet(staged)
    cuts = [float("-inf"), *placed.approxQuantile("_at", [i / files for i in range(1, files)], 0.01), float("inf")]
    part = sum((F.col("_at") > c).cast("int") for c in cuts[1:-1]) if files > 1 else F.lit(0)
    with shuffles_dropped(spark):
        sizes = {r["part"]: r["count"] for r in placed.groupBy(part.alias("part")).count().collect()}
    parts = [(placed.where(part == i).drop("_at"), sizes.get(i, 0)) for i in range(files)]
    if last:
        only = {"occurred_at": F.lit(END).cast("timestamp")}
        end = spark.range(1).select(*[(only[c] if c in only else F.lit("sentinel") if ty == "string" else F.lit(None)).cast(ty).alias(c) for c, ty in rows.dtypes])
        parts.append((end, 1))
    if then is not None:
        parts.append((then, then.count()))
    with shuffles_dropped(spark):
        files = batches(spark, path, parts)
    delete_folder(spark, staged)
    sl.use_rocksdb(spark)
    return sl.read_live(spark, path, rows.schema, per_trigger=files)


KPI_CHANGES = """WITH s AS (SELECT {key}epoch_us(occurred_at) // 1000000 + 1 AS e, sum(total_cents) AS v, count(*) AS n FROM live_ok GROUP BY ALL),
    u AS (SELECT *, FALSE AS tick FROM s UNION ALL SELECT DISTINCT {key}e + o, 0, 0, TRUE FROM s, (VALUES (0), (5), (60), (300)) x(o)),
    w AS (SELECT {key}e, tick, sum(v) OVER (p RANGE BETWEEN 59 PRECEDING AND CURRENT ROW) AS a, sum(v) OVER (p RANGE BETWEEN 299 PRECEDING AND CURRENT ROW) AS b,
        sum(n) OVER (p RANGE BETWEEN 59 PRECEDING AND CURRENT ROW) AS c, sum(n) OVER (p RANGE BETWEEN 4 PRECEDING AND CURRENT ROW) AS d FROM u WINDOW p AS ({part}ORDER BY e))
    SELECT {key}make_timestamp(e * 1000000) AS at, CAST(a AS BIGINT) AS revenue_60s_cents, CAST(b AS BIGINT) AS revenue_300s_cents, CAST(c AS BIGINT) AS orders_60s,
    round(d / 5.0::DOUBLE, 2) AS events_per_second FROM w WHERE tick"""


def kpi_stream(spark, d, keys=None):
    rows = valid(spark, d).select("event_id", "channel", "total_cents", "occurred_at")
    out = run(spark, sk.stream_trailing_kpis(arrivals(spark, rows, jitter_seconds=86_400), keys, "1 day"))
    return out.filter(F.col("at") < "2029-01-01")


@query("stream_trailing_kpis", KPI_CHANGES.format(key="", part=""))
def _stream_trailing(spark, d):
    """KPIs of 5, 60 and 300 s at every second that changes one, over five micro-batches with rows up to a day out of order."""
    return kpi_stream(spark, d)


@query("stream_trailing_kpis_by_channel", KPI_CHANGES.format(key="channel, ", part="PARTITION BY channel "))
def _stream_trailing_by_channel(spark, d):
    return kpi_stream(spark, d, ["channel"])


@query("trailing_kpis", KPI_CHANGES.format(key="", part=""))
def _trailing_kpis(spark, d):
    """The same in one batch, from events moved to the end of their second."""
    second = F.timestamp_seconds(F.floor(F.unix_micros("occurred_at") / F.lit(1_000_000)) + 1)
    return lv.trailing_revenue(valid(spark, d).withColumn("occurred_at", second), every_change=True)


CHURN_RULE, DISPATCH_COOLDOWN = 0.255, 7 * 86_400
DISPATCHED = f"""WITH RECURSIVE c AS (SELECT 'churn' AS alert_type, user_id_hash[1:16] AS entity, epoch_us(occurred_at) AS t, event_id FROM scored WHERE churn_score >= {CHURN_RULE}
        UNION ALL SELECT 'anomaly_high_value', 'high_value', epoch_us(occurred_at), event_id FROM live_ok WHERE total_cents > 20000),
    chain AS (SELECT alert_type, entity, min(t) AS t FROM c GROUP BY 1, 2
        UNION ALL SELECT k.alert_type, k.entity, (SELECT min(c.t) FROM c WHERE c.alert_type = k.alert_type AND c.entity = k.entity AND c.t >= k.t + {DISPATCH_COOLDOWN * 1_000_000}) FROM chain k WHERE k.t IS NOT NULL),
    told AS (SELECT c.alert_type, c.entity, c.event_id, CASE WHEN k.t IS NULL THEN 'suppressed' ELSE 'sent' END AS outcome FROM c LEFT JOIN chain k USING (alert_type, entity, t))
    """


def dispatched(spark, d):
    """Both logs, from candidates of two rules that arrive in four files, up to a day out of order."""
    log = scratch(spark, "dispatch")
    candidates = sa.churn_candidates(scored(spark, d), CHURN_RULE).unionByName(sa.anomaly_candidates(enriched(spark, d)))
    rows = candidates.withColumnRenamed("fired_at", "occurred_at")
    stream = arrivals(spark, rows, jitter_seconds=86_400).withColumnRenamed("occurred_at", "fired_at")
    sl.run_batches(sa.dispatch(stream, DISPATCH_COOLDOWN, "1 day").where("alert_type <> 'sentinel'"), sa.alert_logs(log), scratch(spark, "ckpt"))
    return log


@query("stream_alert_dispatch", DISPATCHED + "SELECT * FROM told")
def _stream_dispatch(spark, d):
    log = dispatched(spark, d)
    parts = [sa.read_alert_log(spark, log, o).select("alert_type", "entity", "event_id", F.lit(o).alias("outcome")) for o in ("sent", "suppressed")]
    return parts[0].unionByName(parts[1])


@query("stream_alert_counters", DISPATCHED + "SELECT alert_type, CAST(count_if(outcome = 'sent') AS BIGINT) AS alerts_sent, CAST(count_if(outcome = 'suppressed') AS BIGINT) AS alerts_suppressed FROM told GROUP BY 1")
def _stream_counters(spark, d):
    return sa.alert_counters(spark, dispatched(spark, d))


# Every 50th click comes in the last file, far behind the watermark; every 10th has no session.
LATE = "k % 50 = 7"


@query("stream_sessions_late", f"""SELECT event_id FROM clicks WHERE {LATE}""")
def _stream_late_sessions(spark, d):
    """Rows that come after their watermark, kept beside the sessions."""
    return _sessions(spark, d)[1].select("event_id")


@query("stream_sessions", f"""WITH placed AS (SELECT * FROM clicks WHERE k % 50 <> 7 AND k % 10 <> 0),
    gaps AS (SELECT *, CASE WHEN epoch_us(occurred_at) - epoch_us(lag(occurred_at) OVER s) > 1800000000 THEN 1 ELSE 0 END AS fresh FROM placed WINDOW s AS (PARTITION BY session_id ORDER BY occurred_at, event_id)),
    seq AS (SELECT *, sum(fresh) OVER (PARTITION BY session_id ORDER BY occurred_at, event_id ROWS UNBOUNDED PRECEDING) AS q FROM gaps)
    SELECT session_id, min(occurred_at) AS session_start, max(occurred_at) AS session_end, count(*) AS event_count, CAST(count_if(event_type = 'page_view') AS BIGINT) AS page_views,
    bool_or(event_type = 'purchase') AS converted, arg_min(user_id_hash, (occurred_at, event_id)) AS user_id_hash, arg_min(page_url, (occurred_at, event_id)) AS entry_page,
    arg_max(page_url, (occurred_at, event_id)) AS exit_page FROM seq GROUP BY session_id, q""")
def _stream_sessions_kept(spark, d):
    return _sessions(spark, d)[0].select("session_id", "session_start", "session_end", "event_count", "page_views", "converted", "user_id_hash", "entry_page", "exit_page")


def _sessions(spark, d):
    """Sessions and late rows of clicks in five files, rows up to an hour out of order; the late ones come last of all."""
    out = scratch(spark, "sessions")
    rows = t.clicks(spark, d).withColumn("k", F.col("event_id").cast("bigint"))
    rows = rows.withColumn("session_id", F.when((F.col("k") % 10 != 0) | (F.col("k") % 50 == 7), F.col("session_id")))
    late = (F.col("k") % 50) == 7
    stream = arrivals(spark, rows.where(~late).drop("k"), jitter_seconds=3_600, then=rows.where(late).drop("k"))
    sl.run_batches(ss.stream_sessions(stream, watermark="1 hour"), ss.session_sink(out), scratch(spark, "ckpt"))
    return tuple(spark.read.option("recursiveFileLookup", "true").parquet(f"{out}/{part}").filter("session_id <> 'sentinel'") for part in ("sessions", "late"))


@query("stream_user_totals", f"""WITH RECURSIVE c AS (SELECT user_id_hash, epoch_us(occurred_at) AS t FROM scored WHERE churn_score >= {THRESHOLD}),
    chain AS (SELECT user_id_hash, min(t) AS t FROM c GROUP BY 1
        UNION ALL SELECT k.user_id_hash, (SELECT min(c.t) FROM c WHERE c.user_id_hash = k.user_id_hash AND c.t > k.t + {COOLDOWN * 1_000_000}) FROM chain k WHERE k.t IS NOT NULL)
    SELECT event_id, order_count, total_spend, refunds, first_seen, previous_seen, churn_score, k.t IS NOT NULL AS alert
    FROM scored s LEFT JOIN chain k ON s.user_id_hash = k.user_id_hash AND epoch_us(s.occurred_at) = k.t""")
def _stream_totals(spark, d):
    """Running user state carried through four micro-batches, in two levels."""
    path = scratch(spark, "users")
    stream = arrivals(spark, enriched(spark, d), last=False)
    sl.run_batches(stream, su.user_totals_sink(spark, path, THRESHOLD, COOLDOWN, ttl_seconds=10_000 * 86_400), scratch(spark, "ckpt"))
    return su.read_user_rows(spark, path).select("event_id", "order_count", "total_spend", "refunds", "first_seen", "previous_seen", "churn_score", "alert")


@query("stream_hourly_bronze", """SELECT CAST(date_part('year', ts) AS INT) AS year, CAST(date_part('month', ts) AS INT) AS month, CAST(date_part('day', ts) AS INT) AS day,
    CAST(date_part('hour', ts) AS INT) AS hour, count(*) AS n FROM events GROUP BY 1, 2, 3, 4""")
def _stream_bronze(spark, d):
    """Events by their own hour from four micro-batches with rows out of order, each written twice."""
    path = scratch(spark, "hourly")
    rows = t.live_orders(spark, d).select("event_id", "order_id", "occurred_at", F.unix_millis("occurred_at").alias("ts_ms"))
    stream = arrivals(spark, rows, jitter_seconds=86_400, last=False)
    sink = lk.hourly_bronze_sink(path)

    def each(batch, batch_id):
        sink(batch, batch_id)
        sink(batch, batch_id)
    sl.run_batches(stream, each, scratch(spark, "ckpt"))
    return spark.read.parquet(path).groupBy(*[F.col(c).cast("int").alias(c) for c in sinks.HOUR]).agg(F.count(F.lit(1)).alias("n"))


@query("stream_silver_lake", "SELECT order_id, user_id_hash, status, total_cents, ts_ms AS cdc_ts_ms FROM latest")
def _stream_lake(spark, d):
    """Change lines to clean orders in three micro-batches, each merged into its buckets; read without deduplicating."""
    src = scratch(spark, "topic")
    files = topic(spark, d, src, 3, early=True)
    lake = lk.SilverLake(spark, scratch(spark, "lake"), t.SALT)
    sl.run_batches(change_stream(spark, "text", src, per_trigger=files), lake.sink(), scratch(spark, "ckpt"))
    return lake.read(spark).select("order_id", "user_id_hash", "status", "total_cents", "cdc_ts_ms")
