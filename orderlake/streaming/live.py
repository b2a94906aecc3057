"""Structured Streaming forms of the live operators.

All use event time with a watermark. Sources bound a micro-batch (files or offsets per trigger), state lives in RocksDB, and
every sink is idempotent per batch id, so a restart from the checkpoint repeats nothing.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from orderlake.functions.columns import dollars_text
from orderlake.operators.clicks import missing_session
from orderlake.operators.live import HIGH_VALUE_CENTS, enrich_live, high_value_orders, ring_trim, valid_live, validate_live
from orderlake.operators.orders import SILVER_COLUMNS, dead_letter_split, dedup_latest, parse_json_lines
from orderlake.session import ROCKSDB
from orderlake.sources.sinks import JSON_TIME

WATERMARK = "10 minutes"


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def read_live(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).format(fmt).load(path)


def stream_validate_enrich(events: DataFrame) -> DataFrame:
    rows = enrich_live(valid_live(events))
    return rows.withColumn("is_anomaly", F.col("total_cents") > HIGH_VALUE_CENTS)


def stream_rejected(events: DataFrame) -> DataFrame:
    return validate_live(events).filter(F.size("errors") > 0)


def stream_anomalies(events: DataFrame) -> DataFrame:
    return high_value_orders(valid_live(events))


def stream_dedup(events: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    return events.withWatermark("occurred_at", watermark).dropDuplicatesWithinWatermark(["order_id"])


def stream_revenue_buckets(events: DataFrame, seconds: int = 1, watermark: str = WATERMARK) -> DataFrame:
    w = F.window("occurred_at", f"{seconds} seconds")
    return events.withWatermark("occurred_at", watermark).groupBy(w).agg(
        F.sum("total_cents").alias("revenue_cents"), F.count(F.lit(1)).alias("orders"))


def bucket_columns(buckets: DataFrame) -> DataFrame:
    return buckets.select(F.col("window.start").alias("bucket_start"), "revenue_cents", "orders")


def stream_kpis(events: DataFrame, window_seconds: int = 60, slide_seconds: int = 1, watermark: str = WATERMARK) -> DataFrame:
    """Sliding totals over one-second (or slide-wide) buckets, so an event is expanded once per bucket and not once per window."""
    buckets = stream_revenue_buckets(events, slide_seconds, watermark)
    sliding = F.window(F.window_time("window"), f"{window_seconds} seconds", f"{slide_seconds} seconds")
    return buckets.groupBy(sliding.alias("w")).agg(
        F.sum("revenue_cents").alias("revenue_cents"), F.sum("orders").alias("orders")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "revenue_cents", "orders")


def stream_burst_detect(events: DataFrame, seconds: int = 1, at_least: int = 5, watermark: str = WATERMARK) -> DataFrame:
    return bucket_columns(stream_revenue_buckets(events, seconds, watermark)).filter(F.col("orders") >= at_least)


def stream_sessionize(clicks: DataFrame, idle: str = "30 minutes", watermark: str = WATERMARK) -> DataFrame:
    """Live sessions; ``occurred_at`` must be a timestamp here (unreadable times go to the dead letters first).

    Rows without a ``session_id`` go to ``missing_session_sink``; rows behind the watermark are counted by ``late_rows``.
    """
    order = F.struct("occurred_at", "event_id")

    def is_type(name: str):
        return F.count_if(F.col("event_type") == name)

    grouped = clicks.filter("session_id is not null").withWatermark("occurred_at", watermark).groupBy(
        F.session_window("occurred_at", idle).alias("w"), "session_id")
    return grouped.agg(
        F.min_by("user_id_hash", order).alias("user_id_hash"),
        F.min("occurred_at").alias("session_start"), F.max("occurred_at").alias("session_end"),
        F.count(F.lit(1)).alias("event_count"), is_type("page_view").alias("page_views"), is_type("product_view").alias("product_views"),
        is_type("add_to_cart").alias("add_to_cart_count"), is_type("search").alias("search_count"),
        (is_type("purchase") > 0).alias("converted"),
        F.min_by("page_url", order).alias("entry_page"), F.max_by("page_url", order).alias("exit_page"),
    ).withColumn("duration_seconds", ((F.unix_micros("session_end") - F.unix_micros("session_start")) / F.lit(1_000_000)).cast("bigint")).drop("w")


class UserState(StatefulProcessor):
    """Per-user totals, score and alert cooldown.

    Rows of a user inside a micro-batch are put in (time, event) order first; the source's rate limit bounds how many there are.
    """

    STATE = "orders bigint, spend bigint, refunds bigint, first_us bigint, last_us bigint, alert_us bigint, channels string"

    def __init__(self, threshold: float, cooldown_seconds: int, inclusive: bool, faithful: bool):
        self.threshold = threshold
        self.need = cooldown_seconds * 1_000_000 + (0 if inclusive else 1)
        self.faithful = faithful

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("user", self.STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows)).sort_values(["t", "event_id"], kind="stable")
        orders, spend, refunds, first, last, alert, channels = (
            self.state.get() if self.state.exists() else (0, 0, 0, None, None, None, "[]"))
        channels = json.loads(channels)
        times = pdf["t"].to_numpy(dtype="int64")
        count = orders + np.arange(1, len(pdf) + 1)
        spent = spend + pdf["total_cents"].to_numpy(dtype="int64").cumsum()
        refunded = refunds + pdf["is_refunded"].to_numpy(dtype="int64").cumsum()
        before = np.append(times[0] if last is None else last, times[:-1])
        days = np.zeros(len(pdf)) if self.faithful else (times - before) / 86_400_000_000.0
        average = spent / count
        recency = np.select([days > 90, days > 60, days > 30], [1.0, 0.7, 0.4], 0.1)
        monetary = np.select([average < 1000, average < 5000], [0.6, 0.3], 0.1)
        score = np.minimum(1.0, 0.5 * recency + 0.3 * np.maximum(0.0, 1.0 - count * 0.1) + 0.2 * monetary)
        fired = np.zeros(len(pdf), dtype=bool)
        for i in np.flatnonzero(score >= self.threshold):
            if alert is None or times[i] >= alert + self.need:
                fired[i], alert = True, int(times[i])
        listed = []
        for channel in pdf["channel"]:
            if channel and channel not in channels:
                channels = [*channels, channel]
            listed.append(",".join(channels))
        self.state.update((int(count[-1]), int(spent[-1]), int(refunded[-1]), int(first if first is not None else times[0]),
                           int(times[-1]), alert, json.dumps(channels)))
        yield pd.DataFrame({
            "event_id": pdf["event_id"], "order_id": pdf["order_id"], "user_id_hash": key[0], "t": times, "order_count": count,
            "total_spend": spent, "refunds": refunded, "channels": listed, "churn_score": score, "alert": fired})

    def close(self) -> None:
        pass


def stream_user_state(orders: DataFrame, threshold: float = 0.7, cooldown_seconds: int = 120, inclusive: bool = False,
                      faithful: bool = False) -> DataFrame:
    """Each valid, enriched order with its user's running state, score and whether an alert fires. Needs the RocksDB store."""
    rows = orders.select("event_id", "order_id", "user_id_hash", F.unix_micros("occurred_at").alias("t"), "total_cents", "is_refunded", "channel")
    out = ("event_id string, order_id string, user_id_hash string, t bigint, order_count bigint, total_spend bigint, refunds bigint, "
           "channels string, churn_score double, alert boolean")
    state = rows.groupBy("user_id_hash").transformWithStateInPandas(
        UserState(threshold, cooldown_seconds, inclusive, faithful), outputStructType=out, outputMode="append", timeMode="none")
    return state.withColumns({"occurred_at": F.timestamp_micros("t"), "churn_score": F.round("churn_score", 4)}).drop("t")


def alert_records(state: DataFrame) -> DataFrame:
    """Alert log rows (type, severity, title, body, data, fired_at) for fired alerts."""
    prefix = F.substring("user_id_hash", 1, 16)
    percent = F.format_string("%.0f%%", F.col("churn_score") * F.lit(100.0))
    spend = dollars_text("total_spend")
    return state.filter("alert").select(
        F.lit("churn").alias("alert_type"), F.lit("warning").alias("severity"), F.concat(F.lit("High churn risk: user "), prefix, F.lit("…")).alias("title"),
        F.concat(F.lit("Churn probability: "), percent, F.lit(" | Orders: "), F.col("order_count"), F.lit(" | Lifetime spend: "), spend).alias("body"),
        F.to_json(F.struct(prefix.alias("user_prefix"), F.col("churn_score").alias("score"), F.col("order_count").alias("orders"), spend.alias("spend"))).alias("data"),
        F.col("occurred_at").alias("fired_at"))


def alert_counts(state: DataFrame, threshold: float) -> DataFrame:
    return state.agg(F.count_if("alert").alias("alerts_sent"),
                     F.count_if((F.col("churn_score") >= threshold) & ~F.col("alert")).alias("alerts_suppressed"))


def run_available(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", partition_by: list[str] | None = None, listener: LateRows | None = None) -> None:
    """Process everything that is there into an exactly-once file sink, then stop; ``listener`` is closed when it has heard of the end."""
    writer = stream.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.start()
    query.awaitTermination()
    if listener:
        listener.wait(str(query.runId))


class LateRows(StreamingQueryListener):
    """Adds up the rows that queries dropped behind their watermark, by run; every batch's progress counts, also of long runs."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.dropped, self.ended = spark, {}, {}
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        self.dropped[run] = self.dropped.get(run, 0) + sum(o.numRowsDroppedByWatermark for o in event.progress.stateOperators)

    def onQueryTerminated(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event()).set()

    def wait(self, run: str, seconds: float = 60) -> None:
        heard = self.ended.setdefault(run, threading.Event()).wait(seconds)
        self.spark.streams.removeListener(self)
        if not heard:
            raise TimeoutError(f"no end of run {run} was reported, so its late rows aren't known")

    def total(self) -> int:
        return sum(self.dropped.values())


def missing_session_sink(path: str):
    """Batch function: rows without a session as dead letters under the batch id (replacing a repeated batch)."""
    def each(batch: DataFrame, batch_id: int) -> None:
        missing_session(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return each


def run_batches(stream: DataFrame, each, checkpoint: str, interval: str | None = None):
    """``each(batch, batch_id)`` per micro-batch; without ``interval`` runs what is available and stops."""
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if interval:
        return writer.trigger(processingTime=interval).start()
    writer.trigger(availableNow=True).start().awaitTermination()
    return None


def recent_store(path: str, keep: int = 10_000):
    """Batch function keeping the newest ``keep`` orders; the first arrival of an order stays.

    Batches take turns with two slots: each reads the other slot and replaces its own, so a repeated batch is harmless and the store doesn't grow.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        arrived = Window.partitionBy("order_id").orderBy("occurred_at", F.xxhash64(*batch.columns))
        first = batch.withColumn("_place", F.row_number().over(arrived)).where("_place = 1").drop("_place")
        if batch_id > 0:
            held = spark.read.schema(batch.schema).parquet(f"{path}/slot={(batch_id - 1) % 2}")
            rows = held.unionByName(first.join(held.select("order_id"), "order_id", "left_anti"))
        else:
            rows = first
        ring_trim(rows, keep).withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(f"{path}/slot={batch_id % 2}")
    return each


def read_recent_store(spark: SparkSession, path: str) -> DataFrame:
    slots = spark.read.parquet(path)
    return slots.filter(F.col("batch_id") == slots.agg(F.max("batch_id")).scalar()).drop("batch_id", "slot")


def silver_sink(silver_path: str, dead_letter_path: str, salt: str):
    """Batch function for change lines: valid rows and rejects, each under the batch id (replacing a repeated batch)."""
    def each(batch: DataFrame, batch_id: int) -> None:
        lines = parse_json_lines(batch.select("value")).persist()
        try:
            valid, rejected = dead_letter_split(lines, salt)
            dedup_latest(valid).write.mode("overwrite").parquet(f"{silver_path}/batch_id={batch_id}")
            rejected.write.mode("overwrite").parquet(f"{dead_letter_path}/batch_id={batch_id}")
        finally:
            lines.unpersist()
    return each


def read_streamed_silver(spark: SparkSession, silver_path: str) -> DataFrame:
    return dedup_latest(spark.read.option("mergeSchema", "true").parquet(silver_path).select(*SILVER_COLUMNS))


def alert_sink(path: str):
    def each(batch: DataFrame, batch_id: int) -> None:
        alert_records(batch).write.mode("overwrite").option("timestampFormat", JSON_TIME).json(f"{path}/batch_id={batch_id}")
    return each
