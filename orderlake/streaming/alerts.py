"""Alert dispatcher: several rules into one state, with a cooldown per (type, entity) and two logs.

Candidates wait in the state until the watermark has passed their time, so decisions are made in event time and don't depend on how rows were cut into
micro-batches. An alert is sent if the cooldown since the last *sent* one of its key is over, else it is suppressed; forced alerts are always
sent and leave the cooldown alone.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from orderlake.functions.columns import dollars_text
from orderlake.operators.live import HIGH_VALUE_CENTS
from orderlake.sources.sinks import JSON_TIME
from orderlake.streaming.frames import frame

CHURN_FROM = 0.80
COOLDOWN_SECONDS = 300
BUCKETS = 64
RECORD = ["alert_type", "entity", "severity", "title", "body", "data", "forced", "event_id", "fired_at"]


def _record(rows: DataFrame, kind: Column, entity: Column, severity: str, title: Column, body: Column, data: Column, ts: str) -> DataFrame:
    return rows.select(kind.alias("alert_type"), entity.alias("entity"), F.lit(severity).alias("severity"), title.alias("title"), body.alias("body"),
                       F.to_json(data).alias("data"), F.lit(False).alias("forced"), "event_id", F.col(ts).alias("fired_at"))


def churn_candidates(scored: DataFrame, threshold: float = CHURN_FROM) -> DataFrame:
    """Rows of users whose score reaches the threshold; the entity is the shown prefix of the user."""
    prefix, spend = F.substring("user_id_hash", 1, 16), dollars_text("total_spend")
    percent = F.format_string("%.0f%%", F.col("churn_score") * F.lit(100.0))
    return _record(
        scored.where(F.col("churn_score") >= threshold), F.lit("churn"), prefix, "warning", F.concat(F.lit("High churn risk: user "), prefix, F.lit("…")),
        F.concat(F.lit("Churn probability: "), percent, F.lit(" | Orders: "), F.col("order_count"), F.lit(" | Lifetime spend: "), spend),
        F.struct(prefix.alias("user_prefix"), F.col("churn_score").alias("score"), F.col("order_count").alias("orders"), spend.alias("spend")), "occurred_at")


def anomaly_candidates(orders: DataFrame, kind: str = "high_value", condition: Column | None = None) -> DataFrame:
    """Rows that meet ``condition`` (by default totals over the high-value bound); one entity per kind, so the cooldown holds for the kind."""
    details = F.concat(F.lit("Order "), F.substring("order_id", 1, 8), F.lit(" over "), dollars_text("total_cents"))
    rows = orders.where(F.col("total_cents") > HIGH_VALUE_CENTS if condition is None else condition)
    return _record(rows, F.lit(f"anomaly_{kind}"), F.lit(kind), "warning", F.lit(f"Anomaly detected: {kind}"), details,
                   F.struct(F.lit(kind).alias("type"), details.alias("details")), "occurred_at")


def stall_candidates(depths: DataFrame, threshold: int) -> DataFrame:
    """Rows ``queue, depth, event_id, occurred_at`` of queues deeper than the threshold."""
    depth = F.col("depth").cast("string")
    return _record(
        depths.where(F.col("depth") > threshold), F.lit("pipeline_stall"), F.col("queue"), "critical", F.concat(F.lit("Queue stall: "), "queue"),
        F.concat(F.lit("Queue depth "), depth, F.lit(f" exceeds threshold {threshold}")),
        F.struct("queue", "depth", F.lit(threshold).alias("threshold")), "occurred_at")


class Dispatcher(StatefulProcessor):
    """Per bucket of (type, entity) pairs: candidates not decided yet, and the time of the last sent one of each pair, which is forgotten when its cooldown is over.

    Candidates wait as Arrow data, so a bucket costs a few calls to the state store in a batch, however many pairs and rows it holds.
    """

    ROW = "t bigint, event_id string, forced boolean, severity string, title string, body string, data string"
    NAMES = ["alert_type", "entity", *(f.split()[0] for f in ROW.split(", "))]
    FIELDS = pa.schema([(n, pa.int64() if n == "t" else pa.bool_() if n == "forced" else pa.string()) for n in NAMES])
    CHUNK = 20_000

    def __init__(self, cooldown_seconds: int):
        self.need = cooldown_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "least bigint, rows binary")
        self.sent = handle.getValueState("sent", "pairs binary")

    def _wake(self, at_us: int) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(-(-at_us // 1000))

    def _chunks(self, rows: pa.Table) -> list[tuple[int, bytes]]:
        out = []
        for start in range(0, len(rows), self.CHUNK):
            part, sink = rows.slice(start, self.CHUNK).combine_chunks(), pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, self.FIELDS) as writer:
                writer.write_table(part)
            out.append((pc.min(part["t"]).as_py(), sink.getvalue().to_pybytes()))
        return out

    def _sent(self) -> dict[tuple, int]:
        return {(kind, entity): t for kind, entity, t in json.loads(self.sent.get()[0])} if self.sent.exists() else {}

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pa.concat_tables([pa.table({n: pa.array(pdf[n].astype(object).where(pdf[n].notna(), None), f.type, from_pandas=True)
                                          for n, f in zip(self.NAMES, self.FIELDS)}, self.FIELDS) for pdf in rows])
        if new["t"].null_count:
            raise ValueError("a candidate without a time")
        chunks = self._chunks(new)
        earlier = [at for (at,) in [r[:1] for r in self.waiting.get()]] if self.waiting.exists() else []
        self.waiting.appendList(chunks)
        expiries = [t + self.need for t in self._sent().values()]
        self._wake(min([*earlier, *expiries, *(at for at, _ in chunks)]))
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        held = [pa.ipc.open_stream(r[1]).read_all() for r in self.waiting.get()] if self.waiting.exists() else []
        rows = pa.concat_tables(held) if held else self.FIELDS.empty_table()
        due = pc.less_equal(rows["t"], now)
        ready, rest = rows.filter(due), rows.filter(pc.invert(due))
        ready = ready.append_column("_tie", pc.fill_null(ready["event_id"], "")).sort_by([("t", "ascending"), ("_tie", "ascending")]).drop_columns("_tie")
        last, outcomes = self._sent(), []
        told = {n: ready[n].to_pylist() for n in self.NAMES}
        for kind, entity, t, forced in zip(told["alert_type"], told["entity"], told["t"], told["forced"]):
            before = last.get((kind, entity))
            free = bool(forced) or before is None or t - before >= self.need
            outcomes.append("sent" if free else "suppressed")
            if free and not forced:
                last[kind, entity] = t
        open_pairs = set(zip(rest["alert_type"].to_pylist(), rest["entity"].to_pylist()))
        last = {pair: t for pair, t in last.items() if pair in open_pairs or t + self.need > now}
        if len(rest):
            self.waiting.put(self._chunks(rest))
        else:
            self.waiting.clear()
        if last:
            self.sent.update((json.dumps([[*pair, t] for pair, t in last.items()]).encode(),))
        elif self.sent.exists():
            self.sent.clear()
        # A pair with rows to come is looked at again when they are due.
        wakes = [t + self.need for pair, t in last.items() if pair not in open_pairs]
        if len(rest):
            wakes.append(pc.min(rest["t"]).as_py())
        if wakes:
            self._wake(min(wakes))
        yield frame([*self.NAMES, "outcome"], {**told, "outcome": outcomes})

    def close(self) -> None:
        pass


def dispatch(candidates: DataFrame, cooldown_seconds: int = COOLDOWN_SECONDS, watermark: str = "10 minutes", buckets: int = BUCKETS) -> DataFrame:
    """Each candidate with its ``outcome``, ``sent`` or ``suppressed``; at exactly the cooldown an alert is sent again. Candidates without a time are left to
    the caller. What a bucket of pairs keeps is bounded by their candidates within the watermark's delay and their last sent ones; the number of
    buckets must stay while a checkpoint lives. Needs the RocksDB store."""
    names = Dispatcher.NAMES[3:]
    # The time goes on as a number, so a row later than the watermark isn't dropped; it is decided at once, against what was sent before.
    rows = candidates.withWatermark("fired_at", watermark).select(
        F.pmod(F.xxhash64("alert_type", "entity"), F.lit(buckets)).cast("int").alias("_bucket"), "alert_type", "entity", F.unix_micros("fired_at").alias("t"), *names)
    out = rows.groupBy("_bucket").transformWithStateInPandas(
        Dispatcher(cooldown_seconds), outputStructType=f"alert_type string, entity string, {Dispatcher.ROW}, outcome string", outputMode="append", timeMode="EventTime")
    return out.withColumn("fired_at", F.timestamp_micros("t")).select(*RECORD, "outcome")


def alert_logs(path: str):
    """Batch function: sent and suppressed alerts as JSON lines in two logs, each under the batch id, so a repeated batch changes nothing."""
    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for outcome in ("sent", "suppressed"):
                batch.where(F.col("outcome") == outcome).drop("outcome").write.mode("overwrite").option("timestampFormat", JSON_TIME).json(f"{path}/{outcome}/batch_id={batch_id}")
        finally:
            batch.unpersist()
    return each


def read_alert_log(spark, path: str, outcome: str) -> DataFrame:
    schema = "alert_type string, entity string, severity string, title string, body string, data string, forced boolean, event_id string, fired_at timestamp"
    return spark.read.schema(schema).option("recursiveFileLookup", "true").json(f"{path}/{outcome}")


def alert_counters(spark, path: str) -> DataFrame:
    """``alert_type, alerts_sent, alerts_suppressed`` of both logs."""
    both = read_alert_log(spark, path, "sent").withColumn("n", F.lit(1)).unionByName(read_alert_log(spark, path, "suppressed").withColumn("n", F.lit(0)))
    return both.groupBy("alert_type").agg(F.count_if(F.col("n") == 1).alias("alerts_sent"), F.count_if(F.col("n") == 0).alias("alerts_suppressed"))
