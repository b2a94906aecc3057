"""Live sessions that keep their late rows.

Built-in windows drop rows behind the watermark without a trace. Here the keyed state sees every row, compares its time with the watermark, and hands
late ones on beside the sessions, so that events in sessions, late rows and rows without a session are together all that came in.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from orderlake.operators.clicks import IDLE_SECONDS, missing_session
from orderlake.streaming.frames import frame

TYPES = ("page_view", "product_view", "add_to_cart", "search", "purchase")
CLICK = "event_id string, user_id_hash string, event_type string, page_url string, t bigint"
OUT = f"session_id string, late boolean, {CLICK}, start_us bigint, end_us bigint, event_count bigint, " + ", ".join(f"{k} bigint" for k in TYPES) + ", entry_page string, exit_page string"
FIELDS = [f.split()[0] for f in OUT.split(", ")]


def _runs(pdf: pd.DataFrame, idle: int) -> Iterator[dict]:
    """Sessions within some rows of one key, as plain values."""
    pdf = pdf.sort_values(["t", "event_id"], kind="stable")
    times = pdf["t"].to_numpy(np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(times) > idle) + 1).tolist(), len(times)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        part = pdf.iloc[a:b]
        kinds = part["event_type"].value_counts()
        first, last = part.iloc[0], part.iloc[-1]
        yield {"n": b - a, "types": [int(kinds.get(k, 0)) for k in TYPES], "first": [int(first["t"]), first["event_id"], first["user_id_hash"], first["page_url"]],
               "last": [int(last["t"]), last["event_id"], last["page_url"]]}


def _joined(sessions: list[dict], idle: int) -> list[dict]:
    """Sessions that are no further apart than ``idle`` become one."""
    out: list[dict] = []
    for s in sorted(sessions, key=lambda s: s["first"][0]):
        if out and s["first"][0] - out[-1]["last"][0] <= idle:
            held = out[-1]
            out[-1] = {"n": held["n"] + s["n"], "types": [x + y for x, y in zip(held["types"], s["types"])],
                       "first": min(held["first"], s["first"], key=lambda f: (f[0], f[1] or "")), "last": max(held["last"], s["last"], key=lambda e: (e[0], e[1] or ""))}
        else:
            out.append(s)
    return out


class OpenSessions(StatefulProcessor):
    """Sessions of one key that the watermark hasn't closed. Rows are reduced Arrow batch by Arrow batch, so a key with very many rows in a
    micro-batch never stands in memory; what is kept is one record per open session."""

    def __init__(self, idle_seconds: int):
        self.idle = idle_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("open", "sessions string")

    def _store(self, sessions: list[dict]) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if sessions:
            self.state.update((json.dumps(sessions),))
            # Closed when the watermark is past the last time a further row could have.
            self.handle.registerTimer(min(s["last"][0] for s in sessions) // 1000 + self.idle // 1000 + 1)
        elif self.state.exists():
            self.state.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        sessions = json.loads(self.state.get()[0]) if self.state.exists() else []
        for pdf in rows:
            pdf = pdf.astype(object).where(pdf.notna(), None)
            late = pdf["t"].astype("int64") < watermark
            if late.any():
                behind = {c: pdf.loc[late, c] for c in ("event_id", "user_id_hash", "event_type", "page_url", "t")}
                yield frame(FIELDS, {"session_id": [key[0]] * int(late.sum()), "late": [True] * int(late.sum()), **behind})
            if not late.all():
                sessions = _joined([*sessions, *_runs(pdf[~late], self.idle)], self.idle)
        self._store(sessions)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs() * 1000
        sessions = json.loads(self.state.get()[0]) if self.state.exists() else []
        closed = [s for s in sessions if s["last"][0] + self.idle < watermark]
        self._store([s for s in sessions if s["last"][0] + self.idle >= watermark])
        yield frame(FIELDS, {
            "session_id": [key[0]] * len(closed), "late": [False] * len(closed), "user_id_hash": [s["first"][2] for s in closed], "start_us": [s["first"][0] for s in closed],
            "end_us": [s["last"][0] for s in closed], "event_count": [s["n"] for s in closed], **{k: [s["types"][i] for s in closed] for i, k in enumerate(TYPES)},
            "entry_page": [s["first"][3] for s in closed], "exit_page": [s["last"][2] for s in closed]})

    def close(self) -> None:
        pass


def stream_sessions(clicks: DataFrame, idle_seconds: int = IDLE_SECONDS, watermark: str = "10 minutes") -> DataFrame:
    """Closed sessions and, with ``late`` set, rows behind the watermark, in one stream (see ``session_sink``). ``occurred_at`` is a timestamp.

    Rows without a session or a time aren't taken; ``session_sink`` writes the former from the same batch. Needs the RocksDB store.
    """
    # The time goes on as a number: a column that carries the watermark would make the engine drop late rows before the state sees them.
    rows = clicks.where("session_id is not null and occurred_at is not null").withWatermark("occurred_at", watermark).select(
        "session_id", "event_id", "user_id_hash", "event_type", "page_url", F.unix_micros("occurred_at").alias("t"))
    out = rows.groupBy("session_id").transformWithStateInPandas(OpenSessions(idle_seconds), outputStructType=OUT, outputMode="append", timeMode="EventTime")
    return out


def session_sink(path: str):
    """Batch function for ``stream_sessions``: sessions and late rows in two tables, each under the batch id, so a repeated batch changes nothing."""
    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            sessions = batch.where("not late").select(
                "session_id", "user_id_hash", F.timestamp_micros("start_us").alias("session_start"), F.timestamp_micros("end_us").alias("session_end"),
                ((F.col("end_us") - F.col("start_us")) / F.lit(1_000_000)).cast("bigint").alias("duration_seconds"), "event_count", F.col("page_view").alias("page_views"),
                F.col("product_view").alias("product_views"), F.col("add_to_cart").alias("add_to_cart_count"), F.col("search").alias("search_count"),
                (F.col("purchase") > 0).alias("converted"), "entry_page", "exit_page")
            sessions.write.mode("overwrite").parquet(f"{path}/sessions/batch_id={batch_id}")
            late = batch.where("late").select("event_id", "session_id", "user_id_hash", "event_type", "page_url", F.timestamp_micros("t").alias("occurred_at"))
            late.write.mode("overwrite").parquet(f"{path}/late/batch_id={batch_id}")
        finally:
            batch.unpersist()
    return each


def unplaced(clicks: DataFrame) -> DataFrame:
    """Rows that ``stream_sessions`` doesn't take: without a session, or without a time."""
    return missing_session(clicks).unionByName(clicks.where("session_id is not null and occurred_at is null"))
