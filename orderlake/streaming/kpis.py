"""Live KPIs over 5, 60 and 300 seconds in one pass.

A windowed aggregate reduces events to one row per second and key, in parallel and with map-side totals; the keyed state then takes at most
one row per second, however many events arrive. It keeps a ring of the last 300 seconds, which feeds all three horizons.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from orderlake.streaming.frames import frame

HORIZONS = (5, 60, 300)
COLUMNS = "at_s bigint, revenue_60s_cents bigint, revenue_300s_cents bigint, orders_60s bigint, events_per_second double"


def changes(ends: np.ndarray, after: int, upto: int) -> np.ndarray:
    """Seconds in ``(after, upto]`` at which a total enters or leaves a horizon."""
    ticks = np.unique(np.concatenate([ends, *(ends + h for h in HORIZONS)])) if len(ends) else ends
    return ticks[(ticks > after) & (ticks <= upto)]


def totals(ends: np.ndarray, values: np.ndarray, ticks: np.ndarray, horizon: int) -> np.ndarray:
    """Sum of the seconds that end in ``(tick - horizon, tick]``; ``ends`` ascend."""
    upto = np.concatenate(([0], np.cumsum(values)))
    return upto[np.searchsorted(ends, ticks, "right")] - upto[np.searchsorted(ends, ticks - horizon, "right")]


class TrailingTotals(StatefulProcessor):
    """Rows ``end_s, cents, orders``, one per closed second, to the KPIs at every second at which one of them changes.

    A timer stands at the next such second. When the watermark has passed it, all seconds up to the watermark are told, in order, and seconds that no
    horizon can see any more leave the ring; so a key's state has at most 300 seconds and those not told yet.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ring = handle.getValueState("ring", "seconds binary, told bigint")

    def _load(self) -> tuple[np.ndarray, int]:
        if not self.ring.exists():
            return np.zeros((0, 3), np.int64), -(2**62)
        body, told = self.ring.get()
        return np.frombuffer(bytes(body), np.int64).reshape(-1, 3), told

    def _store(self, ring: np.ndarray, told: int) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        pending = changes(ring[:, 0], told, 2**62)
        if len(pending):
            self.ring.update((ring.tobytes(), told))
            self.handle.registerTimer(int(pending[0]) * 1000)
        else:
            self.ring.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        ring, told = self._load()
        new = [pdf[["end_s", "cents", "orders"]].to_numpy(np.int64) for pdf in rows]
        ring = np.concatenate([ring, *new])
        self._store(ring[np.argsort(ring[:, 0], kind="stable")], told)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        ring, told = self._load()
        now = timerValues.getCurrentWatermarkInMs() // 1000
        ends, cents, orders = ring.T
        ticks = changes(ends, told, now)
        out = {
            "at_s": ticks, "revenue_60s_cents": totals(ends, cents, ticks, 60), "revenue_300s_cents": totals(ends, cents, ticks, 300),
            "orders_60s": totals(ends, orders, ticks, 60), "events_per_second": np.round(totals(ends, orders, ticks, 5) / 5.0, 2)}
        self._store(ring[ends > now - max(HORIZONS)], now)
        told = {**{f"k{i}": [k] * len(ticks) for i, k in enumerate(key)}, **{c: v.tolist() for c, v in out.items()}}
        yield frame(list(told), told)

    def close(self) -> None:
        pass


def stream_trailing_kpis(events: DataFrame, keys: list[str] | None = None, watermark: str = "10 seconds") -> DataFrame:
    """``at`` and per key: revenue of the last 60 s and 300 s, orders of the last 60 s, events per second over 5 s, at every whole second at which one of
    them changes; between two rows of a key its KPIs hold. Equal to ``trailing_revenue(..., every_change=True)`` of the same events by whole seconds.

    Rows up to ``watermark`` out of order are in; the answer for a second comes once the watermark has passed it. Rows without a time are left out, as
    no window holds them. Needs the RocksDB store.
    """
    keys = keys or []
    second = F.window("occurred_at", "1 second")
    seconds = events.withWatermark("occurred_at", watermark).groupBy(second.alias("window"), *keys).agg(
        F.sum("total_cents").alias("cents"), F.count(F.lit(1)).alias("orders"))
    groups = [F.col(k).cast("string").alias(f"k{i}") for i, k in enumerate(keys)] or [F.lit("all").alias("k0")]
    rows = seconds.select(*groups, F.window_time("window").alias("closed"), F.unix_seconds(F.col("window.end")).alias("end_s"), F.coalesce("cents", F.lit(0)).alias("cents"), "orders")
    names = [f"k{i}" for i in range(len(groups))]
    told = rows.groupBy(*names).transformWithStateInPandas(
        TrailingTotals(), outputStructType=", ".join(f"{n} string" for n in names) + ", " + COLUMNS, outputMode="append", timeMode="EventTime")
    return told.select(*(F.col(n).alias(k) for n, k in zip(names, keys)), F.timestamp_seconds("at_s").alias("at"), *[c.split()[0] for c in COLUMNS.split(", ")[1:]])
