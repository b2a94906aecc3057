"""Batch forms of the live operators: enrichment, running user state, trailing totals, cooldowns, smoothing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from orderlake.functions import LIVE_STATUSES, churn_score, value_tier
from orderlake.functions.columns import dollars_text
from orderlake.operators.keyed import SLICE, map_groups, running_sums, time_slice

HIGH_VALUE_CENTS = 20_000
CHURN_ALERT_SCORE = 0.7
MICROS = 1_000_000


def validate_live(events: DataFrame, statuses: list[str] | None = None) -> DataFrame:
    statuses = LIVE_STATUSES if statuses is None else statuses
    total = F.coalesce(F.col("total_cents"), F.lit(0))
    problems = [
        F.when(F.coalesce("order_id", F.lit("")) == "", "missing order_id"),
        F.when(F.coalesce("user_id_hash", F.lit("")) == "", "missing user_id_hash"),
        F.when(total <= 0, F.concat(F.lit("invalid total_cents="), F.coalesce(F.col("total_cents").cast("string"), F.lit("None")))),
        F.when(~F.coalesce(F.col("status").isin(statuses), F.lit(False)),
               F.concat(F.lit("invalid status="), F.coalesce("status", F.lit("None")))),
    ]
    return events.withColumn("errors", F.array_compact(F.array(*problems)))


def valid_live(events: DataFrame, statuses: list[str] | None = None) -> DataFrame:
    return validate_live(events, statuses).filter(F.size("errors") == 0).drop("errors")


def enrich_live(events: DataFrame, processed_at: Column | None = None) -> DataFrame:
    rows = events.withColumns({
        "is_delivered": F.col("status") == "delivered",
        "is_refunded": F.col("status") == "refunded",
        "has_discount": F.coalesce("discount_cents", F.lit(0)) > 0,
        "value_tier": value_tier("total_cents"),
        "margin_cents": (F.col("total_cents") * F.lit(0.35)).cast("bigint"),
    })
    return rows if processed_at is None else rows.withColumn("processed_at", processed_at)


def high_value_orders(events: DataFrame) -> DataFrame:
    amount = dollars_text("total_cents")
    return events.filter(F.col("total_cents") > HIGH_VALUE_CENTS).select(
        F.lit("high_value_order").alias("type"), F.substring("order_id", 1, 8).alias("order_id"), amount.alias("amount"),
        F.concat(F.lit("High-value order: "), amount).alias("message"), F.col("occurred_at").alias("ts"))


def live_order_card(scored: DataFrame) -> DataFrame:
    return scored.select(
        F.concat(F.substring("order_id", 1, 8), F.lit("…")).alias("order_id"), "status", "total_cents", "channel", "churn_score",
        "value_tier", "sku", F.col("occurred_at").alias("ts"))


def event_envelope(rows: DataFrame, kind: str, ts: Column) -> DataFrame:
    """Messages ``{type, data, ts}`` as JSON text."""
    return rows.select(F.to_json(F.struct(F.lit(kind).alias("type"), F.struct(*rows.columns).alias("data"), ts.alias("ts"))).alias("value"))


def running_user_state(events: DataFrame, slice_seconds: int = 3600, earlier: DataFrame | None = None) -> DataFrame:
    """Each event with its user's totals so far, first and previous seen time, and channels in first-seen order.

    Two levels: totals per (user, time slice) are carried into the slice, and only rows of one slice are windowed together, so
    a user who owns a third of all events is spread over as many tasks as there are slices. The channel list is bounded by the
    number of channels.

    ``earlier`` has one row per user with totals from before these events (orders, spend, refunds, first_seen, last_seen, channels). They
    enter what is carried into the slices, so the events are not shuffled for them.
    """
    user, seq = "user_id_hash", ["occurred_at", "event_id"]
    rows = events.withColumn(SLICE, time_slice(F.col("occurred_at"), slice_seconds))
    named = F.coalesce("channel", F.lit("")) != ""
    parts = rows.groupBy(user, SLICE, "channel").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_cents").alias("spend"), F.count_if("is_refunded").alias("refunds"),
        F.min("occurred_at").alias("t0"), F.max("occurred_at").alias("t1"), F.min(F.struct(*seq)).alias("first"),
    ).repartition(user)
    first_slice = F.row_number().over(Window.partitionBy(user, "channel").orderBy(SLICE)) == 1
    slices = parts.withColumn("new", F.when(first_slice & named, F.struct("first", "channel"))).groupBy(user, SLICE).agg(
        *[F.sum(c).alias(c) for c in ("n", "spend", "refunds")], F.min("t0").alias("t0"), F.max("t1").alias("t1"),
        F.array_sort(F.collect_list("new")).alias("new"))
    before = Window.partitionBy(user).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    found = F.collect_list(F.when(F.size("new") > 0, F.col("new"))).over(before)
    carry = slices.select(
        user, SLICE, *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}") for c in ("n", "spend", "refunds")],
        F.min("t0").over(before).alias("_t0"), F.max("t1").over(before).alias("_t1"),
        F.transform(F.flatten(found), lambda x: x["channel"]).alias("_channels"))
    if earlier is not None:
        own = {"orders": "_n", "spend": "_spend", "refunds": "_refunds", "first_seen": "_t0", "last_seen": "_t1", "channels": "_channels"}
        carry = carry.join(earlier.select(user, *(F.col(c).alias(f"_earlier{n}") for c, n in own.items())), user, "left").select(
            user, SLICE, *[(F.col(n) + F.coalesce(f"_earlier{n}", F.lit(0))).alias(n) for n in ("_n", "_spend", "_refunds")],
            F.coalesce("_earlier_t0", "_t0").alias("_t0"), F.coalesce("_t1", "_earlier_t1").alias("_t1"),
            F.concat(F.coalesce("_earlier_channels", F.array().cast("array<string>")), "_channels").alias("_channels"))
    inside = Window.partitionBy(user, SLICE).orderBy(*seq)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fresh = F.row_number().over(Window.partitionBy(user, SLICE, "channel").orderBy(*seq)) == 1
    joined = rows.join(carry, [user, SLICE]).withColumn("_fresh", F.when(fresh & named, F.col("channel")))
    return joined.withColumns({
        "order_count": F.count(F.lit(1)).over(so_far) + F.col("_n"),
        "total_spend": F.sum("total_cents").over(so_far) + F.col("_spend"),
        "refunds": F.sum(F.col("is_refunded").cast("bigint")).over(so_far) + F.col("_refunds"),
        "first_seen": F.coalesce(F.col("_t0"), F.min("occurred_at").over(so_far)),
        "previous_seen": F.coalesce(F.lag("occurred_at").over(inside), F.col("_t1")),
        "channels": F.array_distinct(F.concat("_channels", F.collect_list("_fresh").over(so_far))),
    }).select(*events.columns, "order_count", "total_spend", "refunds", "first_seen", "previous_seen", "channels")


def state_score(faithful: bool = False) -> Column:
    """Score of a row of ``running_user_state``. Recency is the gap to the user's previous event; ``faithful`` uses zero,
    as a scorer does that marks the user seen before scoring."""
    gap = (F.unix_micros("occurred_at") - F.unix_micros("previous_seen")) / F.lit(86_400.0 * MICROS)
    days = F.lit(0.0) if faithful else F.coalesce(gap, F.lit(0.0))
    return churn_score(days, F.col("order_count"), F.col("total_spend") / F.col("order_count"))


def live_churn_score(state: DataFrame, faithful: bool = False) -> DataFrame:
    return state.withColumn("churn_score", F.round(state_score(faithful), 4))


def trailing_revenue(events: DataFrame, keys: list[str] | None = None, slice_seconds: int = 300, every_change: bool = False) -> DataFrame:
    """At every event time: revenue of the last 60 s and 300 s, orders of the last 60 s, events per second over 5 s. ``every_change`` adds the
    times at which events leave a window.

    Each time contributes its totals when it enters and takes them out when it leaves a window (an event exactly one window
    old has left), so the answer is one running sum however many events a window holds.
    """
    keys = keys or []
    moments = events.groupBy(*keys, F.unix_micros("occurred_at").alias("t")).agg(
        F.sum("total_cents").alias("v"), F.count(F.lit(1)).alias("n"))

    def change(after: int, revenue_60: Column, revenue_300: Column, orders_60: Column, events_5: Column) -> Column:
        return F.struct((F.col("t") + F.lit(after * MICROS)).alias("at"), revenue_60.alias("a"), revenue_300.alias("b"),
                        orders_60.alias("c"), events_5.alias("d"), F.lit(1 if after == 0 else 0).cast("bigint").alias("here"))

    zero = F.lit(0).cast("bigint")
    v, n = F.col("v"), F.col("n")
    changes = F.array(change(0, v, v, n, n), change(60, -v, zero, -n, zero), change(300, zero, -v, zero, zero), change(5, zero, zero, zero, -n))
    steps = moments.select(*keys, F.inline(changes)).groupBy(*keys, "at").agg(*[F.sum(c).alias(c) for c in ("a", "b", "c", "d", "here")])
    width = F.lit(slice_seconds * MICROS)
    summed = running_sums(steps, keys, ["at"], F.floor(F.col("at") / width).cast("bigint"), {
        "revenue_60s_cents": F.col("a"), "revenue_300s_cents": F.col("b"), "orders_60s": F.col("c"), "events_5s": F.col("d")})
    return (summed if every_change else summed.filter("here > 0")).select(
        *keys, F.timestamp_micros("at").alias("at"), "revenue_60s_cents", "revenue_300s_cents", "orders_60s",
        F.round(F.col("events_5s") / F.lit(5.0), 2).alias("events_per_second"))


# --- cooldown -------------------------------------------------------------------------------------------------------------

def _summarise(times: np.ndarray, need: int, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Step function of one block: for an earliest allowed time up to ``upto[i]`` the last kept time is ``last[i]``."""
    n = len(times)
    jump = np.searchsorted(times, times + need)
    pointer = np.where(jump < n, jump, np.arange(n))
    while True:
        further = pointer[pointer]
        if np.array_equal(further, pointer):
            break
        pointer = further
    entries = min(n, int(np.searchsorted(times, start + need, side="right")) + 1)
    upto, last = times[:entries], times[pointer[:entries]]
    keep = np.append(last[1:] != last[:-1], True)
    return upto[keep], last[keep]


def _advance(allowed: np.ndarray, upto: np.ndarray, last: np.ndarray, need: int) -> np.ndarray:
    """Earliest allowed times after a block; unchanged where the block has nothing to keep."""
    spot = np.searchsorted(upto, allowed)
    inside = spot < len(upto)
    return np.where(inside, last[np.minimum(spot, len(last) - 1)] + need, allowed)


def _blocks(columns: dict[str, np.ndarray], number: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Step functions per block number; rows come ordered by number and bound."""
    starts = [0, *(np.flatnonzero(columns[number][1:] != columns[number][:-1]) + 1).tolist(), len(columns[number])]
    for lo, hi in zip(starts[:-1], starts[1:]):
        yield int(columns[number][lo]), columns["upto"][lo:hi], columns["last"][lo:hi]


def cooldown_alerts(candidates: DataFrame, key: str, ts: str, seconds: int, inclusive: bool = False,
                    tie: list[str] | None = None, per_block: int = 64) -> DataFrame:
    """Candidates kept when enough time has passed since the last *kept* one of their key.

    ``inclusive=False`` needs a gap longer than ``seconds``; ``inclusive=True`` also fires at exactly ``seconds``.

    The chain of kept alerts is sequential, but what a stretch of time does to it is a small step function from "earliest
    allowed time" to "last kept time". Blocks of ``per_block`` cooldowns are summarised in parallel, then groups of
    ``per_block`` blocks; only the summaries of those groups are walked per key, and the result is pushed back down. A key
    with most of the candidates is thereby spread over all of its blocks.
    """
    if seconds <= 0:
        raise ValueError("cooldown must be positive")
    need = seconds * MICROS + (0 if inclusive else 1)
    span = need * per_block
    t = F.unix_micros(ts)
    rest = [c for c in candidates.columns if c != key]
    order = F.struct(*(tie or []), F.xxhash64(*candidates.columns))
    rows = candidates.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).groupBy(F.col(key).alias("k"), t.alias("t")).agg(
        F.min_by(F.struct(*rest), order).alias("row")).withColumn("b", F.floor(F.col("t") / F.lit(span)).cast("bigint"))
    times = rows.select("k", "t", "b")
    never, anything = np.iinfo(np.int64).min, np.iinfo(np.int64).max

    def summarise(key: tuple, columns: dict) -> dict:
        upto, last = _summarise(columns["t"], need, int(key[1]) * span)
        return {"g": np.full(len(upto), int(key[1]) // per_block), "upto": upto, "last": last}

    def compose(key: tuple, columns: dict) -> dict:
        state = upto = None
        for _, block_upto, block_last in _blocks(columns, "b"):
            if state is None:
                # The last entry stands for times after everything in this block.
                upto, state = np.append(block_upto, anything), np.append(block_last + need, never)
            else:
                state = _advance(state, block_upto, block_last, need)
        if state[-1] == never:
            upto, state = upto[:-1], state[:-1]
        last = state - need
        keep = np.append(last[1:] != last[:-1], True)
        return {"upto": upto[keep], "last": last[keep]}

    def walk(number: str):
        def run(key: tuple, columns: dict) -> dict:
            allowed = int(columns["allowed"][0]) if "allowed" in columns else never // 4
            numbers, entries = [], []
            for block, upto, last in _blocks(columns, number):
                numbers.append(block)
                entries.append(allowed)
                allowed = int(_advance(np.array([allowed]), upto, last, need)[0])
            return {number: numbers, "allowed": entries}
        return run

    def mark(key: tuple, columns: dict) -> dict:
        allowed, kept = int(columns["allowed"][0]), []
        while (spot := int(np.searchsorted(columns["t"], allowed))) < len(columns["t"]):
            kept.append(int(columns["t"][spot]))
            allowed = kept[-1] + need
        return {"kept": kept}

    steps = map_groups(times, ["k", "b"], ["t"], "g bigint, upto bigint, last bigint", summarise)
    groups = map_groups(steps, ["k", "g"], ["b", "upto"], "upto bigint, last bigint", compose)
    group_entry = map_groups(groups, ["k"], ["g", "upto"], "g bigint, allowed bigint", walk("g"))
    block_entry = map_groups(steps.join(group_entry, ["k", "g"]), ["k", "g"], ["b", "upto"], "b bigint, allowed bigint", walk("b"))
    kept = map_groups(times.join(block_entry.drop("g"), ["k", "b"]), ["k", "b"], ["t"], "kept bigint", mark)
    return rows.join(kept.select("k", F.col("kept").alias("t")), ["k", "t"]).select(F.col("k").alias(key), "row.*").select(*candidates.columns)


def churn_alerts(scored: DataFrame, threshold: float = CHURN_ALERT_SCORE, cooldown_seconds: int = 120, inclusive: bool = False,
                 faithful: bool = False) -> DataFrame:
    """Alert rows for users whose unrounded score reaches the threshold, at most one per user and cooldown; the shown prefix isn't the key."""
    candidates = scored.filter(state_score(faithful) >= threshold).select(
        "user_id_hash", F.substring("user_id_hash", 1, 16).alias("user_prefix"), F.round("churn_score", 3).alias("churn_score"),
        F.col("order_count").alias("orders"), dollars_text("total_spend").alias("total_spend"),
        F.lit("Send win-back offer — 20% discount").alias("recommendation"), F.col("occurred_at").alias("ts"), "event_id")
    return cooldown_alerts(candidates, "user_id_hash", "ts", cooldown_seconds, inclusive, tie=["event_id"]).drop("event_id", "user_id_hash")


# --- smoothing ------------------------------------------------------------------------------------------------------------

_STATE_BOUND = 2 ** 40
_RUN = 400


def _smooth(state: int, micros: int) -> int:
    """One step in hundredths of a millisecond of the recurrence in floating point, rounded to two decimals; monotone in the state."""
    return round(round(0.9 * (state / 100) + 0.1 * (micros / 1000), 2) * 100)


def _least_state(output: int, micros: int) -> int:
    """The least state that a step takes to ``output`` or more; rounding puts it near the exact quotient."""
    state = (100 * output - 50 - micros) // 90 - 1
    while _smooth(state, micros) >= output:
        state -= 1
    while _smooth(state, micros) < output:
        state += 1
    return state


def _smoothing_map(values: list[int]) -> tuple[list[int], list[int]]:
    """Monotone map of a long run of values: (thresholds, outputs). Rounding and decay leave only a few distinct outputs."""
    low, high = -_STATE_BOUND, _STATE_BOUND
    for x in values:
        low, high = _smooth(low, x), _smooth(high, x)
    outputs = list(range(low, high + 1))
    needed = outputs[1:]
    for x in reversed(values):
        needed = [_least_state(v, x) for v in needed]
    return needed, outputs


def latency_ewma(latencies: DataFrame, key: str, ts: str, latency_ms: str, tie: str, slice_seconds: int = 3_600) -> DataFrame:
    """Final smoothed latency per key: each value moves the state to 0.9 * state + 0.1 * value, rounded to two decimals.

    Latencies count to the microsecond. Runs of values are condensed per (key, time slice) in parallel, and the small maps are applied in
    order per key; a run too short to have a small map stays as its values, at most ``_RUN`` of them. Time slices bound what one task sees,
    and the number of maps per key is bounded by the calendar. Null latencies count as no event.
    """
    rows = latencies.where(F.col(latency_ms).isNotNull()).select(
        F.col(key).alias("k"), F.unix_micros(ts).alias("t"), F.col(tie).alias("e"),
        F.round(F.col(latency_ms) * F.lit(1000)).cast("bigint").alias("x"), time_slice(F.col(ts), slice_seconds).alias("b"))
    rows = rows.withColumn("x", F.when(F.abs("x") < 10 * _STATE_BOUND, F.col("x")).otherwise(F.raise_error(F.lit("latency out of range")).cast("bigint")))

    def condense(key: tuple, columns: dict) -> dict:
        values = [int(x) for x in columns["x"]]
        short = len(values) < _RUN
        needed, outputs = ([], values) if short else _smoothing_map(values)
        return {"n": [len(values)], "short": [short], "needed": [needed], "outputs": [outputs]}

    def apply(key: tuple, columns: dict) -> dict:
        state = 0
        for short, needed, outputs in zip(columns["short"], columns["needed"], columns["outputs"]):
            if short:
                for x in outputs:
                    state = _smooth(state, int(x))
            else:
                state = int(outputs[int(np.searchsorted(np.asarray(needed), state, side="right"))])
        return {"events": [int(columns["n"].sum())], "h": [state]}

    maps = map_groups(rows, ["k", "b"], ["t", "e"], "n bigint, short boolean, needed array<bigint>, outputs array<bigint>", condense)
    done = map_groups(maps, ["k"], ["b"], "events bigint, h bigint", apply)
    return done.select(F.col("k").alias(key), "events", (F.col("h") / F.lit(100.0)).alias("latency_ms"))


# --- live tables ----------------------------------------------------------------------------------------------------------

def rt_window(orders: DataFrame, as_of: Column, minutes: int) -> DataFrame:
    return orders.filter(F.unix_micros("occurred_at") >= F.unix_micros(as_of) - F.lit(minutes * 60 * MICROS))


def rt_stats(orders: DataFrame) -> DataFrame:
    return orders.agg(
        F.count(F.lit(1)).alias("total_orders"), F.sum("total_cents").alias("revenue_cents"), F.avg("total_cents").alias("avg_order_cents"),
        F.avg("churn_score").alias("avg_churn_score"), F.count_if("is_refunded").alias("refunds"),
        F.count_distinct("channel").alias("channels_active"))


def rt_by_channel(orders: DataFrame) -> DataFrame:
    return orders.groupBy("channel").agg(F.count(F.lit(1)).alias("cnt"), F.sum("total_cents").alias("rev")).orderBy(F.col("cnt").desc(), "channel")


def rt_by_tier(orders: DataFrame) -> DataFrame:
    return orders.groupBy("value_tier").agg(F.count(F.lit(1)).alias("cnt"))


def newest(rows: DataFrame, n: int, ts: str, tie: str) -> DataFrame:
    return rows.orderBy(F.col(ts).desc(), F.col(tie).desc()).limit(n)


def live_orders(orders: DataFrame, n: int = 50) -> DataFrame:
    if not 1 <= n <= 200:
        raise ValueError("n must be between 1 and 200")
    return newest(orders.drop(*[c for c in orders.columns if c.startswith("_")]), n, "occurred_at", "event_id")


def ring_trim(orders: DataFrame, keep: int = 10_000) -> DataFrame:
    return newest(orders, keep, "occurred_at", "order_id")


def churn_histogram(scored: DataFrame) -> DataFrame:
    bucket = F.least(F.lit(9), F.floor(F.col("churn_score") * F.lit(10.0))).cast("int")
    return scored.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("cnt"))


def channel_counts(orders: DataFrame) -> DataFrame:
    return orders.filter(F.coalesce("channel", F.lit("")) != "").groupBy("channel").agg(F.count(F.lit(1)).alias("cnt")).orderBy(
        F.col("cnt").desc(), "channel")


def revenue_buckets(orders: DataFrame, seconds: int = 1) -> DataFrame:
    w = F.window("occurred_at", f"{seconds} seconds")
    return orders.groupBy(w.alias("w")).agg(F.sum("total_cents").alias("revenue_cents"), F.count(F.lit(1)).alias("orders")).select(
        F.col("w.start").alias("bucket_start"), "revenue_cents", "orders")


def burst_detect(orders: DataFrame, seconds: int = 1, at_least: int = 5) -> DataFrame:
    return revenue_buckets(orders, seconds).filter(F.col("orders") >= at_least)
