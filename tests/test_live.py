from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderlake.operators import live as lv

BASE = datetime(2024, 1, 1)


def keep(times, cooldown, inclusive):
    last, out = None, []
    for x in sorted(times):
        if last is None or x - last > cooldown or (inclusive and x - last == cooldown):
            out.append(x)
            last = x
    return out


def cooled(spark, rows, cooldown, inclusive=False, per_block=64):
    df = spark.createDataFrame([(k, i, BASE + timedelta(seconds=x)) for i, (k, x) in enumerate(rows)], "k string, i int, ts timestamp")
    out = {}
    for r in lv.cooldown_alerts(df, "k", "ts", cooldown, inclusive, per_block=per_block).collect():
        out.setdefault(r.k, []).append((r.ts - BASE).total_seconds())
    return {k: sorted(v) for k, v in out.items()}


def test_cooldown_counts_from_the_last_kept(spark):
    assert cooled(spark, [("a", x) for x in (0, 100, 130, 260)], 120) == {"a": [0, 130, 260]}


def test_cooldown_boundaries(spark):
    assert cooled(spark, [("a", 0), ("a", 120)], 120) == {"a": [0]}
    assert cooled(spark, [("a", 0), ("a", 300)], 300, inclusive=True) == {"a": [0, 300]}
    assert cooled(spark, [("a", 0), ("a", 299)], 300, inclusive=True) == {"a": [0]}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 4000)), min_size=1, max_size=120), st.integers(1, 90), st.booleans(), st.sampled_from([2, 3, 64]))
def test_cooldown_equals_naive_loop(spark, rows, cooldown, inclusive, per_block):
    want = {k: [float(x) for x in keep({x for kk, x in rows if kk == k}, cooldown, inclusive)] for k in {k for k, _ in rows}}
    assert cooled(spark, rows, cooldown, inclusive, per_block) == want


def test_dense_hot_key_crosses_blocks_and_groups(spark):
    times = list(range(0, 6000, 1)) + [7003, 7004, 20000]
    rows = [("hot", x) for x in times] + [("cold", 5)]
    assert cooled(spark, rows, 7, per_block=3) == {"hot": [float(x) for x in keep(times, 7, False)], "cold": [5.0]}


def smooth(values):
    state = 0.0
    for x in values:
        state = round(0.9 * state + 0.1 * (x / 1000), 2)
    return state


@pytest.mark.parametrize("slice_seconds", [60, 600, 10_000_000])
def test_smoothing_equals_the_loop(spark, slice_seconds):
    values = [(i * 7919) % 500_003 for i in range(3000)]
    rows = [(w, i, BASE + timedelta(seconds=i), v / 1000) for i, v in enumerate(values) for w in ("w", None)] + [("w", 9999, BASE, None)]
    df = spark.createDataFrame(rows, "w string, e int, ts timestamp, x double")
    got = {row.w: (row.events, row.latency_ms) for row in lv.latency_ewma(df, "w", "ts", "x", "e", slice_seconds).collect()}
    assert got == {w: (3000, smooth(values)) for w in ("w", None)}


def test_fractions_of_a_millisecond_count(spark):
    df = spark.createDataFrame([("w", i, BASE + timedelta(seconds=i), 12.7) for i in range(50)], "w string, e int, ts timestamp, x double")
    state = 0.0
    for _ in range(50):
        state = round(0.9 * state + 0.1 * 12.7, 2)
    assert lv.latency_ewma(df, "w", "ts", "x", "e").first().latency_ms == state


def test_users_with_one_prefix_alert_apart(spark):
    rows = [("p" * 16 + x, BASE, 0.9, 1, 100, f"e{x}") for x in "ab"]
    df = spark.createDataFrame(rows, "user_id_hash string, occurred_at timestamp, churn_score double, order_count int, total_spend bigint, event_id string")
    df = df.withColumns({"recency_days": F.lit(100.0), "raw_score": F.lit(0.9)})
    kept = lv.cooldown_alerts(df, "user_id_hash", "occurred_at", 120, tie=["event_id"])
    assert kept.count() == 2


def orders(spark, rows):
    full = [(f"e{i:04d}", f"o{i:04d}", u, BASE + timedelta(seconds=s), c, st_ == "refunded", ch) for i, (u, s, c, st_, ch) in enumerate(rows)]
    return spark.createDataFrame(full, "event_id string, order_id string, user_id_hash string, occurred_at timestamp, total_cents bigint, is_refunded boolean, channel string")


def test_running_state(spark):
    df = orders(spark, [("u", 0, 100, "placed", "email"), ("u", 5000, 200, "refunded", "organic"), ("u", 5000, 300, "placed", None), ("u", 90000, 400, "placed", "email"), ("v", 1, 7, "placed", "")])
    rows = lv.running_user_state(df).orderBy("event_id").collect()
    assert [(r.order_count, r.total_spend, r.refunds) for r in rows] == [(1, 100, 0), (2, 300, 1), (3, 600, 1), (4, 1000, 1), (1, 7, 0)]
    assert [r.channels for r in rows] == [["email"], ["email", "organic"], ["email", "organic"], ["email", "organic"], []]
    assert [r.previous_seen for r in rows] == [None, BASE, BASE + timedelta(seconds=5000), BASE + timedelta(seconds=5000), None]
    assert all(r.first_seen == BASE for r in rows[:4])


@pytest.mark.parametrize("slice_seconds", [1, 10, 100000])
def test_running_state_does_not_depend_on_the_slice(spark, slice_seconds):
    rows = [("hot" if i % 3 else f"u{i % 7}", (i * 37) % 900, i, "refunded" if i % 5 == 0 else "placed", "abcde"[i * 7 % 5]) for i in range(200)]
    got = [tuple(r) for r in lv.running_user_state(orders(spark, rows), slice_seconds).orderBy("event_id").collect()]
    want = [tuple(r) for r in lv.running_user_state(orders(spark, rows), 3600).orderBy("event_id").collect()]
    assert got == want


def test_live_score_uses_gap_to_previous_event(spark):
    day = 86400
    df = orders(spark, [("u", 0, 100, "placed", "x"), ("u", 95 * day, 100, "placed", "x")])
    scores = [r.churn_score for r in lv.live_churn_score(lv.running_user_state(df)).orderBy("event_id").collect()]
    assert scores == [0.44, 0.86]
    faithful = [r.churn_score for r in lv.live_churn_score(lv.running_user_state(df), faithful=True).orderBy("event_id").collect()]
    assert faithful == [0.44, 0.41]


def test_trailing_windows_are_half_open(spark):
    df = orders(spark, [("u", 0, 10, "placed", "x"), ("u", 59, 20, "placed", "x"), ("u", 60, 40, "placed", "x"), ("u", 300, 80, "placed", "x")])
    rows = lv.trailing_revenue(df, slice_seconds=7).orderBy("at").collect()
    assert [r.revenue_60s_cents for r in rows] == [10, 30, 60, 80]
    assert [r.revenue_300s_cents for r in rows] == [10, 30, 70, 140]
    assert [r.orders_60s for r in rows] == [1, 2, 2, 1]
    assert [r.events_per_second for r in rows] == [0.2, 0.2, 0.4, 0.2]


def live(spark, **over):
    row = {"order_id": "o", "user_id_hash": "h", "total_cents": 100, "status": "placed", "discount_cents": 0} | over
    return spark.createDataFrame([tuple(row.values())], "order_id string, user_id_hash string, total_cents bigint, status string, discount_cents bigint")


@pytest.mark.parametrize("over,bad", [({}, 0), ({"total_cents": 0}, 1), ({"total_cents": None}, 1), ({"status": "cancelled"}, 1), ({"order_id": ""}, 1), ({"user_id_hash": None, "status": None}, 2)])
def test_live_validation(spark, over, bad):
    assert len(lv.validate_live(live(spark, **over)).first().errors) == bad


def test_replay_may_accept_cancelled(spark):
    from orderlake.functions import ORDER_STATUSES
    assert lv.valid_live(live(spark, status="cancelled"), ORDER_STATUSES).count() == 1


def test_enrichment_and_high_value(spark):
    row = lv.enrich_live(live(spark, total_cents=20001, status="refunded", discount_cents=None)).first()
    assert (row.margin_cents, row.is_refunded, row.is_delivered, row.has_discount, row.value_tier) == (7000, True, False, False, "high")
    df = live(spark, order_id="0123456789", total_cents=20001).withColumn("occurred_at", F.lit(BASE))
    row = lv.high_value_orders(df).first()
    assert (row.order_id, row.amount) == ("01234567", "$200.01")
    assert lv.high_value_orders(live(spark, total_cents=20000).withColumn("occurred_at", F.lit(BASE))).count() == 0


def test_histogram_top_bucket(spark):
    df = spark.createDataFrame([(1.0,), (0.95,), (0.1,)], "churn_score double")
    assert {r.bucket: r.cnt for r in lv.churn_histogram(df).collect()} == {9: 2, 1: 1}


def test_live_orders_hides_internal_columns_and_caps(spark):
    df = orders(spark, [("u", i, 1, "placed", "x") for i in range(250)]).withColumn("_t", F.lit(1))
    with pytest.raises(ValueError):
        lv.live_orders(df, 500)
    out = lv.live_orders(df, 200)
    assert out.count() == 200 and "_t" not in out.columns
    assert out.first().occurred_at == BASE + timedelta(seconds=249)


