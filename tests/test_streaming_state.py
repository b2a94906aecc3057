"""Keyed streams over several micro-batches against plain loops and the batch operators."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from orderlake.operators import live as lv
from orderlake.schemas import LIVE_ORDER
from orderlake.streaming import alerts as sa
from orderlake.streaming import kpis as sk
from orderlake.streaming import live as sl
from orderlake.streaming import sessions as ss
from orderlake.streaming import users as su

BASE = datetime(2024, 1, 1)
FAR = BASE + timedelta(days=4000)


@pytest.fixture(autouse=True)
def store(spark):
    sl.use_rocksdb(spark)


def put(spark, path, parts, schema):
    """One source file per part, in order."""
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(path))
    return sl.read_live(spark, str(path), spark.createDataFrame([], schema).schema, per_trigger=1)


def cut(rows, jitter, n, rng, ts):
    """Rows by arrival, at most ``jitter`` seconds late, in n parts."""
    order = sorted(rows, key=lambda r: ts(r) + timedelta(seconds=rng.random() * jitter))
    size = -(-len(order) // n)
    return [order[i : i + size] for i in range(0, len(order), size)]


def test_kpis_equal_a_plain_loop_at_every_second(spark, tmp_path):
    rng = random.Random(3)
    rows = [(f"e{i}", rng.choice("ab"), rng.randrange(1, 500), BASE + timedelta(seconds=rng.random() * 900 + (2000 if i % 5 == 0 else 0))) for i in range(400)]
    schema = "event_id string, channel string, total_cents bigint, occurred_at timestamp"
    stream = put(spark, tmp_path / "in", [*cut(rows, 50, 5, rng, lambda r: r[3]), [("z", "z", 1, FAR)]], schema)
    out = str(tmp_path / "out")
    sl.run_available(sk.stream_trailing_kpis(stream, ["channel"], "1 minute"), out, str(tmp_path / "ckpt"))
    got = {(r.channel, int((r["at"] - BASE).total_seconds())): tuple(r)[2:] for r in spark.read.parquet(out).where("channel <> 'z'").collect()}
    want = {}
    for channel in "ab":
        own = [(int((t - BASE).total_seconds()) + 1, v) for _, c, v, t in rows if c == channel]
        for at in {e + h for e, _ in own for h in (0, 5, 60, 300)}:
            last = lambda h: [v for e, v in own if at - h < e <= at]
            want[channel, at] = (sum(last(60)), sum(last(300)), len(last(60)), round(len(last(5)) / 5, 2))
    assert got == want
    batch = lv.trailing_revenue(spark.createDataFrame(rows, schema).withColumn("occurred_at", F.timestamp_seconds(F.unix_seconds("occurred_at") + 1)), ["channel"], every_change=True)
    assert {(r.channel, int((r["at"] - BASE).total_seconds())): tuple(r)[2:] for r in batch.collect()} == want


def test_dispatcher_equals_a_plain_loop(spark, tmp_path):
    rng = random.Random(4)
    rows = [(rng.choice(["churn", "anomaly_x"]), rng.choice("uvw"), "warning", f"t{i}", "b", "{}", i % 37 == 0, f"e{i:03d}", BASE + timedelta(seconds=rng.randrange(5000))) for i in range(300)]
    schema = "alert_type string, entity string, severity string, title string, body string, data string, forced boolean, event_id string, fired_at timestamp"
    parts = [*cut(rows, 200, 4, rng, lambda r: r[8]), [("end", "end", "w", None, None, None, False, "z", FAR)]]
    stream = put(spark, tmp_path / "in", parts, schema)
    log = str(tmp_path / "log")
    sl.run_batches(sa.dispatch(stream, 300, "5 minutes"), sa.alert_logs(log), str(tmp_path / "ckpt"))
    last, want = {}, {"sent": set(), "suppressed": set()}
    for kind, entity, _, _, _, _, forced, event, at in sorted(rows, key=lambda r: (r[8], r[7])):
        free = forced or (kind, entity) not in last or at - last[kind, entity] >= timedelta(seconds=300)
        want["sent" if free else "suppressed"].add(event)
        if free and not forced:
            last[kind, entity] = at
    for outcome in want:
        assert {r.event_id for r in sa.read_alert_log(spark, log, outcome).where("alert_type <> 'end'").collect()} == want[outcome]
    kinds = {r[7]: r[0] for r in rows}
    for r in sa.alert_counters(spark, log).where("alert_type <> 'end'").collect():
        assert (r.alerts_sent, r.alerts_suppressed) == tuple(sum(kinds[e] == r.alert_type for e in want[o]) for o in ("sent", "suppressed"))
    sa.alert_logs(log)(spark.createDataFrame([(*rows[0], "sent")], schema + ", outcome string"), 10**6)
    assert sa.read_alert_log(spark, log, "suppressed").where("event_id = 'e000'").count() == int("e000" in want["suppressed"])


def test_rules(spark):
    scored = spark.createDataFrame([("h" * 64, 0.81, 3, 12345, "e", BASE), ("i" * 64, 0.79, 3, 1, "f", BASE)], "user_id_hash string, churn_score double, order_count bigint, total_spend bigint, event_id string, occurred_at timestamp")
    (row,) = sa.churn_candidates(scored).collect()
    assert row.entity == "h" * 16 and row.body == "Churn probability: 81% | Orders: 3 | Lifetime spend: $123.45"
    depths = spark.createDataFrame([("raw", 12, "e", BASE), ("done", 3, "f", BASE)], "queue string, depth int, event_id string, occurred_at timestamp")
    (row,) = sa.stall_candidates(depths, 10).collect()
    assert (row.alert_type, row.entity, row.severity, row.body) == ("pipeline_stall", "raw", "critical", "Queue depth 12 exceeds threshold 10")


CLICK = "event_id string, session_id string, user_id_hash string, event_type string, page_url string, occurred_at timestamp"


def test_sessions_and_late_rows_are_all_that_came_in(spark, tmp_path):
    rng = random.Random(5)
    rows = [(f"e{i:03d}", rng.choice("st") if i % 9 else None, f"u{i % 3}", rng.choice(["page_view", "purchase", "search"]), f"/p{i}", BASE + timedelta(seconds=rng.randrange(40_000))) for i in range(400)]
    timely = cut([r for i, r in enumerate(rows) if i % 20], 500, 4, rng, lambda r: r[5])
    late = [r for i, r in enumerate(rows) if not i % 20]
    parts = [*timely[:3], [("x", "x", None, None, None, BASE + timedelta(seconds=60_000))], late[:10] + timely[3], [("z", "z", None, None, None, FAR)], late[10:]]
    stream = put(spark, tmp_path / "in", parts, CLICK)
    out = str(tmp_path / "out")
    sl.run_batches(ss.stream_sessions(stream, 1800, "10 minutes"), ss.session_sink(out), str(tmp_path / "ckpt"))
    read = lambda part: spark.read.option("recursiveFileLookup", "true").parquet(f"{out}/{part}")
    behind = {r.event_id for r in read("late").collect()}
    placed = [r for part in parts for r in part if r[1] is not None and r[0] not in ("x", "z")]
    assert behind >= {r[0] for r in late if r[1] is not None} and len(behind) < len(placed)
    sessions = read("sessions").where("session_id not in ('x', 'z')").collect()
    assert sum(r.event_count for r in sessions) + len(behind) == len(placed)
    kept = spark.createDataFrame([r for r in placed if r[0] not in behind], CLICK)
    from orderlake.operators.clicks import sessionize
    columns = read("sessions").drop("batch_id").columns
    assert sorted(map(str, read("sessions").where("session_id not in ('x', 'z')").select(*columns).collect())) == sorted(map(str, sessionize(kept).select(*columns).collect()))
    assert ss.unplaced(spark.createDataFrame(rows, CLICK)).count() == sum(r[1] is None for r in rows)


def order(i, user, sec, total, status="placed", channel="email"):
    return (f"e{i:05d}", f"o{i}", "c", user, "s", "w", status, "USD", channel, 1, total, 0, 0, total, BASE + timedelta(seconds=sec))


def test_a_hot_user_is_carried_over_batches_and_equals_the_batch_form(spark, tmp_path):
    rng = random.Random(6)
    rows = [order(i, "hot" if i % 3 == 0 else f"u{rng.randrange(40)}", i * 900, rng.randrange(1, 9000), rng.choice(["placed", "refunded"]), rng.choice("abc")) for i in range(600)]
    path = str(tmp_path / "users")
    sink = su.user_totals_sink(spark, path, 0.205, 20_000, ttl_seconds=10**8, buckets=8)
    last = {}
    for n in range(4):
        batch = lv.enrich_live(spark.createDataFrame(rows[n * 150 : n * 150 + 150], LIVE_ORDER))
        last[n] = batch
        sink(batch, n)
        if n == 2:
            sink(batch, n)
    state = lv.live_churn_score(lv.running_user_state(lv.enrich_live(spark.createDataFrame(rows, LIVE_ORDER)))).cache()
    fired = {r.event_id for r in lv.cooldown_alerts(state.where("churn_score >= 0.205").select("event_id", "user_id_hash", "occurred_at"), "user_id_hash", "occurred_at", 20_000).collect()}
    columns = ["event_id", "order_count", "total_spend", "refunds", "first_seen", "previous_seen", "channels", "churn_score"]
    want = {r.event_id: (*r, r.event_id in fired) for r in state.select(columns).collect()}
    got = {r.event_id: tuple(r) for r in su.read_user_rows(spark, path).select(*columns, "alert").collect()}
    assert got == want and any(v[-1] for v in want.values())
    totals = su.read_user_totals(spark, path + "/totals").collect()
    assert len(totals) == len({r[3] for r in rows}) and sum(r.orders for r in totals) == 600
    files = spark.read.parquet(path + "/totals").select("bucket", "slot").distinct().count()
    assert files <= 16


def test_silent_users_leave_the_state(spark, tmp_path):
    path = str(tmp_path / "users")
    sink = su.user_totals_sink(spark, path, ttl_seconds=1000, buckets=1)
    for n, rows in enumerate([[order(1, "a", 0, 5), order(2, "b", 10, 5)], [order(3, "b", 900, 5)], [order(4, "c", 1500, 5)], [order(5, "a", 1600, 5)]]):
        sink(lv.enrich_live(spark.createDataFrame(rows, LIVE_ORDER)), n)
    assert {r.user_id_hash: r.orders for r in su.read_user_totals(spark, path + "/totals").collect()} == {"a": 1, "b": 2, "c": 1}
    assert {r.event_id: r.order_count for r in su.read_user_rows(spark, path).collect()}["e00005"] == 1
