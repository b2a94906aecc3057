import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from orderlake.operators import live as lv
from orderlake.schemas import LIVE_ORDER
from orderlake.sources.bronze import change_stream
from orderlake.streaming import live as sl

BASE = datetime(2024, 1, 1)


def order(i, user="u", sec=0, total=100, status="placed", channel="email", oid=None):
    return (f"e{i:04d}", oid or f"o{i:04d}", "c", user, "s", "w", status, "USD", channel, 1, total, 0, 0, total, BASE + timedelta(seconds=sec))


def put(spark, path, n, rows):
    """One source file per call, in call order."""
    spark.createDataFrame(rows, LIVE_ORDER).coalesce(1).write.mode("append").parquet(str(path))


@pytest.fixture
def paths(tmp_path):
    return tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")


def read(spark, path, per_trigger=1):
    return sl.read_live(spark, str(path), LIVE_ORDER, per_trigger=per_trigger)


def test_state_over_batches_and_restart_equals_batch(spark, paths):
    src, out, ckpt = paths
    chunks = [[order(i, f"u{i % 3}", i * 4000, 50 * i + 1, "refunded" if i % 4 == 0 else "placed", "abc"[i % 3]) for i in range(lo, lo + 10)] for lo in (0, 10, 20)]
    every = [r for c in chunks for r in c]
    put(spark, src, 0, list(reversed(chunks[0])))
    put(spark, src, 1, chunks[1])
    args = (0.205, 20000)
    sl.run_available(sl.stream_user_state(sl.stream_validate_enrich(read(spark, src)), *args), out, ckpt)
    put(spark, src, 2, chunks[2])
    sl.run_available(sl.stream_user_state(sl.stream_validate_enrich(read(spark, src)), *args), out, ckpt)
    got = {r.event_id: (r.order_count, r.total_spend, r.refunds, r.channels, r.churn_score, r.alert) for r in spark.read.parquet(out).collect()}
    state = lv.live_churn_score(lv.running_user_state(lv.enrich_live(spark.createDataFrame(every, LIVE_ORDER)))).cache()
    fired = {r.event_id for r in lv.cooldown_alerts(state.filter("churn_score >= 0.205").select("event_id", "user_id_hash", "occurred_at"), "user_id_hash", "occurred_at", 20000).collect()}
    want = {r.event_id: (r.order_count, r.total_spend, r.refunds, ",".join(r.channels), r.churn_score, r.event_id in fired) for r in state.collect()}
    assert got == want and any(v[5] for v in want.values())


def test_dedup_keeps_first_across_batches(spark, paths):
    src, out, ckpt = paths
    put(spark, src, 0, [order(1, oid="x"), order(2, oid="y", sec=1)])
    put(spark, src, 1, [order(3, oid="x", sec=2), order(4, oid="z", sec=3)])
    sl.run_available(sl.stream_dedup(read(spark, src)), out, ckpt)
    assert sorted(r.order_id for r in spark.read.parquet(out).collect()) == ["x", "y", "z"]


def test_late_rows_are_left_out_after_the_watermark(spark, paths):
    src, out, ckpt = paths
    put(spark, src, 0, [order(1, sec=0), order(2, sec=5000)])
    put(spark, src, 1, [order(3, sec=100000)])
    put(spark, src, 2, [order(4, sec=1), order(5, sec=200000)])
    sl.run_available(sl.bucket_columns(sl.stream_revenue_buckets(read(spark, src))), out, ckpt)
    got = {(r.bucket_start - BASE).total_seconds(): r.orders for r in spark.read.parquet(out).collect()}
    assert got == {0.0: 1, 5000.0: 1, 100000.0: 1}


def test_sessions_equal_batch(spark, paths):
    src, out, ckpt = paths
    schema = "event_id string, session_id string, user_id_hash string, event_type string, page_url string, occurred_at timestamp"
    rows = [(f"e{i:03d}", f"s{i % 2}", "u", ["page_view", "purchase"][i % 5 == 0], f"/p{i}", BASE + timedelta(seconds=i * 601 + (5000 if i > 20 else 0))) for i in range(40)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(src))
    spark.createDataFrame([("z", "sentinel", None, None, None, BASE + timedelta(days=9))], schema).write.mode("append").parquet(str(src))
    from orderlake.operators.clicks import sessionize
    stream = sl.stream_sessionize(sl.read_live(spark, str(src), spark.createDataFrame(rows, schema).schema))
    sl.run_available(stream, out, ckpt)
    got = spark.read.parquet(out).filter("session_id <> 'sentinel'")
    want = sessionize(spark.createDataFrame(rows, schema)).select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() > 2


def test_missing_sessions_and_late_rows_are_kept_in_view(spark, paths, tmp_path):
    src, out, ckpt = paths
    schema = "event_id string, session_id string, user_id_hash string, event_type string, page_url string, occurred_at timestamp"
    for part in ([("a", "s", 0), ("b", None, 1), ("z", "t", 50000)], [("c", "s", 90000)], [("d", "s", 2), ("e", "s", 3), ("f", None, 90001)], [("g", "s", 180000)]):
        spark.createDataFrame([(i, s, "u", "page_view", "/", BASE + timedelta(seconds=t)) for i, s, t in part], schema).coalesce(1).write.mode("append").parquet(str(src))
    clicks = sl.read_live(spark, str(src), spark.createDataFrame([], schema).schema, per_trigger=1)
    late = sl.LateRows(spark)
    sl.run_available(sl.stream_sessionize(clicks), out, ckpt, listener=late)
    assert late.total() == 2
    sl.run_batches(clicks, sl.missing_session_sink(str(tmp_path / "dead")), ckpt + "2")
    sl.missing_session_sink(str(tmp_path / "dead"))(spark.read.parquet(str(src)).filter("event_id = 'b'"), 0)
    assert sorted(r.event_id for r in spark.read.parquet(str(tmp_path / "dead")).collect()) == ["b", "f"]


def test_rejected_and_anomalies(spark, paths):
    src, out, ckpt = paths
    put(spark, src, 0, [order(1, total=0), order(2, status="cancelled"), order(3, total=30000)])
    sl.run_available(sl.stream_anomalies(read(spark, src)), out, ckpt)
    assert [r.amount for r in spark.read.parquet(out).collect()] == ["$300.00"]
    sl.run_available(sl.stream_rejected(read(spark, src)).select("event_id", F.array_join("errors", ",").alias("e")), out + "2", ckpt + "2")
    assert spark.read.parquet(out + "2").count() == 2


def test_silver_sink_splits_and_repeats_safely(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    def line(i, status="placed", ts=1):
        return json.dumps({"op": "c", "ts_ms": ts, "after": {"order_id": i, "user_id": "u", "status": status, "total_cents": 5}})
    (src / "a.txt").write_text("\n".join([line("a"), "{bad", line("b", "lost")]))
    sink = sl.silver_sink(str(tmp_path / "silver"), str(tmp_path / "dlq"), "salt")
    sl.run_batches(change_stream(spark, "text", str(src), per_trigger=1), sink, str(tmp_path / "ckpt"))
    (src / "b.txt").write_text("\n".join([line("a", "shipped", 2), line("c")]))
    sl.run_batches(change_stream(spark, "text", str(src), per_trigger=1), sink, str(tmp_path / "ckpt"))
    sink(spark.read.text(str(src / "b.txt")), 1)
    got = {r.order_id: r.status for r in sl.read_streamed_silver(spark, str(tmp_path / "silver")).collect()}
    assert got == {"a": "shipped", "c": "placed"}
    assert spark.read.parquet(str(tmp_path / "dlq")).count() == 2
    assert spark.read.parquet(str(tmp_path / "silver")).count() == 3


def test_silver_lake_merges_each_batch_and_repeats_safely(spark, tmp_path):
    from orderlake.streaming.lake import SilverLake

    def lines(*rows):
        texts = [json.dumps({"op": "c", "ts_ms": ts, "after": {"order_id": i, "user_id": "u", "status": status, "total_cents": 5}}) for i, status, ts in rows]
        return spark.createDataFrame([(x,) for x in [*texts, "{bad"]], "value string")
    lake = SilverLake(spark, str(tmp_path / "lake"), "salt", buckets=4)
    sink = lake.sink()
    first, second, third = lines(*[(f"o{i}", "placed", 1) for i in range(40)]), lines(("o1", "shipped", 5), ("o2", "lost", 9), ("x", "placed", 1)), lines(("o1", "placed", 2), ("o3", "delivered", 3))
    for n, batch in ((0, first), (1, second), (1, second), (2, third), (2, third)):
        sink(batch, n)
    got = {r.order_id: r.status for r in lake.read(spark).collect()}
    assert got == {**{f"o{i}": "placed" for i in range(40)}, "o1": "shipped", "o3": "delivered", "x": "placed"}
    assert lake.read(spark).count() == 41
    slots = spark.read.parquet(str(tmp_path / "lake" / "orders")).groupBy("bucket", "slot").count().count()
    assert slots <= 8
    assert spark.read.parquet(str(tmp_path / "lake" / "rejected")).count() == 4


def test_recent_store_keeps_newest(spark, paths, tmp_path):
    src, _, ckpt = paths
    for n in range(3):
        put(spark, src, n, [order(n * 10 + i, sec=n * 100 + i) for i in range(10)])
    sl.run_batches(read(spark, src).select("order_id", "occurred_at"), sl.recent_store(str(tmp_path / "store"), 15), ckpt)
    rows = sl.read_recent_store(spark, str(tmp_path / "store")).collect()
    assert len(rows) == 15 and min(r.occurred_at for r in rows) == BASE + timedelta(seconds=105)


def test_alert_rows_and_counts(spark):
    state = spark.createDataFrame([("e", "h" * 64, 3, 12345, 0.81, True, BASE), ("f", "h" * 64, 4, 1, 0.81, False, BASE), ("g", "h" * 64, 4, 1, 0.1, False, BASE)],
                                  "event_id string, user_id_hash string, order_count bigint, total_spend bigint, churn_score double, alert boolean, occurred_at timestamp")
    (row,) = sl.alert_records(state).collect()
    assert row.body == "Churn probability: 81% | Orders: 3 | Lifetime spend: $123.45" and json.loads(row.data)["user_prefix"] == "h" * 16
    counts = sl.alert_counts(state, 0.7).first()
    assert (counts.alerts_sent, counts.alerts_suppressed) == (1, 1)


def test_unknown_source_is_refused(spark):
    with pytest.raises(ValueError):
        change_stream(spark, "carrier-pigeon", "x")
