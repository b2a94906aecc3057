import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from orderlake.operators import governance as gv
from orderlake.operators import history as hs
from orderlake.operators import keyed
from orderlake.sources import sinks

T = "user_id_hash string, acquisition_channel string, updated_at timestamp"


def ts(day):
    return datetime(2024, 1, 1) + timedelta(days=day)


def versions(spark, rows):
    return spark.createDataFrame([(u, c, ts(d)) for u, c, d in rows], T)


def test_history_intervals(spark):
    rows = hs.scd2_users(versions(spark, [("a", "x", 0), ("a", "y", 800), ("a", "z", 801), ("b", "x", 5)])).orderBy("user_id_hash", "valid_from").collect()
    assert [(r.user_id_hash, r.acquisition_channel, r.valid_from, r.valid_to) for r in rows] == [
        ("a", "x", ts(0), ts(800)), ("a", "y", ts(800), ts(801)), ("a", "z", ts(801), None), ("b", "x", ts(5), None)]


def test_apply_unchanged_changed_new_deleted(spark):
    history = hs.scd2_users(versions(spark, [("same", "x", 0), ("moved", "x", 0), ("gone", "x", 0)]))
    snapshot = versions(spark, [("same", "x", 0), ("moved", "y", 10), ("moved", "z", 12), ("new", "n", 11)])
    out = {(r.user_id_hash, r.acquisition_channel): (r.valid_from, r.valid_to) for r in hs.scd2_apply(history, snapshot, F.lit(ts(20))).collect()}
    assert out == {("same", "x"): (ts(0), None), ("moved", "x"): (ts(0), ts(10)), ("moved", "y"): (ts(10), ts(12)), ("moved", "z"): (ts(12), None),
                   ("new", "n"): (ts(11), None), ("gone", "x"): (ts(0), ts(20))}
    again = hs.scd2_apply(hs.scd2_apply(history, snapshot, F.lit(ts(20))), snapshot, F.lit(ts(30)))
    assert {(r.user_id_hash, r.acquisition_channel): (r.valid_from, r.valid_to) for r in again.collect()} == out


def test_apply_can_leave_missing_users_open(spark):
    history = hs.scd2_users(versions(spark, [("gone", "x", 0)]))
    assert hs.scd2_apply(history, versions(spark, [("n", "x", 1)]), F.lit(ts(9)), close_missing=False).filter("valid_to is null").count() == 2


def test_point_in_time_boundaries(spark):
    history = hs.scd2_users(versions(spark, [("a", "x", 10), ("a", "y", 20)]))
    facts = spark.createDataFrame([("a", ts(d)) for d in (9, 10, 19, 20, 500)] + [("none", ts(1))], "user_id_hash string, at timestamp")
    rows = hs.scd2_point_in_time(facts, history, "at", ["acquisition_channel"]).orderBy("user_id_hash", "at").collect()
    assert [r.acquisition_channel for r in rows] == [None, "x", "x", "y", "y", None]


def test_asof_time_to_live(spark):
    feats = spark.createDataFrame([("u", ts(0), 1), ("u", ts(5), 2), ("u", ts(5), 2)], "u string, ft timestamp, v int")
    ents = spark.createDataFrame([(i, "u", ts(d)) for i, d in enumerate((-1, 0, 4, 5, 35, 36))] + [(9, None, ts(1))], "i int, u string, et timestamp")
    rows = hs.asof_features(ents, feats, "u", "et", "ft", ["v"]).orderBy("i").collect()
    assert [r.v for r in rows] == [None, 1, 1, 2, 2, None, None]


def test_asof_many_slices_against_brute_force(spark):
    feats = [("hot" if i % 3 else f"u{i}", ts((i * 17) % 400), i) for i in range(150)]
    ents = [(i, "hot" if i % 2 else f"u{(i * 3) % 150}", ts((i * 29) % 420)) for i in range(150)]
    got = {r.i: r.ft for r in hs.asof_features(
        spark.createDataFrame(ents, "i int, u string, et timestamp"), spark.createDataFrame(feats, "u string, ft timestamp, v int"), "u", "et", "ft", ["v"],
        ttl_seconds=10**9).withColumnRenamed("feature_timestamp", "ft").collect()}
    want = {i: max((f for k, f, _ in feats if k == u and f <= e), default=None) for i, u, e in ents}
    assert got == want


def test_range_joins_shuffle_each_side_once(spark, plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = spark.createDataFrame([(f"o{i}", "hot" if i % 3 else f"u{i % 40}", ts(i % 900)) for i in range(600)], "order_id string, user_id_hash string, at timestamp")
        history = spark.createDataFrame([(u, "xyz"[d % 3], ts(d), ts(d + 100) if d < 800 else None) for u in ("hot", "u3", "u6") for d in range(0, 900, 100)],
                                        "user_id_hash string, acquisition_channel string, valid_from timestamp, valid_to timestamp")
        found = hs.scd2_point_in_time(facts, history, "at", ["acquisition_channel"])
        want = {(r.order_id): "xyz"[(r["at"] - ts(0)).days // 100 * 100 % 3] if r.user_id_hash in ("hot", "u3", "u6") else None for r in facts.collect()}
        text = plan(found)
        assert {r.order_id: r.acquisition_channel for r in found.collect()} == want
        assert text.count("Exchange hashpartitioning") == 2 and "Window" not in text and "SinglePartition" not in text.split("Subquery")[0]
        feats = spark.createDataFrame([(f"u{i % 40}", ts(i % 300), i) for i in range(500)], "user_id_hash string, ft timestamp, v int")
        text = plan(hs.asof_features(facts, feats, "user_id_hash", "at", "ft", ["v"]))
        assert text.count("Exchange hashpartitioning") == 2 and "SortAggregate" not in text and "Join" not in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ranks_are_positions(spark):
    df = spark.range(500).selectExpr("id", "id % 2 as g")
    rows = keyed.ranks(df, ["g"], ["id"], F.floor(F.col("id") / 37).cast("bigint"), "r").collect()
    assert all(r.r == r.id // 2 + 1 for r in rows)


def test_merge_applies_or_ignores_deletes(spark):
    schema = "id string, op string, ts_ms bigint, v int"
    snapshot = spark.createDataFrame([("a", "r", 0, 1), ("b", "r", 0, 1)], schema)
    changes = spark.createDataFrame([("a", "u", 5, 2), ("b", "d", 5, 1), ("c", "c", 1, 3), ("d", "d", 1, 0), ("d", "c", 2, 4)], schema)
    assert {(r.id, r.v) for r in hs.cdc_merge_latest(snapshot, changes, "id").collect()} == {("a", 2), ("c", 3), ("d", 4)}
    assert {(r.id, r.v) for r in hs.cdc_merge_latest(snapshot, changes, "id", apply_deletes=False).collect()} == {("a", 2), ("b", 1), ("c", 3), ("d", 4)}


def test_incremental_sync(spark):
    schema = "id string, day date, v int"
    target = spark.createDataFrame([("a", date(2024, 1, 1), 1), ("a", date(2024, 1, 2), 1)], schema)
    batch = spark.createDataFrame([("a", date(2024, 1, 1), 9), ("a", date(2024, 1, 2), 2), ("a", date(2024, 1, 3), 3)], schema)
    got = {(r.day.day, r.v) for r in hs.incremental_append_dedup(target, batch, ["id", "day"], "day").collect()}
    assert got == {(1, 1), (2, 2), (3, 3)}
    assert hs.incremental_append_dedup(target.limit(0), batch, ["id", "day"], "day").count() == 3
    assert hs.incremental_append_dedup(target, batch.limit(1), ["id", "day"], "day", full_refresh=True).count() == 1


# --- erasure

def silver(spark, path):
    rows = [(f"o{i}", h, i, date(2024, 1, 1 + i % 3)) for i, h in enumerate(["u1", "u2", "u1", "u3", "u3"])]
    df = spark.createDataFrame(rows, "order_id string, user string, total_cents int, run_date date")
    df = df.select("order_id", gv.hash_pii("user", "s").alias("user_id_hash"), "total_cents", "run_date")
    sinks.write_silver_orders(df, path)


def wanted(spark, *users):
    return gv.erasure_requests(spark.createDataFrame([(f"r-{u}", u) for u in users], "request_id string, user_id string"), "s")


def files(path):
    return {p.name: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_erasure_rewrites_only_affected_partitions_and_is_idempotent(spark, tmp_path):
    path = tmp_path / "silver"
    silver(spark, str(path))
    before = files(path)
    assert gv.erase_table(spark, str(path), wanted(spark, "u1"), "run_date") == (2, 2)
    after = spark.read.parquet(str(path))
    assert after.count() == 5 and after.filter("user_id_hash = 'ERASED'").count() == 2
    assert sum(r.total_cents for r in after.collect()) == 10
    kept = [n for n in files(path) if n in before]
    assert len(kept) == 1, "the partition without the user keeps its file"
    assert gv.erase_table(spark, str(path), wanted(spark, "u1"), "run_date") == (0, 0)


def test_erasure_without_match_changes_nothing(spark, tmp_path):
    path = tmp_path / "silver"
    silver(spark, str(path))
    before = files(path)
    assert gv.erase_table(spark, str(path), wanted(spark, "nobody"), "run_date") == (0, 0)
    assert files(path) == before


def test_requests_need_salt_and_user(spark):
    df = spark.createDataFrame([("r", None), ("q", "")], "request_id string, user_id string")
    assert gv.erasure_requests(df, "s").count() == 0
    with pytest.raises(ValueError):
        gv.erasure_requests(df, "")


def test_audit_is_written_for_every_request(spark, tmp_path):
    path = tmp_path / "silver"
    silver(spark, str(path))
    req = wanted(spark, "u1", "nobody")
    counts = gv.erasure_counts(spark.read.parquet(str(path)), req, "run_date")
    gv.write_audit(gv.erasure_audit(req, counts, counts, "run_date", F.lit(ts(0)), "run"), str(tmp_path / "audit"), "run")
    gv.write_audit(gv.erasure_audit(req, counts, counts, "run_date", F.lit(ts(1)), "run2"), str(tmp_path / "audit"), "run2")
    records = [json.loads(x) for p in (tmp_path / "audit").rglob("*.json") for x in p.read_text().splitlines()]
    assert len(records) == 4
    by = {(r["request_id"], r["dag_run_id"]): r for r in records}
    assert by[("r-u1", "run")]["silver"] == {"affected_files": 2, "affected_rows": 2}
    assert by[("r-nobody", "run")]["silver"] == {"affected_files": 0, "affected_rows": 0}
    assert all(len(r["user_id_hash_prefix"]) == 11 and r["user_id_hash_prefix"].endswith("...") for r in records)


def test_retention(spark, tmp_path):
    silver(spark, str(tmp_path / "s"))
    df = spark.read.parquet(str(tmp_path / "s"))
    assert gv.expire_partitions(df, date(2024, 1, 12), 10).count() == 3
