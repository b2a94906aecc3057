"""Stored tables that are changed by partition."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from orderlake.operators import governance as gv
from orderlake.sources import merge as mg
from orderlake.sources import sinks

SCHEMA = "order_id int, status string, ts_ms bigint, run_date date"


def files(path):
    return {p for p in path.rglob("*.parquet")}


def rows(ids, status="placed", ts=1, move=None):
    return [(i, status, ts, move or date(2024, 1 + i // 100, 1)) for i in ids]


@pytest.fixture
def table(spark, tmp_path):
    t = mg.KeyedTable(str(tmp_path / "t"), ["order_id"], "run_date")
    t.write(spark.createDataFrame(rows(range(1000)), SCHEMA))
    return t


def content(spark, table):
    return {r.order_id: (r.status, r.ts_ms, r.run_date) for r in table.read(spark).select("order_id", "status", "ts_ms", "run_date").collect()}


def test_a_sync_opens_and_rewrites_only_partitions_with_its_keys(spark, table, tmp_path):
    before = files(tmp_path / "t" / "rows")
    batch = rows(range(205, 210), "shipped", 5) + rows([205], "old", 3) + rows([2000], "new", 1, date(2024, 10, 1))
    told = table.merge(spark.createDataFrame(batch, SCHEMA), ["ts_ms"])
    assert told == {"partitions": 10, "opened": 2, "rows_written": 201}
    kept = {p for p in before if p.exists()}
    assert {p.parent.name for p in before - kept} == {"run_date=2024-03-01", "run_date=2024-10-01"}
    want = {i: ("placed", 1, date(2024, 1 + i // 100, 1)) for i in range(1000)}
    want |= {i: ("shipped", 5, date(2024, 3, 1)) for i in range(205, 210)} | {2000: ("new", 1, date(2024, 10, 1))}
    assert content(spark, table) == want
    table.merge(spark.createDataFrame(batch, SCHEMA), ["ts_ms"])
    assert content(spark, table) == want
    table.merge(spark.createDataFrame(rows([206], "stale", 4), SCHEMA), ["ts_ms"])
    assert content(spark, table) == want


def test_keys_move_and_go(spark, table):
    batch = [(i, "gone", 9, "d", date(2024, 4, 1)) for i in range(300, 400)] + [(7, "moved", 9, "u", date(2024, 5, 1)), (8, "back", 9, "d", date(2024, 1, 1)), (8, "back", 10, "c", date(2024, 1, 1))]
    frame = spark.createDataFrame(batch, "order_id int, status string, ts_ms bigint, op string, run_date date")
    table.merge(frame, ["ts_ms"], F.col("op") == "d")
    got = content(spark, table)
    assert got[7] == ("moved", 9, date(2024, 5, 1)) and got[8] == ("back", 10, date(2024, 1, 1)) and len(got) == 900
    assert "2024-04-01" not in mg.partition_folders(spark, table.path + "/rows", "run_date")
    table.merge(spark.createDataFrame(rows([350], "again", 11), SCHEMA), ["ts_ms"])
    assert content(spark, table)[350] == ("again", 11, date(2024, 4, 1))
    assert table.merge(spark.createDataFrame([], SCHEMA), ["ts_ms"])["rows_written"] == 0


def wanted(spark, *users):
    return gv.erasure_requests(spark.createDataFrame([(f"r-{u}", u) for u in users], "request_id string, user_id string"), "s")


def test_erasure_in_every_table_and_records_from_the_rewrite(spark, tmp_path):
    def put(name, by, users):
        df = spark.createDataFrame([(f"{name}{i}", u, date(2024, 1, 1 + i % 4)) for i, u in enumerate(users)], f"id string, user string, {by} date")
        sinks.write_partitioned(df.select("id", gv.hash_pii("user", "s").alias("user_id_hash"), by), str(tmp_path / name), [by])
        return mg.Holder("gold" if name == "fact" else "silver", str(tmp_path / name), by)
    holders = {"orders": put("orders", "run_date", ["a", "b", "a", "c", "a", None]), "sessions": put("sessions", "day", ["b", "b"]), "fact": put("fact", "order_date", ["c", "a", "c", "c", "b"])}
    before = {n: files(tmp_path / n) for n in holders}
    req = wanted(spark, "a", "b", "nobody")
    ledger = mg.erase_everywhere(spark, holders, req)
    hashes = {r.request_id: r.user_id_hash for r in req.collect()}
    got = {(r["table"], r["user_id_hash"]): (r["partitions"], r["rows"]) for r in ledger.collect()}
    assert got == {("orders", hashes["r-a"]): (2, 3), ("orders", hashes["r-b"]): (1, 1), ("sessions", hashes["r-b"]): (2, 2), ("fact", hashes["r-a"]): (1, 1), ("fact", hashes["r-b"]): (1, 1)}
    for name in holders:
        after = spark.read.parquet(str(tmp_path / name))
        assert after.where(F.col("user_id_hash").isin(list(hashes.values()))).count() == 0
    assert spark.read.parquet(str(tmp_path / "orders")).where("user_id_hash = 'ERASED'").count() == 4 and spark.read.parquet(str(tmp_path / "orders")).count() == 6
    assert any(p.exists() for p in before["orders"]) and any(p.exists() for p in before["fact"])
    records = {r.request_id: r for r in mg.erasure_records(req, ledger, F.lit(datetime(2024, 1, 1)), "run").collect()}
    assert (records["r-a"].silver.affected_files, records["r-a"].silver.affected_rows, records["r-a"].gold.affected_rows) == (2, 3, 1)
    assert (records["r-nobody"].silver.affected_rows, records["r-nobody"].gold.affected_rows) == (0, 0)
    assert mg.erase_everywhere(spark, holders, req).count() == 0


def test_expired_partitions_are_deleted(spark, table):
    assert mg.expire_stored(spark, table.path + "/rows", "run_date", "2024-03-01") == ["2024-01-01", "2024-02-01"]
    assert min(content(spark, table)) == 200
    assert mg.expire_stored(spark, table.path + "/rows", "run_date", "2024-03-01") == []
