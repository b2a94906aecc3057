import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from orderlake.operators import orders as od
from orderlake.operators.governance import backfill, check_range
from orderlake.sources import bronze, sinks

SALT = "s"


def change(order_id="o1", op="c", ts=1000, **over):
    after = {"order_id": order_id, "user_id": "u1", "warehouse_id": "w", "status": "placed", "currency": "USD", "subtotal_cents": 900,
             "discount_cents": 0, "shipping_cents": 100, "total_cents": 1000, "created_at": "2024-04-25T10:00:00+00:00",
             "updated_at": "2024-04-25T10:00:00+00:00"}
    drop = over.pop("drop", [])
    after.update(over)
    return {"op": op, "ts_ms": ts, "before": None, "after": None if op == "d" else {k: v for k, v in after.items() if k not in drop},
            "source": {"db": "shop"}}


def lines(spark, items):
    return spark.createDataFrame([(i if isinstance(i, str) else json.dumps(i),) for i in items], "value string")


def parsed(spark, items):
    return od.parse_cdc_orders(od.parse_json_lines(lines(spark, items)).filter("v is not null"), SALT)


def test_create_update_and_snapshot_are_kept_delete_is_not(spark):
    rows = parsed(spark, [change("a"), change("b", op="u"), change("c", op="r"), change("d", op="d")]).collect()
    assert sorted(r.order_id for r in rows) == ["a", "b", "c"]


@pytest.mark.parametrize("item", [{"op": "c"}, {"op": "c", "after": None}, {"op": "c", "after": {}}, {}])
def test_events_without_a_row_are_dropped(spark, item):
    assert parsed(spark, [item]).count() == 0


def test_missing_op_is_create(spark):
    item = change()
    del item["op"]
    assert parsed(spark, [item]).first().cdc_op == "c"


def test_defaults_apply_to_missing_keys_only(spark):
    row = parsed(spark, [change(drop=["currency", "discount_cents"])]).first()
    assert (row.currency, row.discount_cents) == ("USD", 0)
    row = parsed(spark, [change(currency=None, discount_cents=None)]).first()
    assert (row.currency, row.discount_cents) == (None, None)


def errors(spark, **over):
    return od.validate_orders(parsed(spark, [change(**over)])).first().errors


def test_valid_rows_have_no_errors(spark):
    assert errors(spark) == []
    for status in od.ORDER_STATUSES:
        assert errors(spark, status=status) == []


@pytest.mark.parametrize("over,text", [
    ({"order_id": None}, "order_id"), ({"order_id": ""}, "order_id"), ({"user_id": None}, "user_id_hash"), ({"total_cents": -1}, "total_cents"),
    ({"total_cents": None}, "total_cents"), ({"total_cents": "5"}, "total_cents"), ({"total_cents": 5.0}, "total_cents"), ({"status": "lost"}, "status"),
    ({"status": None}, "status")])
def test_invalid_rows(spark, over, text):
    found = errors(spark, **over)
    assert len(found) == 1 and text in found[0]


def test_zero_and_missing_totals_are_valid(spark):
    assert errors(spark, total_cents=0) == []
    assert errors(spark, drop=["total_cents"]) == []


def test_several_errors_are_all_reported(spark):
    assert len(errors(spark, order_id=None, status="x", total_cents=-5)) == 3


def test_dedup_keeps_latest_and_is_stable(spark):
    items = [change("o", ts=1000, status="placed"), change("o", ts=2000, status="shipped"), change("p", ts=5)]
    valid, _ = od.dead_letter_split(lines(spark, items), SALT)
    once = od.dedup_latest(valid)
    assert {r.order_id: r.status for r in once.collect()} == {"o": "shipped", "p": "placed"}
    assert sorted(map(str, od.dedup_latest(once).collect())) == sorted(map(str, once.collect()))


def test_dedup_missing_time_loses(spark):
    items = [change("o", ts=None, status="placed"), change("o", ts=1, status="shipped")]
    assert od.dedup_latest(parsed(spark, items)).first().status == "shipped"


def test_dead_letters_hold_bad_lines_and_bad_rows(spark):
    valid, rejected = od.dead_letter_split(lines(spark, ["not json", "[1]", "", "  ", change("ok"), change("bad", status="lost")]), SALT)
    assert [r.order_id for r in valid.collect()] == ["ok"]
    assert rejected.count() == 3


def test_metrics(spark):
    items = [change(f"o{i}") for i in range(5)] + [change("o1", ts=2000), change("x", status="lost"), change("gone", op="d")]
    row = od.transform_metrics(od.validate_orders(parsed(spark, items))).first()
    assert (row.processed, row.valid, row.invalid, row.deduplicated) == (7, 5, 1, 1)


def test_end_to_end_set(spark):
    statuses = ["placed", "shipped", "delivered", "delivered", "placed"]
    items = [change(f"o{i}", user_id=f"u{i % 5}", total_cents=(i % 3 + 1) * [999, 2999, 4999, 8999][i % 4] + 499, status=statuses[i % 5]) for i in range(25)]
    items += [change("del", op="d"), change("bad", status="nope")]
    silver = od.silver_orders(lines(spark, items), SALT)
    assert silver.count() == 25
    assert "user_id" not in silver.columns and silver.select("user_id_hash").distinct().count() == 5


def test_flattened_events_are_accepted(spark):
    flat = {**change()["after"], "__op": "u", "__ts_ms": 77, "__source_db": "shop", "__source_table": "orders"}
    row = parsed(spark, [flat]).first()
    assert (row.order_id, row.cdc_op, row.cdc_ts_ms) == ("o1", "u", 77)


def test_typed_path_hashes_null_users_to_null(spark, tmp_path):
    (tmp_path / "a.json").write_text("\n".join(json.dumps(c) for c in [change("a"), change("b", user_id=None), change("c", total_cents=0), change("d", op="r")]))
    rows = od.clean_changes(bronze.read_bronze_json(spark, str(tmp_path)), SALT).collect()
    got = {r.order_id: r.user_id_hash for r in rows}
    assert set(got) == {"a", "b"} and got["b"] is None and len(got["a"]) == 64


def test_unwrap_marks_deletes(spark, tmp_path):
    gone = change("d", op="d")
    gone["before"] = change("d")["after"]
    (tmp_path / "a.json").write_text("\n".join(json.dumps(c) for c in [change("a"), gone]))
    rows = {r.order_id: r for r in bronze.cdc_unwrap(bronze.read_bronze_json(spark, str(tmp_path))).collect()}
    assert rows["a"]["__deleted"] == "false" and rows["d"]["__deleted"] == "true" and rows["d"]["pipeline_version"] == "1.0"


def write_day(root, day, items):
    folder = root / "orders" / day
    folder.mkdir(parents=True)
    (folder / "x.jsonl").write_text("\n".join(i if isinstance(i, str) else json.dumps(i) for i in items))


def test_dated_folders_and_backfill(spark, tmp_path):
    write_day(tmp_path, "2024-04-24", [change("old")])
    write_day(tmp_path, "2024-04-25", [change("a"), change("a", ts=2000, status="shipped"), "{bad", change("b", status="lost")])
    write_day(tmp_path, "2024-04-27", [change("c")])
    (tmp_path / "orders" / "2024-04-25" / "ignored.txt").write_text(json.dumps(change("zzz")))
    out = str(tmp_path / "silver")
    metrics = {str(r.run_date): r for r in backfill(spark, str(tmp_path), out, date(2024, 4, 25), date(2024, 4, 27), SALT).collect()}
    assert set(metrics) == {"2024-04-25", "2024-04-27"}
    assert (metrics["2024-04-25"].processed, metrics["2024-04-25"].valid, metrics["2024-04-25"].invalid) == (3, 1, 1)
    backfill(spark, str(tmp_path), out, date(2024, 4, 24), date(2024, 4, 24), SALT)
    backfill(spark, str(tmp_path), out, date(2024, 4, 25), date(2024, 4, 25), SALT)
    assert {(r.order_id, r.status) for r in spark.read.parquet(out).collect()} == {("old", "placed"), ("a", "shipped"), ("c", "placed")}


def test_backfill_dry_run_and_range(spark, tmp_path):
    write_day(tmp_path, "2024-04-25", [change("a")])
    assert backfill(spark, str(tmp_path), str(tmp_path / "s"), date(2024, 4, 25), date(2024, 4, 25), SALT, dry_run=True).count() == 1
    assert not (tmp_path / "s").exists()
    with pytest.raises(ValueError):
        check_range(date(2024, 4, 26), date(2024, 4, 25))
    assert bronze.read_bronze_orders(spark, str(tmp_path), date(2020, 1, 1)).count() == 0


def test_mixed_files_skip_unreadable_parquet(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1)], "order_id string, total_cents bigint")
    rows.write.parquet(str(tmp_path / "p"))
    (tmp_path / "p" / "broken.parquet").write_bytes(b"not parquet")
    (tmp_path / "x.csv").write_text("order_id,total_cents\nb,2\n")
    got = bronze.read_silver_mixed(spark, str(tmp_path / "p"), str(tmp_path / "x.csv"), rows.schema)
    assert sorted(r.order_id for r in got.collect()) == ["a", "b"]


def test_upsert_and_first_wins(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    incoming = spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int")
    assert {(r.k, r.v) for r in sinks.upsert_last_wins(target, incoming, ["k"]).collect()} == {("a", 1), ("b", 3), ("c", 4)}
    arriving = spark.createDataFrame([("a", 9, 1), ("c", 1, 2), ("c", 2, 1)], "k string, v int, t int")
    got = sinks.insert_first_wins(target, arriving, "k", "t", "v").collect()
    assert [(r.k, r.v) for r in got] == [("c", 2)]


def test_repeated_order_collapses_before_its_one_shuffle(spark, plan):
    hot = spark.range(5000).select((F.col("id") % 1).cast("string").alias("order_id"), F.col("id").alias("cdc_ts_ms"), F.lit("x").alias("updated_at"))
    df = od.dedup_latest(hot)
    assert df.collect()[0].cdc_ts_ms == 4999
    text = plan(df)
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in text
