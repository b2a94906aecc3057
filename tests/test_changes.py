import json
from datetime import datetime

import pytest

from orderlake.operators import changes as ch
from orderlake.plans import changes as plans
from orderlake.sources import bronze

SALT = "s"


def user(n, channel="email", **more):
    return {"user_id": n, "email": "a@b.c", "country_code": "US", "acquisition_channel": channel, "created_at": "2024-01-01T00:00:00Z", "updated_at": "x"} | more


def change(op, ts, row):
    return json.dumps({"op": op, "ts_ms": ts, "before" if op == "d" else "after": row})


def flat(op, ts, row):
    return json.dumps(row | {"__op": op, "__ts_ms": ts, "__deleted": str(op == "d").lower()})


def parsed(spark, lines, table="users"):
    return ch.parse_changes(spark.createDataFrame([(x,) for x in lines], "value string"), ch.sources()[table])


def test_both_forms_deletes_and_tombstones(spark):
    lines = [change("c", 1, user("a")), flat("u", 2, user("a", "referral")), change("r", 1, user("b")), flat("d", 3, user("b", None)), None, "", "null",
             change("c", 1, user("c")), change("d", 2, {"user_id": "c"}), change("c", 5, user("c", "organic"))]
    rows = {r.acquisition_channel: r for r in ch.users_table(parsed(spark, lines), SALT).collect()}
    assert set(rows) == {"referral", "organic"}
    assert set(rows["organic"].asDict()) == {"user_id_hash", "country_code", "acquisition_channel", "created_at", "updated_at"} and len(rows["organic"].user_id_hash) == 64


def test_what_is_no_change_is_rejected(spark):
    lines = ["oops", "[1]", "{}", change("x", 1, user("a")), change("c", None, user("a")), change("c", 1, user("")), change("u", 1, user("a", "pigeon")), change("c", 1, None), change("d", 1, user("a", "pigeon"))]
    got = sorted(",".join(r.errors) for r in ch.rejected(parsed(spark, lines)).collect())
    assert got == sorted(["not a change"] * 4 + ["ts_ms is null", "user_id is null", "invalid acquisition_channel", "user_id is null,invalid acquisition_channel"])
    assert ch.accepted(parsed(spark, lines)).count() == 1 and ch.users_table(parsed(spark, lines[:3]), SALT).count() == 0


def test_history_ends_with_a_delete_and_starts_again(spark):
    lines = [change("c", 1000, user("a")), change("u", 2000, user("a", "referral")), change("d", 3000, user("a")), change("c", 9000, user("a", "organic")), change("d", 500, user("b"))]
    got = [(r.acquisition_channel, r.valid_from.timestamp(), r.valid_to and r.valid_to.timestamp()) for r in ch.user_history(parsed(spark, lines), SALT).orderBy("valid_from").collect()]
    assert got == [("email", 1, 2), ("referral", 2, 3), ("organic", 9, None)]


def test_of_equal_times_the_delete_wins_and_repeats_change_nothing(spark):
    item = {"item_id": "i", "order_id": "o", "product_id": "p", "quantity": 2, "unit_price_cents": 5, "discount_cents": 0}
    lines = [change("c", 1, item)] * 3 + [change("c", 4, item | {"item_id": "j"}), flat("d", 4, item | {"item_id": "j"}), change("u", 2, item | {"quantity": 0}), change("u", 2, item | {"quantity": "many"})]
    rows = parsed(spark, lines, "order_items")
    assert [tuple(r) for r in ch.order_items_table(rows).collect()] == [("i", "o", "p", 2, 5, 0)]
    assert [r.errors for r in ch.rejected(rows).collect()] == [["invalid quantity"]] * 2


def test_stock_by_product_and_warehouse(spark):
    row = {"product_id": "p", "warehouse_id": "w", "quantity_on_hand": 11, "reorder_point": 10}
    lines = [change("c", 1, row), change("u", 2000, row | {"quantity_on_hand": 10}), change("u", 3, row | {"warehouse_id": "v"}), change("u", 9, row | {"quantity_on_hand": -1})]
    got = {r.warehouse_id: (r.quantity_on_hand, r.below_reorder, r.updated_at) for r in ch.inventory_table(parsed(spark, lines, "inventory")).collect()}
    assert got["w"] == (10, True, datetime.fromtimestamp(2)) and got["v"][:2] == (11, False)


def test_other_columns_stay_and_extra_names_do_not_clash(spark):
    lines = spark.createDataFrame([(change("c", 1, user("a")), "t", "mine")], "value string, topic string, email string")
    (row,) = ch.parse_changes(lines, ch.sources()["users"]).collect()
    assert row.topic == "t" and row.email == "a@b.c" and row.errors == []


def test_one_table_reads_its_folder_only(spark, sf, plan):
    path = plans.topic_folder(spark, sf, ["users", "inventory"])
    assert sorted(r["table"] for r in bronze.read_silver(spark, path).select("table").distinct().collect()) == ["inventory", "users"]
    text = plan(plans.arrived(spark, sf, "users", path))
    assert "PartitionFilters: [isnotnull(table" in text and text.count("from_json") == 1


@pytest.mark.parametrize("table", ["users", "order_items", "inventory"])
def test_current_rows_shuffle_once(spark, sf, plan, table):
    rows = plans.arrived(spark, sf, table)
    assert plan(ch.current_rows(rows, ch.sources()[table])).count("Exchange hashpartitioning") == 1
