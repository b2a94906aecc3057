"""Change events of users, order items and inventory: checked rows, current tables without identifiers, and a history that ends with a delete."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions import CHANNELS, hash_pii
from orderlake.operators.history import scd2_users, silver_users
from orderlake.operators.keyed import computed_once, latest_per_key

OPERATIONS = ["c", "u", "r", "d"]


class Source(NamedTuple):
    """A source table: its key, its columns, and what a row must meet (a message for rows that don't). A delete needs its key only."""

    table: str
    key: list[str]
    columns: dict[str, str]
    checks: dict[str, Column]


def sources() -> dict[str, Source]:
    given = lambda c: F.coalesce(c, F.lit("")) != ""
    return {s.table: s for s in (
        Source("users", ["user_id"], {c: "string" for c in ("user_id", "email", "first_name", "last_name", "country_code", "acquisition_channel", "created_at", "updated_at")},
               {"invalid acquisition_channel": F.col("acquisition_channel").isin(CHANNELS)}),
        Source("order_items", ["item_id"], {"item_id": "string", "order_id": "string", "product_id": "string", "quantity": "int", "unit_price_cents": "bigint", "discount_cents": "bigint"},
               {"order_id is null": given("order_id"), "product_id is null": given("product_id"), "invalid quantity": F.col("quantity") > 0, "invalid unit_price_cents": F.col("unit_price_cents") >= 0}),
        Source("inventory", ["product_id", "warehouse_id"], {"product_id": "string", "warehouse_id": "string", "quantity_on_hand": "int", "reorder_point": "int", "updated_at": "string"},
               {"invalid quantity_on_hand": F.col("quantity_on_hand") >= 0}))}


def parse_changes(lines: DataFrame, source: Source) -> DataFrame:
    """Envelopes or flattened change rows (JSON text ``value``) to ``op, ts_ms``, the source's columns and ``errors``, next to the other input columns.

    A delete has the old row. Tombstones (null, empty, or the JSON null) are no changes and are left out; whatever else isn't a change event stays
    as a row with an error.
    """
    extra = [c for c in lines.columns if c != "value" and c not in source.columns]
    row = ", ".join(f"{c} {t}" for c, t in source.columns.items())
    shape = f"op string, ts_ms bigint, before struct<{row}>, after struct<{row}>, __op string, __ts_ms bigint, __deleted string, {row}"
    texts = lines.where(~F.trim("value").isin("", "null"))
    got = computed_once(texts, extra, {"v": F.from_json("value", shape)})
    flat = F.col("v.op").isNull() & F.col("v.__op").isNotNull()
    op = F.when(flat & (F.col("v.__deleted") == "true"), "d").otherwise(F.coalesce("v.op", "v.__op"))
    fields = F.when(flat, F.struct(*[F.col(f"v.{c}").alias(c) for c in source.columns])).when(op == "d", F.col("v.before")).otherwise(F.col("v.after"))
    rows = got.select(*extra, op.alias("op"), F.coalesce("v.ts_ms", "v.__ts_ms").alias("ts_ms"), fields.alias("row")).select(*extra, "op", "ts_ms", "row.*")
    problems = [F.when(F.col("ts_ms").isNull(), "ts_ms is null")]
    problems += [F.when(F.coalesce(F.col(k), F.lit("")) == "", f"{k} is null") for k in source.key]
    problems += [F.when((F.col("op") != "d") & ~F.coalesce(met, F.lit(False)), message) for message, met in source.checks.items()]
    known = F.coalesce(F.col("op").isin(OPERATIONS), F.lit(False))
    return rows.withColumn("errors", F.when(known, F.array_compact(F.array(*problems))).otherwise(F.array(F.lit("not a change"))))


def accepted(changes: DataFrame) -> DataFrame:
    return changes.where(F.size("errors") == 0).drop("errors")


def rejected(changes: DataFrame) -> DataFrame:
    return changes.where(F.size("errors") > 0)


def current_rows(changes: DataFrame, source: Source) -> DataFrame:
    """Newest accepted change of each key, unless that is a delete; of equal times a delete wins. A key deleted and created again is there."""
    rows = accepted(changes)
    newest = latest_per_key(rows, source.key, [F.col("ts_ms"), (F.col("op") == "d").cast("int"), F.xxhash64(*rows.columns)])
    return newest.where("op <> 'd'").drop("op")


def users_table(changes: DataFrame, salt: str) -> DataFrame:
    """Current users without identifiers."""
    return silver_users(current_rows(changes, sources()["users"]), salt)


def order_items_table(changes: DataFrame) -> DataFrame:
    source = sources()["order_items"]
    return current_rows(changes, source).select(*source.columns)


def inventory_table(changes: DataFrame) -> DataFrame:
    """Current stock by product and warehouse; ``below_reorder`` marks what is at its reorder point or under it."""
    source = sources()["inventory"]
    rows = current_rows(changes, source).withColumn("updated_at", F.timestamp_millis("ts_ms"))
    return rows.select(*source.columns, (F.col("quantity_on_hand") <= F.col("reorder_point")).alias("below_reorder"))


def user_history(changes: DataFrame, salt: str) -> DataFrame:
    """``scd2_users`` of the accepted changes, by the time of the change. A delete closes the user's last interval and opens none; a user created
    again starts a new one, with a gap between."""
    versions = accepted(changes).select(
        hash_pii("user_id", salt).alias("user_id_hash"), "country_code", "acquisition_channel", F.col("created_at").try_cast("timestamp").alias("created_at"),
        F.timestamp_millis("ts_ms").alias("updated_at"), (F.col("op") == "d").alias("_deleted"))
    return scd2_users(versions).where("not _deleted").drop("_deleted")
