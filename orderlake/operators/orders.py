"""Change events to clean orders: parse, validate, de-duplicate, count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.functions import ORDER_STATUSES, PII_COLUMNS, hash_pii
from orderlake.operators.keyed import computed_once, latest_per_key

SILVER_COLUMNS = [
    "order_id", "user_id_hash", "warehouse_id", "status", "currency", "subtotal_cents", "discount_cents",
    "shipping_cents", "total_cents", "created_at", "updated_at", "cdc_op", "cdc_ts_ms",
]
FILLED_OBJECT = "^OBJECT<[^>]"
CENTS = ["subtotal_cents", "discount_cents", "shipping_cents", "total_cents"]


def _raw(path: str) -> Column:
    """The field as VARIANT: SQL NULL only when the key is absent, a variant null when the JSON value is null."""
    return F.variant_get(F.col("v"), path, "variant")


def _text(path: str) -> Column:
    return F.try_variant_get(F.col("v"), path, "string")


def _kind(column: Column) -> Column:
    return F.schema_of_variant(column)


def parse_json_lines(lines: DataFrame) -> DataFrame:
    """``value`` text plus ``v`` VARIANT; ``v`` is NULL where the line is not a JSON object."""
    texts = lines.filter(F.trim("value") != "")
    # Valid JSON that opens with a brace is an object; other JSON values are not events.
    parsed = F.when(F.ltrim("value").startswith("{"), F.try_parse_json("value"))
    return computed_once(texts, texts.columns, {"v": parsed})


def parse_cdc_orders(events: DataFrame, salt: str) -> DataFrame:
    """Envelope or flattened change rows to order rows.

    Deletes and events without a new row are dropped; defaults apply only when a key is absent, not when it is null.
    """
    extra = [c for c in events.columns if c not in ("value", "v")]
    flat = _raw("$.after").isNull() & _raw("$.__op").isNotNull()
    flat_source = F.to_json(F.struct(_text("$.__source_db").alias("db"), _text("$.__source_table").alias("table")))
    rows = computed_once(events, extra, {
        "v": F.when(flat, F.col("v")).otherwise(_raw("$.after")),
        "cdc_op": F.when(flat, _text("$.__op")).when(_raw("$.op").isNull(), F.lit("c")).otherwise(_text("$.op")),
        "cdc_ts_ms": F.coalesce(F.try_variant_get("v", "$.ts_ms", "bigint"), F.try_variant_get("v", "$.__ts_ms", "bigint")),
        "_bronze_source": F.when(flat, flat_source).otherwise(F.coalesce(_text("$.source"), F.lit("{}"))),
    })
    kept = rows.filter(F.col("cdc_op").isNull() | (F.col("cdc_op") != "d")).filter(
        F.coalesce(_kind(F.col("v")).rlike(FILLED_OBJECT), F.lit(False)))

    # One call reads all fields; those whose absence or JSON type matters stay VARIANT.
    texts = ["order_id", "user_id", "warehouse_id", "status", "created_at", "updated_at"]
    fields = ", ".join([f"{c} string" for c in texts] + [f"{c} variant" for c in ["currency", *CENTS]])
    got = computed_once(kept, [*extra, "cdc_op", "cdc_ts_ms", "_bronze_source"], {"r": F.try_variant_get("v", "$", f"struct<{fields}>")})

    def field(name: str) -> Column:
        return F.col(f"r.{name}")

    def given(name: str, kind: str, default: object) -> Column:
        return F.when(field(name).isNull(), F.lit(default)).otherwise(F.try_variant_get(field(name), "$", kind))

    total_kind = _kind(field("total_cents"))
    return computed_once(got, [*extra, "cdc_op", "cdc_ts_ms", "_bronze_source"], {
        "order_id": field("order_id"),
        "user_id_hash": hash_pii(field("user_id"), salt),
        "warehouse_id": field("warehouse_id"),
        "status": field("status"),
        "currency": given("currency", "string", "USD"),
        **{c: given(c, "bigint", 0).cast("bigint") for c in CENTS},
        "created_at": field("created_at"),
        "updated_at": field("updated_at"),
        "_total_is_int": total_kind.isNull() | (total_kind == "BIGINT"),
    }).select(*extra, *SILVER_COLUMNS, "_bronze_source", "_total_is_int")


def flatten_after(changes: DataFrame, salt: str) -> DataFrame:
    """Creates and updates with the new row's columns at top level, user hashed, identifiers dropped."""
    rows = changes.filter(F.col("op").isin("c", "u")).select("after.*", F.col("op").alias("cdc_op"), F.col("ts_ms").alias("cdc_ts_ms"))
    return drop_pii(rows.withColumn("user_id_hash", hash_pii("user_id", salt)))


def clean_changes(changes: DataFrame, salt: str) -> DataFrame:
    """Typed-source variant: flattened changes, positive totals and known statuses, newest change per order."""
    rows = flatten_after(changes, salt).filter((F.col("total_cents") > 0) & F.col("status").isin(ORDER_STATUSES))
    return dedup_latest(rows)


def drop_pii(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.lower() in PII_COLUMNS])


def strip_internal(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def validate_orders(orders: DataFrame) -> DataFrame:
    """Adds ``errors``; a row is valid when the list is empty."""
    total_ok = F.col("total_cents").isNotNull() & (F.col("total_cents") >= 0)
    if "_total_is_int" in orders.columns:
        total_ok = total_ok & F.col("_total_is_int")
    problems = [
        F.when(F.coalesce(F.col("order_id"), F.lit("")) == "", F.lit("order_id is null")),
        F.when(F.coalesce(F.col("user_id_hash"), F.lit("")) == "", F.lit("user_id_hash is null")),
        F.when(~total_ok, F.concat(F.lit("total_cents invalid: "), F.coalesce(F.col("total_cents").cast("string"), F.lit("None")))),
        F.when(~F.coalesce(F.col("status").isin(ORDER_STATUSES), F.lit(False)),
               F.concat(F.lit("invalid status: "), F.coalesce(F.col("status"), F.lit("None")))),
    ]
    return orders.withColumn("errors", F.array_compact(F.array(*problems)))


def dead_letter_split(lines: DataFrame, salt: str) -> tuple[DataFrame, DataFrame]:
    """(valid order rows, rejected records with reason). Both sides derive from the same parse."""
    parsed = lines if "v" in lines.columns else parse_json_lines(lines)
    dated = [c for c in ("run_date",) if c in parsed.columns]
    bad_json = parsed.filter("v is null").select("value", *dated, F.array(F.lit("not a JSON object")).alias("errors"))
    checked = validate_orders(parse_cdc_orders(parsed.filter("v is not null"), salt))
    valid = checked.filter(F.size("errors") == 0).select(*SILVER_COLUMNS, "_bronze_source", *dated)
    invalid = checked.filter(F.size("errors") > 0).select(F.to_json(F.struct(*SILVER_COLUMNS)).alias("value"), *dated, "errors")
    return valid, bad_json.unionByName(invalid)


def dedup_latest(orders: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Newest change per order; ties broken by update time, then by row content, so reruns agree."""
    return latest_per_key(
        orders, keys or ["order_id"],
        [F.col("cdc_ts_ms"), F.col("updated_at"), F.xxhash64(*orders.columns)],
    )


def dedup_any(orders: DataFrame) -> DataFrame:
    """One row per order, whichever arrives first (the typed source's own rule)."""
    return orders.dropDuplicates(["order_id"])


def silver_orders(lines: DataFrame, salt: str) -> DataFrame:
    valid, _ = dead_letter_split(lines, salt)
    keys = ["run_date", "order_id"] if "run_date" in valid.columns else ["order_id"]
    return strip_internal(dedup_latest(valid, keys))


def transform_metrics(checked: DataFrame, by: list[str] | None = None) -> DataFrame:
    """processed / valid / invalid / deduplicated in one pass over validated rows."""
    by = by or []
    ok = F.size("errors") == 0
    counted = checked.groupBy(*by).agg(
        F.count(F.lit(1)).alias("processed"),
        F.count_if(ok).alias("_ok"),
        F.count_if(~ok).alias("invalid"),
        F.count_distinct(F.when(ok, F.col("order_id"))).alias("valid"),
    )
    return counted.select(*by, "processed", "valid", "invalid", (F.col("_ok") - F.col("valid")).alias("deduplicated"))
