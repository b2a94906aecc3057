"""Writers. All are idempotent per partition, key or run, so a retried job leaves the same table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.operators.gold import z_order_fact
from orderlake.operators.keyed import latest_per_key
from orderlake.session import scratch
from orderlake.sources.bronze import record_time

JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
STORED = "zstd"  # hex digests take half the room that they take under the default
HOUR = ["year", "month", "day", "hour"]


def write_partitioned(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace exactly the partitions present in ``df``. Adaptive execution sizes the files; a large partition is split."""
    df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", STORED).partitionBy(*by).parquet(path)


def write_bronze_partitioned(changes: DataFrame, path: str, run_id: str, ts_ms: str = "ts_ms") -> None:
    """Snappy Parquet by UTC hour of the record's own time, under the run's id: a run that is written again replaces itself only."""
    rows = changes.select("*", *record_time(F.col(ts_ms)), F.lit(run_id).alias("run_id"))
    by = [*HOUR, "run_id"]
    rows.hint("rebalance", *HOUR).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy").partitionBy(*by).parquet(path)


def write_silver_orders(orders: DataFrame, path: str) -> None:
    write_partitioned(orders, path, ["run_date"])


def write_silver_by_status(orders: DataFrame, path: str) -> None:
    write_partitioned(orders, path, ["status"])


def write_silver_sessions(sessions: DataFrame, path: str) -> None:
    write_partitioned(sessions, path, ["run_date"])


def write_forecast(forecast: DataFrame, path: str) -> None:
    forecast.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def write_clustered_fact(fact: DataFrame, path: str, files: int, row_group_bytes: int = 32 << 20) -> None:
    """Facts in Z-order; the row groups' minima and maxima of date and user let readers skip most of them for either filter."""
    rows = z_order_fact(fact, files).write.mode("overwrite").option("partitionOverwriteMode", "static")
    rows.option("parquet.block.size", str(row_group_bytes)).parquet(path)


def append_jsonl(rows: DataFrame, path: str, run_id: str) -> None:
    """Add a run's lines in its own folder; the same run written again replaces them."""
    rows.write.mode("overwrite").option("timestampFormat", JSON_TIME).json(f"{path}/run_id={run_id}")


def keyed_json(rows: DataFrame, key: str) -> DataFrame:
    """(key, value) messages ready for a Kafka or file sink."""
    return rows.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*rows.columns)).alias("value"))


def upsert_last_wins(target: DataFrame, incoming: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """Target with incoming rows inserted or replacing the row of the same key; the newest incoming row of a key wins."""
    ranked = [F.col(c) for c in order or []] + [F.xxhash64(*incoming.columns)]
    fresh = latest_per_key(incoming, keys, ranked)
    return target.join(fresh.select(*keys), keys, "left_anti").select(*target.columns).unionByName(fresh)


def insert_first_wins(target: DataFrame, incoming: DataFrame, key: str, ts: str, tie: str) -> DataFrame:
    """Rows to insert: first arrival per key among ``incoming``, and only keys the target does not hold."""
    rest = [c for c in incoming.columns if c != key]
    first = incoming.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(ts, tie)).alias("row")).select(key, "row.*").select(*incoming.columns)
    return first.join(target.select(key), key, "left_anti")


def replay_events(fact: DataFrame, date_from=None, date_to=None) -> DataFrame:
    """Facts of an inclusive date range as live order events, oldest first."""
    rows = fact
    if date_from is not None:
        rows = rows.filter(F.col("order_date") >= F.lit(date_from).cast("timestamp"))
    if date_to is not None:
        rows = rows.filter(F.col("order_date") <= F.lit(date_to).cast("timestamp"))
    channel = F.col("channel") if "channel" in fact.columns else F.lit("organic")
    return rows.orderBy("created_at", "order_id").select(
        F.concat(F.lit("replay-"), "order_id").alias("event_id"), "order_id", F.lit("c").alias("op"), "user_id_hash",
        F.lit("REPLAY").alias("sku"), "warehouse_id", F.col("order_status").alias("status"), "currency", channel.alias("channel"),
        F.lit(1).alias("qty"), F.col("total_cents").alias("unit_price_cents"), "discount_cents", "shipping_cents", "total_cents",
        F.col("created_at").alias("occurred_at"))


def materialize(df: DataFrame, name: str, kind: str, path: str | None = None) -> DataFrame:
    """``view`` registers a temporary view, ``ephemeral`` stays inlined, ``table`` is fully rebuilt at ``path``."""
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if kind == "ephemeral":
        return df
    if kind != "table":
        raise ValueError(f"unknown materialization: {kind}")
    path = path or scratch(spark, name)
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return spark.read.parquet(path)


def rewrite_partitions(spark: SparkSession, rows: DataFrame, path: str, by: str) -> None:
    """Overwrite partitions of a table that ``rows`` itself was read from.

    The new content is first written beside the table, so a lost executor or a failed job never leaves a half-read source.
    """
    staging = scratch(spark, "staging")
    rows.write.partitionBy(by).parquet(staging)
    write_partitioned(spark.read.schema(rows.schema).parquet(staging).select(*rows.columns), path, [by])
