"""Readers for raw change and click events and for clean tables; change-envelope handling."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlake.operators.orders import parse_json_lines
from orderlake.schemas import ORDER_CHANGE

TABLES = ["orders", "order_items", "users", "inventory"]
TOPIC_PATTERN = r"^[A-Za-z0-9_]+\.(orders|order_items|users|inventory)$"
CONNECTOR_VERSION = "1.0"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines plus their parsed VARIANT; blank lines are skipped, unreadable lines keep ``v`` NULL."""
    return parse_json_lines(spark.read.text(path))


def read_dated_lines(spark: SparkSession, folder: str, start: date, end: date, pattern: str = "*.jsonl") -> DataFrame:
    """Lines of the inclusive date range below ``folder/<date>/`` (or ``run_date=<date>/``) with their ``run_date``.

    Only the folders of the range are listed; days without a folder are simply absent.
    """
    days = [(start + timedelta(days=i)).isoformat() for i in range((end - start).days + 1)]
    names = ",".join([*days, *[f"run_date={d}" for d in days]])
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    try:
        text = reader.text(f"{folder}/{{{names}}}")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return parse_json_lines(spark.createDataFrame([], "value string, run_date date"))
    found = F.regexp_extract(F.col("_metadata.file_path"), r"/(?:run_date=)?(\d{4}-\d{2}-\d{2})/[^/]*$", 1)
    return parse_json_lines(text.select("value", found.cast("date").alias("run_date")))


def read_bronze_orders(spark: SparkSession, root: str, start: date, end: date | None = None, pattern: str = "*.jsonl") -> DataFrame:
    """Parsed order change lines of a day or range; unreadable lines stay, with ``v`` NULL, for the dead-letter split."""
    return read_dated_lines(spark, f"{root}/orders", start, end or start, pattern)


def read_bronze_events(spark: SparkSession, root: str, start: date, end: date | None = None, pattern: str = "*.jsonl") -> DataFrame:
    """Parsed click lines of a day or range; unreadable lines are dropped."""
    return read_dated_lines(spark, f"{root}/events", start, end or start, pattern).filter("v is not null")


def read_bronze_json(spark: SparkSession, path: str, schema: T.StructType = ORDER_CHANGE) -> DataFrame:
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def change_stream(spark: SparkSession, source: str, location: str, topics: str | None = None, per_trigger: int = 100) -> DataFrame:
    """Streaming change lines (column ``value``) from Kafka or from a folder of JSON lines.

    Kafka needs the connector package on the cluster; the folder source needs nothing.
    """
    if source == "kafka":
        stream = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", location)
                  .option("subscribePattern", topics or TOPIC_PATTERN).option("startingOffsets", "earliest")
                  .option("maxOffsetsPerTrigger", per_trigger * 10_000).load())
        return stream.select("topic", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))
    if source != "text":
        raise ValueError(f"unknown change source: {source}")
    return spark.readStream.option("maxFilesPerTrigger", per_trigger).text(location)


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """Clean tables; files written with different column sets are merged."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def read_silver_mixed(spark: SparkSession, parquet_path: str | None, csv_path: str | None, schema: T.StructType) -> DataFrame:
    """Union of Parquet and CSV files of one table; Parquet files that cannot be read are skipped."""
    frames = []
    if parquet_path:
        frames.append(spark.read.schema(schema).option("ignoreCorruptFiles", "true").parquet(parquet_path))
    if csv_path:
        frames.append(spark.read.schema(schema).option("header", "true").csv(csv_path))
    return concat_files(frames)


def concat_files(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def cdc_unwrap(changes: DataFrame) -> DataFrame:
    """Flatten envelopes to the row itself; a delete keeps the old row, marked ``__deleted = 'true'``."""
    fields = changes.schema["after"].dataType.fieldNames()
    row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.coalesce("after", "before"))
    return changes.withColumn("_row", row).select(
        *[F.col(f"_row.{f}").alias(f) for f in fields],
        F.col("op").alias("__op"), F.col("ts_ms").alias("__ts_ms"),
        F.col("source.db").alias("__source_db"), F.col("source.table").alias("__source_table"),
        F.when(F.col("op") == "d", "true").otherwise("false").alias("__deleted"),
        F.lit(CONNECTOR_VERSION).alias("pipeline_version"))


def topic_fanout(messages: DataFrame, pattern: str = TOPIC_PATTERN) -> DataFrame:
    """Messages of the listed tables with a ``table`` column to partition the write by."""
    return messages.filter(F.col("topic").rlike(pattern)).withColumn("table", F.element_at(F.split("topic", r"\."), -1))


def record_time(ts_ms: Column) -> list[Column]:
    at = F.timestamp_millis(ts_ms)
    return [F.date_format(at, p).alias(n) for n, p in (("year", "yyyy"), ("month", "MM"), ("day", "dd"), ("hour", "HH"))]
