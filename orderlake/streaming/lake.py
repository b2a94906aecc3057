"""Streaming Bronze and Silver: hourly raw files committed by batch, and clean orders whose batches are compacted as they come.

Both sinks are batch functions. What a batch writes stands under its id, so a repeated batch replaces itself and nothing else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.operators.keyed import latest_per_key
from orderlake.operators.orders import SILVER_COLUMNS, dead_letter_split, dedup_latest, parse_json_lines
from orderlake.session import scratch, shuffles_dropped
from orderlake.sources.bronze import record_time
from orderlake.sources.merge import delete_folder
from orderlake.sources.sinks import HOUR, STORED

BUCKETS = 16
TURN = 4  # buckets merged at a time: so much of the table is in shuffle files at once


def hourly_bronze_sink(path: str, ts_ms: str = "ts_ms"):
    """Raw rows by the UTC hour of their own time and the batch that brought them: ``year/month/day/hour/batch_id``. A batch may hold rows of many hours."""
    def each(batch: DataFrame, batch_id: int) -> None:
        rows = batch.select("*", *record_time(F.col(ts_ms)), F.lit(batch_id).cast("bigint").alias("batch_id"))
        writer = rows.hint("rebalance", *HOUR).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
        writer.partitionBy(*HOUR, "batch_id").parquet(path)
    return each


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("order_id"), F.lit(buckets)).cast("int")


class SilverLake:
    """Clean orders of a stream, newest per order, in buckets of orders with two slots each.

    A batch is merged into the buckets it touches: the newest slot from before the batch is read, merged, and written to the other slot. So the
    current table is one slot per bucket, nothing is left to deduplicate when it is read, and space stays within twice the table. Rejected lines stand under the batch id.
    Nothing is held in executors' memory between steps: a batch's clean orders are staged in the shared folder.
    """

    def __init__(self, spark: SparkSession, path: str, salt: str, buckets: int = BUCKETS) -> None:
        self.path, self.salt, self.buckets = path, salt, buckets
        empty = dead_letter_split(parse_json_lines(spark.createDataFrame([], "value string")), salt)[0].select(*SILVER_COLUMNS)
        self.schema = empty.withColumns({"version": F.lit(0).cast("bigint"), "bucket": F.lit(0), "slot": F.lit(0)}).schema
        spark.createDataFrame([], self.schema).write.mode("append").partitionBy("bucket", "slot").parquet(f"{path}/orders")

    def _slots(self, spark: SparkSession, before: int | None) -> tuple[DataFrame, DataFrame]:
        """All rows, and each bucket's newest (version, slot) from before a batch: at most one row per bucket."""
        rows = spark.read.schema(self.schema).parquet(f"{self.path}/orders")
        known = rows if before is None else rows.where(F.col("version") < before)
        return rows, known.groupBy("bucket").agg(F.max_by("slot", "version").alias("slot"))

    def read(self, spark: SparkSession) -> DataFrame:
        rows, newest = self._slots(spark, None)
        return rows.join(F.broadcast(newest), ["bucket", "slot"]).select(*SILVER_COLUMNS)

    def sink(self):
        def each(batch: DataFrame, batch_id: int) -> None:
            spark = batch.sparkSession
            staged = scratch(spark, "lake-batch")
            try:
                with shuffles_dropped(spark):
                    # Lines and their parse take several times the room of the clean orders, so those are what is kept until the batch ends.
                    valid, rejected = dead_letter_split(parse_json_lines(batch.select("value")), self.salt)
                    rejected.write.mode("overwrite").option("compression", STORED).parquet(f"{self.path}/rejected/batch_id={batch_id}")
                    fresh = dedup_latest(valid.select(*SILVER_COLUMNS)).withColumn("bucket", _bucket(self.buckets))
                    fresh.write.option("compression", STORED).parquet(staged)
                    fresh = spark.read.schema(fresh.schema).parquet(staged)
                    touched = sorted(r[0] for r in fresh.select("bucket").distinct().collect())
                    for i in range(0, len(touched), TURN):
                        self._merge(fresh, touched[i : i + TURN], batch_id)
            finally:
                delete_folder(spark, staged)
        return each

    def _merge(self, fresh: DataFrame, buckets: list[int], batch_id: int) -> None:
        """Merge these buckets' part of a batch. Rows are shuffled once, to parts of a bucket that are written as they are."""
        spark = fresh.sparkSession
        rows, newest = self._slots(spark, batch_id)
        slots = {r["bucket"]: r["slot"] for r in newest.where(F.col("bucket").isin(buckets)).collect()}
        known = F.lit(False)
        for bucket, slot in slots.items():
            known |= (F.col("bucket") == bucket) & (F.col("slot") == slot)
        held = rows.where(known & (F.col("version") < batch_id))
        parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // len(buckets))
        part = F.pmod(F.shiftright(F.xxhash64("order_id"), 32), F.lit(parts))
        both = held.select(*SILVER_COLUMNS, "bucket").unionByName(fresh.where(F.col("bucket").isin(buckets))).withColumn("_part", part)
        merged = latest_per_key(both.repartition("bucket", "_part"), ["bucket", "_part", "order_id"],
                                [F.col("cdc_ts_ms"), F.col("updated_at"), F.xxhash64(*SILVER_COLUMNS)])
        first = [b for b in buckets if slots.get(b) != 0]
        out = merged.withColumns({"version": F.lit(batch_id).cast("bigint"), "slot": F.when(F.col("bucket").isin(first), 0).otherwise(1)})
        writer = out.select(*SILVER_COLUMNS, "version", "bucket", "slot").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.option("compression", STORED).partitionBy("bucket", "slot").parquet(f"{self.path}/orders")
