"""Running user state of a stream, in two levels: a user with most of the events is many tasks.

Inside a micro-batch, totals are carried over time slices (``running_user_state``); between micro-batches, one row per user is carried through a table in the
shared folder. The table is cut into buckets of users with two slots each: a batch reads a bucket's newest slot from before it and replaces the other, so a
repeated batch is harmless, only buckets with users of the batch are written, and users that are silent for longer than the time to live go. A batch's scored rows are
staged in the shared folder until it ends, so nothing is computed twice and no batch is held in memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.operators.live import cooldown_alerts, live_churn_score, running_user_state
from orderlake.session import scratch, shuffles_dropped
from orderlake.sources.merge import delete_folder
from orderlake.sources.sinks import STORED

TOTALS = ("user_id_hash string, orders bigint, spend bigint, refunds bigint, first_seen timestamp, last_seen timestamp, channels array<string>, "
          "alerted timestamp, version bigint, bucket int, slot int")
DAY = 86_400


def _newest(rows: DataFrame) -> DataFrame:
    """Rows of each bucket's newest version; there are at most as many (bucket, version) pairs as twice the buckets."""
    newest = rows.groupBy("bucket").agg(F.max("version").alias("version"))
    return rows.join(F.broadcast(newest), ["bucket", "version"])


def read_user_totals(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """One row per known user; ``before`` leaves out what batches from that id on have written."""
    rows = spark.read.schema(TOTALS).parquet(path)
    return _newest(rows if before is None else rows.where(F.col("version") < before))


def user_totals_sink(spark: SparkSession, path: str, threshold: float = 0.7, cooldown_seconds: int = 120, inclusive: bool = False, faithful: bool = False,
                     ttl_seconds: int = 90 * DAY, buckets: int = 64):
    """Batch function for valid, enriched orders: ``path/rows`` gets each order with its user's running state, score and whether an alert fires; ``path/totals``
    carries the users. Orders of a batch are taken by time, batches as they come. A user silent for longer than ``ttl_seconds`` (by the newest time of
    the batch) starts anew."""
    totals, out = f"{path}/totals", f"{path}/rows"
    spark.createDataFrame([], TOTALS).write.mode("append").partitionBy("bucket", "slot").parquet(totals)

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch.isEmpty():
            return
        staged = scratch(spark, "user-rows")
        try:
            with shuffles_dropped(spark):
                newest = batch.agg(F.max("occurred_at")).first()[0]
                alive = F.col("last_seen") >= F.lit(newest) - F.make_dt_interval(secs=F.lit(ttl_seconds))
                held = read_user_totals(spark, totals, batch_id).where(alive)
                written = f"{out}/batch_id={batch_id}"
                write_rows(batch, held, staged, written)
                write_totals(spark.read.parquet(written), held, batch_id)
        finally:
            delete_folder(spark, staged)

    def write_rows(batch: DataFrame, held: DataFrame, staged: str, written: str) -> None:
        spark = batch.sparkSession
        scored = live_churn_score(running_user_state(batch, earlier=held), faithful)
        # The cooldown reads its candidates several times and its result meets all rows: as tables, both are computed once and take no memory.
        scored.write.option("compression", STORED).parquet(f"{staged}/rows")
        rows = spark.read.schema(scored.schema).parquet(f"{staged}/rows")
        # The last alert of earlier batches is the first link of the user's chain.
        past = held.where("alerted is not null").select(F.lit(None).cast("string").alias("event_id"), "user_id_hash", F.col("alerted").alias("occurred_at"))
        links = rows.where(F.col("churn_score") >= threshold).select("event_id", "user_id_hash", "occurred_at").unionByName(
            past.join(rows.select("user_id_hash").distinct(), "user_id_hash", "left_semi"))
        links.write.option("compression", STORED).parquet(f"{staged}/chain")
        chain = spark.read.schema(links.schema).parquet(f"{staged}/chain")
        fired = cooldown_alerts(chain, "user_id_hash", "occurred_at", cooldown_seconds, inclusive, tie=["event_id"]).where("event_id is not null")
        marked = rows.join(fired.select("event_id", F.lit(True).alias("alert")), "event_id", "left").withColumn("alert", F.coalesce("alert", F.lit(False)))
        marked.write.mode("overwrite").option("compression", STORED).parquet(written)

    def write_totals(rows: DataFrame, held: DataFrame, batch_id: int) -> None:
        last = rows.groupBy("user_id_hash").agg(
            F.max("order_count").alias("orders"), F.max("total_spend").alias("spend"), F.max("refunds").alias("refunds"), F.min("first_seen").alias("first_seen"),
            F.max("occurred_at").alias("last_seen"), F.max_by("channels", F.size("channels")).alias("channels"), F.max(F.when(F.col("alert"), F.col("occurred_at"))).alias("alerted"))
        bucket = F.pmod(F.xxhash64("user_id_hash"), F.lit(buckets)).cast("int")
        fresh = last.withColumn("bucket", bucket)
        touched = F.broadcast(fresh.select("bucket").distinct())
        slots = _newest(read_user_totals(rows.sparkSession, totals, batch_id)).groupBy("bucket").agg(F.max("slot").alias("slot"))
        old = held.drop("version", "slot").join(touched, "bucket", "left_semi")
        earlier = old.select("user_id_hash", F.col("alerted").alias("_alerted"))
        fresh = fresh.join(earlier, "user_id_hash", "left").withColumn("alerted", F.coalesce("alerted", "_alerted")).drop("_alerted")
        kept = old.join(fresh.select("user_id_hash"), "user_id_hash", "left_anti").unionByName(fresh)
        new = kept.join(F.broadcast(slots), "bucket", "left").withColumns({"slot": F.coalesce(F.lit(1) - F.col("slot"), F.lit(0)), "version": F.lit(batch_id).cast("bigint")})
        fields = [f.split()[0] for f in TOTALS.replace("array<string>", "list").split(", ")]
        new.select(*fields).repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "slot").parquet(totals)
    return each


def read_user_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "true").parquet(f"{path}/rows")
