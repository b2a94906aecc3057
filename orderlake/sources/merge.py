"""Stored tables that change by partition: keyed merges, erasure in every table, retention.

A keyed table has its rows and, beside them, a map of key hashes per partition. A merge looks incoming keys up in the map, 8 bytes a row instead of whole
rows, and then opens and rewrites only partitions that hold one of them or get new rows. New content is staged before anything is replaced, so
a failed job leaves the table as it was, and a repeated one finishes it.
"""

from __future__ import annotations

from typing import NamedTuple
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.functions import ERASED
from orderlake.operators.keyed import latest_per_key
from orderlake.session import scratch
from orderlake.sources.sinks import STORED, write_partitioned


def _among(column: str, values: list) -> Column:
    known = [v for v in values if v is not None]
    found = F.col(column).isin(known) if known else F.lit(False)
    return found | F.col(column).isNull() if len(known) < len(values) else found


def partition_folders(spark: SparkSession, path: str, by: str) -> dict[str, str]:
    """Value as text and folder of each stored partition; folders are listed, no file is opened."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()] if fs.exists(folder) else []
    return {unquote(n.split("=", 1)[1]): f"{path}/{n}" for n in names if n.startswith(f"{by}=")}


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class KeyedTable(NamedTuple):
    """Rows at ``path/rows`` and key hashes at ``path/keys``, both in folders of ``partition``; ``keys`` identify a row."""

    path: str
    keys: list[str]
    partition: str

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/rows")

    def hashes(self, rows: DataFrame) -> DataFrame:
        return rows.select(F.xxhash64(*self.keys).alias("key"), self.partition)

    def write(self, rows: DataFrame) -> None:
        """Replace the partitions of ``rows``, which hold each key once."""
        write_partitioned(rows, f"{self.path}/rows", [self.partition])
        write_partitioned(self.hashes(rows), f"{self.path}/keys", [self.partition])

    def touched(self, spark: SparkSession, fresh: DataFrame) -> list:
        """Partitions that hold a key of ``fresh`` or get one; the list is bounded by the partitions of the table and of ``fresh``."""
        held = spark.read.parquet(f"{self.path}/keys").join(fresh.select(F.xxhash64(*self.keys).alias("key")).distinct(), "key", "left_semi").select(self.partition)
        return [r[0] for r in held.union(fresh.select(self.partition)).distinct().collect()]

    def merge(self, incoming: DataFrame, order: list[str], deleted: Column | None = None) -> dict[str, int]:
        """Insert or replace by key; of several rows of a key the newest by ``order`` stays, an incoming one before a stored one of the same age. Rows that meet
        ``deleted`` and are newest remove their key. A key may move to another partition.

        Incoming rows have the table's columns; those of ``order`` and ``deleted`` may be further ones, null in stored rows unless stored. Returns the
        partitions of the table before, those opened, and the rows written. Repeating a merge changes nothing.
        """
        spark = incoming.sparkSession
        table = self.read(spark)
        staged = scratch(spark, "merge")
        newest = [F.col(c) for c in order] + [F.xxhash64(*incoming.columns)]
        latest_per_key(incoming, self.keys, newest).write.parquet(f"{staged}/incoming")
        fresh = spark.read.schema(incoming.schema).parquet(f"{staged}/incoming")
        before = len(partition_folders(spark, f"{self.path}/rows", self.partition))
        parts = self.touched(spark, fresh)
        opened = table.where(_among(self.partition, parts)).withColumn("_new", F.lit(0))
        rows = opened.unionByName(fresh.withColumn("_new", F.lit(1)), allowMissingColumns=True)
        merged = latest_per_key(rows, self.keys, [*[F.col(c) for c in order], F.col("_new")])
        if deleted is not None:
            merged = merged.where(~F.coalesce(deleted, F.lit(False)))
        merged.select(*table.columns).write.partitionBy(self.partition).parquet(f"{staged}/rows")
        if not partition_folders(spark, f"{staged}/rows", self.partition):
            left, written = set(), 0
        else:
            done = spark.read.schema(table.schema).parquet(f"{staged}/rows").select(*table.columns)
            self.write(done)
            left, written = set(partition_folders(spark, f"{staged}/rows", self.partition)), done.count()
        held = partition_folders(spark, f"{self.path}/rows", self.partition)
        wanted = {"__HIVE_DEFAULT_PARTITION__" if p is None else str(p) for p in parts}
        for value in wanted - left:
            if value in held:
                delete_folder(spark, held[value])
                delete_folder(spark, held[value].replace(f"{self.path}/rows", f"{self.path}/keys", 1))
        return {"partitions": before, "opened": len(wanted & set(held)), "rows_written": written}


class Holder(NamedTuple):
    """A stored table with a column that carries the user's hash, in folders of ``partition``."""

    layer: str
    path: str
    partition: str
    column: str = "user_id_hash"


def erase_everywhere(spark: SparkSession, holders: dict[str, Holder], requests: DataFrame) -> DataFrame:
    """Replace the hash of every requested user by the tombstone in all tables that carry it; no row is removed.

    Affected partitions of all tables are staged first; only when every table is staged are they swapped, so a failure before that leaves all
    tables whole, and repeating the job completes a swap that broke off. The result, ``table, layer, user_id_hash, partitions, rows``, is counted in what was
    rewritten and is written to the shared folder; staged rows are deleted.
    """
    wanted = requests.select(F.col("user_id_hash").alias("_erased")).where("_erased is not null").distinct()
    staged, ledgers = {}, []
    for name, holder in holders.items():
        table = spark.read.parquet(holder.path)
        hits = table.join(wanted, F.col(holder.column) == F.col("_erased"), "left_semi").select(holder.partition).distinct()
        parts = [r[0] for r in hits.collect()]
        if not parts:
            continue
        rows = table.where(_among(holder.partition, parts)).join(wanted, F.col(holder.column) == F.col("_erased"), "left")
        path = scratch(spark, f"erase-{name}")
        rows.withColumn(holder.column, F.when(F.col("_erased").isNotNull(), F.lit(ERASED)).otherwise(F.col(holder.column))).write.option("compression", STORED).partitionBy(holder.partition).parquet(path)
        staged[name] = (path, table, spark.read.schema(spark.read.parquet(path).schema).parquet(path))
    for name, (_, _, rows) in staged.items():
        holder = holders[name]
        ledgers.append(rows.where("_erased is not null").groupBy(F.col("_erased").alias("user_id_hash")).agg(
            F.count_distinct(holder.partition).alias("partitions"), F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), F.lit(holder.layer).alias("layer"), "user_id_hash", "partitions", "rows"))
    schema = "`table` string, layer string, user_id_hash string, partitions bigint, `rows` bigint"
    ledger = spark.createDataFrame([], schema)
    for part in ledgers:
        ledger = ledger.unionByName(part)
    path = scratch(spark, "erasure-ledger")
    ledger.write.parquet(path)
    for name, (_, table, rows) in staged.items():
        # Staged files hold one partition each, so they go over as they are, without another shuffle.
        swap = rows.select(*table.columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", STORED)
        swap.partitionBy(holders[name].partition).parquet(holders[name].path)
    for folder, _, _ in staged.values():
        delete_folder(spark, folder)
    return spark.read.schema(schema).parquet(path)


def erasure_records(requests: DataFrame, ledger: DataFrame, completed_at: Column, run_id: str) -> DataFrame:
    """One audit record per request, also when nothing matched, from the ledger of ``erase_everywhere``. Only a short prefix of the hash is kept."""
    def of(layer: str, name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("layer") == layer, F.col(name))), F.lit(0)).cast("bigint")
    found = requests.join(ledger, "user_id_hash", "left").groupBy("request_id", "user_id_hash").agg(
        *[of(layer, name).alias(f"{layer}_{name}") for layer in ("silver", "gold") for name in ("partitions", "rows")])
    return found.select(
        F.lit("gdpr_erasure").alias("event"), "request_id", F.concat(F.substring("user_id_hash", 1, 8), F.lit("...")).alias("user_id_hash_prefix"), completed_at.alias("completed_at"),
        *[F.struct(F.col(f"{layer}_partitions").alias("affected_files"), F.col(f"{layer}_rows").alias("affected_rows")).alias(layer) for layer in ("silver", "gold")],
        F.lit(run_id).alias("dag_run_id"))


def expire_stored(spark: SparkSession, path: str, by: str, before: str) -> list[str]:
    """Delete the stored partitions whose value, an ISO date, lies before ``before``; folders are listed, no file is opened. The values deleted."""
    gone = sorted(v for v in partition_folders(spark, path, by) if v != "__HIVE_DEFAULT_PARTITION__" and v < before)
    folders = partition_folders(spark, path, by)
    for value in gone:
        delete_folder(spark, folders[value])
    return gone
