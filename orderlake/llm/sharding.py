"""Two-pass external shuffle into shards: scatter records over memory-sized buckets by seeded hashes, then Fisher-Yates each bucket.

The written buckets on end are one random order of all records; shard ``s`` of ``n`` is the ``s``-th of ``n`` equal slices of that order,
so shard sizes differ by one record at most. Places come from what was written, not from a count taken before, so they have no gaps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from orderlake.llm._runtime import tuned

PLACES = [T.StructField("bucket", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("place", T.LongType())]


def _shuffle(seed: int, memory_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = TaskContext.get().partitionId()
        held: list[pa.RecordBatch] = []
        size = block = 0

        def out() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks()
            order = np.arange(table.num_rows)
            draw = np.random.default_rng([seed, bucket, block])
            for i, j in zip(range(table.num_rows - 1, 0, -1), draw.integers(0, np.arange(table.num_rows, 1, -1)).tolist()):
                order[i], order[j] = order[j], order[i]
            for at in range(0, table.num_rows, 1000):
                part = table.take(pa.array(order[at : at + 1000])).combine_chunks().to_batches()[0]
                extra = [np.full(part.num_rows, bucket, np.int32), np.full(part.num_rows, block, np.int32), np.arange(at, at + part.num_rows)]
                yield pa.record_batch([*map(pa.array, extra), part.column(0)], names=["bucket", "block", "place", "row"])
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.nbytes
            if size >= memory_bytes:
                yield from out()
                held, size, block = [], 0, block + 1
        if held:
            yield from out()
    return run


def write_shuffled(docs: DataFrame, path: str, seed: int = 17, key_cols: tuple[str, ...] = ("doc_id", "text"), text_col: str = "text",
                   bucket_bytes: int = 16 << 20, memory_bytes: int = 96 << 20) -> None:
    """Write all rows and columns of ``docs`` in a random order that ``seed`` decides, however the input is laid out.

    Buckets are sized by the bytes of the texts. Rows are hashed by ``key_cols``; rows equal in all of them share a bucket. A bucket is sorted
    by two seeded hashes of the keys before it is shuffled, so the order in which rows arrive doesn't matter; rows equal in all keys may
    change places. One that outgrows ``memory_bytes``, as rows equal in all keys or very long texts can make it, is shuffled in blocks of that
    size, so memory stays bounded. Null keys and texts are values like others.
    Columns are kept in one ``row`` column, so theirs may have any names. An empty table writes a table without rows.
    """
    tuned(docs.sparkSession)
    total = docs.agg(F.coalesce(F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)) + 64), F.lit(0))).first()[0]
    buckets = max(1, -(-int(total) // bucket_bytes))
    rows = docs.select(F.struct("*").alias("row"), *(F.xxhash64(F.lit(seed + i), *key_cols).alias(k) for i, k in enumerate(("key", "tie"))))
    schema = T.StructType([*PLACES, T.StructField("row", docs.schema)])
    rows.repartition(buckets, "key").sortWithinPartitions("key", "tie").select("row").mapInArrow(_shuffle(seed, memory_bytes), schema).write.option("compression", "zstd").parquet(path)


def read_shards(spark: SparkSession, path: str, shards: int) -> DataFrame:
    """``row`` (all columns that were written), ``shard`` (0 to ``shards - 1``) and ``slot`` (from 0 without gaps); counts of shards differ by
    one at most."""
    files = spark.read.parquet(path)
    sizes = files.groupBy("bucket", "block").agg(F.count("*").alias("n"))
    before = Window.orderBy("bucket", "block").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("bucket", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    total = files.agg(F.count("*").alias("total"))
    at = files.join(bases.join(total), ["bucket", "block"]).withColumn("at", F.col("base") + F.col("place"))
    # Shard s holds the places from floor(s * total / shards) on; place p is in shard floor((p * shards + shards - 1) / total).
    placed = at.withColumn("shard", F.expr(f"cast((at * {int(shards)} + {int(shards) - 1}) div total as int)"))
    return placed.select("row", "shard", F.expr(f"at - (shard * total) div {int(shards)}").alias("slot"))
