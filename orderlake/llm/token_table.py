"""Token ids as Parquet list columns: dictionary or delta encoding, row groups and pages of a chosen size, page indexes.

Files hold the documents in ascending id order, so a range of ids or a few metadata columns are read without the rest: statistics of
row groups and page indexes select pages, and list values of other rows are skipped.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlake.llm._pieces import library_encoder, text_runs
from orderlake.llm._runtime import tuned, worker_state

SCHEMA = "id long, part int, local_start long, n_tokens long, ids array<int>"


def layout(encoding: str = "dictionary", row_group_bytes: int = 32 << 20, page_bytes: int = 256 << 10, page_rows: int = 2000) -> dict[str, str]:
    """Writer options. ``dictionary`` keeps ids as dictionary codes while the dictionary of a row group is small enough, ``delta`` packs
    differences; column and offset indexes are always written."""
    if encoding not in ("dictionary", "delta"):
        raise ValueError(encoding)
    return {
        "parquet.enable.dictionary": str(encoding == "dictionary").lower(), "parquet.dictionary.page.size": str(1 << 20),
        "parquet.writer.version": "PARQUET_1_0" if encoding == "dictionary" else "PARQUET_2_0",
        "parquet.block.size": str(row_group_bytes), "parquet.page.size": str(page_bytes), "parquet.page.row.count.limit": str(page_rows), "compression": "zstd"}


def _encode(tokenizer: str, kind: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_state(f"library_{kind}_{tokenizer}", lambda: library_encoder(tokenizer, kind), large=True)
        end = np.array([end_id], "<u4").tobytes()
        part, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            for first, texts in text_runs(batch.column(1)):
                coded = [ids + end for ids in encoder.ids(texts)]
                counts = np.array([len(c) // 4 for c in coded], np.int64)
                at = np.concatenate(([0], np.cumsum(counts)))
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.frombuffer(b"".join(coded), np.int32)))
                yield pa.record_batch([
                    batch.column(0).slice(first, len(texts)), pa.array(np.full(len(texts), part, np.int32)), pa.array(start + at[:-1]), pa.array(counts), lists],
                    names=["id", "part", "local_start", "n_tokens", "ids"])
                start += int(at[-1])
    return run


def write_token_table(docs: DataFrame, path: str, tokenizer: str, kind: str = "byte", end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", **options: object) -> None:
    """Encode each text with the tokenizers file ``tokenizer``, append ``end_id``, and write files in ascending id order (null first).

    A null or empty text is the end id alone. Rows with equal ids stay neighbours in no fixed order. An empty table writes a table
    without rows. ``kind`` is ``byte`` for byte-level tokenizers and ``word`` for those that drop white space.
    """
    tuned(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    ordered = slim.repartitionByRange("id").sortWithinPartitions("id")
    ordered.mapInArrow(_encode(tokenizer, kind, end_id), SCHEMA).write.options(**layout(**options)).parquet(path)


def token_files(spark: SparkSession, path: str) -> DataFrame:
    """The files as written: ``id, part, local_start, n_tokens, ids``."""
    return spark.read.schema(SCHEMA).parquet(path)


def with_starts(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Replace ``part`` and ``local_start`` of rows of ``files`` by ``start`` = ids of all documents before it."""
    sizes = files.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    others = [c for c in rows.columns if c not in ("id", "part", "local_start")]
    return rows.join(bases, "part").select("id", (F.col("base") + F.col("local_start")).alias("start"), *others)


def read_token_table(spark: SparkSession, path: str, first_id: int | None = None, last_id: int | None = None) -> DataFrame:
    """``id, start, n_tokens, ids``; a range of ids reads only their pages, and columns that the caller leaves out aren't read."""
    rows = files = token_files(spark, path)
    if first_id is not None:
        rows = rows.where(F.col("id") >= first_id)
    if last_id is not None:
        rows = rows.where(F.col("id") <= last_id)
    return with_starts(rows, files)


def ids_crc32(df: DataFrame, ids_col: str = "ids") -> DataFrame:
    """Replace the list column by ``ids_crc32``: crc32 of the ids as little-endian unsigned 32-bit integers."""
    kept = [c for c in df.columns if c != ids_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(ids_col)
            at = (lists.offsets.to_numpy().astype(np.int64) * 4).tolist() if len(lists) else [0]
            body = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False)).view(np.uint8))
            sums = [zlib.crc32(body[a:b]) for a, b in zip(at[:-1], at[1:])]
            yield pa.record_batch([*(batch.column(c) for c in kept), pa.array(sums, pa.int64())], names=[*kept, "ids_crc32"])
    schema = ", ".join(f"`{c}` {t}" for c, t in df.select(kept).dtypes) + ", ids_crc32 long"
    return df.select(*kept, ids_col).mapInArrow(run, schema)
