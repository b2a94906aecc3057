"""Packing by power-of-two decomposition: each document is cut into pieces of binary lengths, and pieces of equal length form a bucket.

A piece is a sequence of its own, so no sequence crosses documents and none needs padding. ``n`` tokens become ``n // longest`` pieces of
the longest length and then one piece for each bit of the rest, longest first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlake.llm._pieces import library_encoder, text_runs
from orderlake.llm._runtime import tuned, worker_state

SCHEMA = "id long, start long, doc_tokens long, part int, place long, ids array<int>, length int"


def binary_lengths(n: int, longest: int) -> list[int]:
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def _pieces(tokenizer: str, kind: str, end_id: int, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_state(f"library_{kind}_{tokenizer}", lambda: library_encoder(tokenizer, kind), large=True)
        end = np.array([end_id], "<u4").tobytes()
        part = TaskContext.get().partitionId()
        places: dict[int, int] = {}
        for batch in batches:
            for first, texts in text_runs(batch.column(1)):
                coded = [ids + end for ids in encoder.ids(texts)]
                row, starts, lengths, place, totals = [], [], [], [], []
                for i, ids in enumerate(coded):
                    start, total = 0, len(ids) // 4
                    for length in binary_lengths(total, longest):
                        row.append(i)
                        starts.append(start)
                        lengths.append(length)
                        totals.append(total)
                        place.append(places.get(length, 0))
                        places[length] = place[-1] + 1
                        start += length
                at = np.concatenate(([0], np.cumsum(lengths)))
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(np.frombuffer(b"".join(coded), np.int32)))
                yield pa.record_batch([
                    batch.column(0).slice(first, len(texts)).take(pa.array(row, pa.int64())), pa.array(starts, pa.int64()), pa.array(totals, pa.int64()),
                    pa.array(np.full(len(row), part, np.int32)), pa.array(place, pa.int64()), lists, pa.array(lengths, pa.int32())],
                    names=["id", "start", "doc_tokens", "part", "place", "ids", "length"])
    return run


def write_packed(docs: DataFrame, path: str, tokenizer: str, kind: str = "word", end_id: int = 2, longest: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the pieces of all documents, a folder for each length. ``longest`` is a power of two.

    A null or empty text is the end id alone: one piece of length 1. Rows that repeat are packed as often as they occur, null ids too.
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")
    tuned(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    slim.mapInArrow(_pieces(tokenizer, kind, end_id, longest), SCHEMA).write.partitionBy("length").option("compression", "zstd").parquet(path)


def packed_files(spark: SparkSession, path: str) -> DataFrame:
    """The files as written: ``id, start, doc_tokens, part, place, ids, length``."""
    return spark.read.schema(SCHEMA).parquet(path)


def with_sequences(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Replace ``part`` and ``place`` of rows of ``files`` by ``sequence_id`` and ``offset``: sequences are numbered from 0 without gaps, longest
    bucket first."""
    sizes = files.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    longer = Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    buckets = sizes.groupBy("length").agg(F.sum("n").alias("n")).select("length", F.coalesce(F.sum("n").over(longer), F.lit(0)).alias("bucket"))
    bases = sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")).join(buckets, "length")
    bases = bases.select("length", "part", (F.col("bucket") + F.col("base")).alias("base"))
    others = [c for c in rows.columns if c not in ("id", "start", "length", "doc_tokens", "part", "place")]
    return rows.join(bases, ["length", "part"]).select(
        "id", "start", F.col("length").cast("long").alias("length"), "doc_tokens", (F.col("base") + F.col("place")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), *others)


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """``id, start, length, doc_tokens, sequence_id, offset, ids`` of each piece."""
    files = packed_files(spark, path)
    return with_sequences(files, files)
