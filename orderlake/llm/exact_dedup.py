"""Exact duplicates through an extendible-hash index on shared files.

Keys are 64-bit hashes of normalised texts, and a bucket is a range of keys. The directory starts with one bucket; an overfull bucket is
split by one more bit, and the directory doubles when the bucket already uses all of its bits. A key that alone overfills a bucket can't
be split: it gets a chain of pages of its own. Owner tasks process ranges of the directory; within a key they compare texts byte by byte,
and texts that merely share the key become further links of its chain. What the owners write, each distinct text once with the ids that
have it, is the index; groups and sizes are read from it without the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm._runtime import stored, tuned
from orderlake.session import scratch

CAPACITY = 32 << 20
ROW_BYTES = 64
MOST_BUCKETS = 1 << 14
FINEST = 20
OWNER_BYTES = 64 << 20
HELD_BYTES = 16 << 20
INDEX = "bucket int, page int, pages int, key long, link int, entry long, ids array<long>, text_sha256 string, text binary"


class Directory(NamedTuple):
    """``cells[p]`` is the bucket of keys that begin with the ``depth`` bits of ``p``; ``buckets`` has the prefix and local depth of each."""

    depth: int
    cells: np.ndarray
    buckets: list[tuple[int, int]]


def grow(weights: np.ndarray, capacity: int) -> Directory:
    """Split overfull buckets until none is left or all bits that ``weights`` (bytes per finest prefix) tells apart are used."""
    fine = len(weights).bit_length() - 1
    before = np.concatenate(([0], np.cumsum(weights)))
    depth, cells, buckets, todo = 0, np.zeros(1, np.int64), [(0, 0)], [0]
    while todo:
        old = todo.pop()
        prefix, local = buckets[old]
        width = 1 << (fine - local)
        if local == fine or before[(prefix + 1) * width] - before[prefix * width] <= capacity:
            continue
        if local == depth:
            cells, depth = np.repeat(cells, 2), depth + 1
        new, span = len(buckets), 1 << (depth - local - 1)
        buckets[old] = (2 * prefix, local + 1)
        buckets.append((2 * prefix + 1, local + 1))
        cells[(2 * prefix + 1) * span : (2 * prefix + 2) * span] = new
        todo += [old, new]
    return Directory(depth, cells, buckets)


def normalised(text: Column) -> Column:
    """Each run of white space (0x20, 0x09-0x0D) as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _prefix(key: str, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("long")


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal texts of a task as one entry with all their ids; handed on whenever ``HELD_BYTES`` are held."""
    part, count, held = TaskContext.get().partitionId(), 0, 0
    chains: dict[int, list[tuple[bytes, list[int | None]]]] = {}

    def entries() -> pa.RecordBatch:
        rows = [(key, ids, text) for key, chain in chains.items() for text, ids in chain]
        keys, ids, texts = zip(*rows)
        numbers = np.arange(count, count + len(rows)) + (part << 32)
        return pa.record_batch([pa.array(numbers), pa.array(keys, pa.int64()), pa.array(ids, pa.list_(pa.int64())), pa.array(texts, pa.binary())], names=["entry", "key", "ids", "text"])
    for batch in batches:
        for doc, text, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            chain = chains.setdefault(key, [])
            for known, ids in chain:
                if known == text:
                    ids.append(doc)
                    held += 40
                    break
            else:
                chain.append((text, [doc]))
                held += len(text) + 400
            if held > HELD_BYTES:
                out = entries()
                count, held = count + out.num_rows, 0
                chains.clear()
                yield out
    if chains:
        yield entries()


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key and page. The first row of each distinct text carries it; memory holds the texts of one key."""
    at, chain = None, []
    for batch in batches:
        links, texts, digests = [], [], []
        for key, page, text in zip(batch.column("key").to_pylist(), batch.column("page").to_pylist(), batch.column("text").to_pylist()):
            if (key, page) != at:
                at, chain = (key, page), []
            if text in chain:
                links.append(chain.index(text))
                texts.append(None)
                digests.append(None)
            else:
                links.append(len(chain))
                texts.append(text)
                digests.append(hashlib.sha256(text).hexdigest())
                chain.append(text)
        whole = {"link": pa.array(links, pa.int32()), "text_sha256": pa.array(digests, pa.string()), "text": pa.array(texts, pa.binary())}
        names = [f.split()[0] for f in INDEX.replace("array<long>", "list").split(", ")]
        yield pa.record_batch([whole.get(n, None) if n in whole else batch.column(n) for n in names], names=names)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Heads of all pages of a key, sorted by key, to the links of the whole chain."""
    at, chain = None, []
    for batch in batches:
        chains = []
        for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
            if key != at:
                at, chain = key, []
            if text not in chain:
                chain.append(text)
            chains.append(chain.index(text))
        yield pa.record_batch([batch.column("key"), batch.column("page"), batch.column("link"), pa.array(chains, pa.int32())], names=["key", "page", "link", "same"])


def build_index(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, key: Column | None = None) -> DataFrame:
    """Write the index of all texts to ``path`` (by default a new folder in the shared one) and return its rows: ``bucket, page, pages, key,
    link, entry, ids, text_sha256, text``. Text and digest stand in one row of each page and link; ``ids`` lists the rows of a task that
    have it. ``key`` is an expression over ``text``, the normalised text, as long; by default ``xxhash64``.

    The driver sees bytes per key prefix (at most 2 ** 20 numbers) and the keys that alone hold more than a bucket (at most ``MOST_BUCKETS``,
    as the capacity grows with the table). Tables read as broadcasts have the same bounds.
    """
    spark = tuned(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), normalised(F.col(f"`{text_col}`")).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("text") if key is None else key.cast("long"))
    weight = F.count("*") * (F.max(F.octet_length("text")) + ROW_BYTES)
    keys = stored(rows.groupBy("key").agg(weight.alias("weight")), "keys")
    total = keys.agg(F.sum("weight")).first()[0] or 0
    capacity = max(capacity, -(-total // MOST_BUCKETS))
    fine = max(1, min(FINEST, (total // capacity).bit_length() + 6))
    counted = keys.where(F.col("weight") <= capacity).groupBy(_prefix("key", fine).alias("cell")).agg(F.sum("weight").alias("weight")).toArrow()
    weights = np.zeros(1 << fine, np.int64)
    weights[counted["cell"].to_numpy()] = counted["weight"].to_numpy()
    directory = grow(weights, capacity)

    owners = max(spark.sparkContext.defaultParallelism, -(-total // OWNER_BYTES))
    per_cell = weights.reshape(len(directory.cells), -1).sum(axis=1)
    upto = np.cumsum(np.bincount(directory.cells, per_cell, len(directory.buckets))[directory.cells] / np.bincount(directory.cells)[directory.cells])
    first = np.full(len(directory.buckets), len(directory.cells))
    np.minimum.at(first, directory.cells, np.arange(len(directory.cells)))
    owner = np.minimum(owners - 1, ((upto[first] - 1) / max(1, upto[-1]) * owners).clip(0).astype(np.int64))[directory.cells]
    cells = F.broadcast(spark.createDataFrame(list(zip(range(len(owner)), directory.cells.tolist(), owner.tolist())), "cell long, bucket int, owner int"))
    alone = F.broadcast(keys.where(F.col("weight") > capacity).select("key", F.least(F.ceil(F.col("weight") / capacity), F.lit(owners)).cast("int").alias("pages")))

    entries = rows.select("id", F.col("text").cast("binary").alias("text"), "key").mapInArrow(_combined, "entry long, key long, ids array<long>, text binary")
    placed = entries.withColumn("cell", _prefix("key", directory.depth)).join(cells, "cell").join(alone, "key", "left").select(
        "bucket", F.when(F.col("pages").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("entry"), F.col("pages"))).cast("int").alias("page"),
        F.coalesce("pages", F.lit(1)).alias("pages"), "key", "entry", "ids", "text", "owner")
    dealt = placed.repartitionById(owners, F.pmod(F.col("owner") + F.col("page"), F.lit(owners)).cast("int")).sortWithinPartitions("key", "page", "entry")
    path = path or scratch(spark, "llm-exact-index")
    dealt.drop("owner").mapInArrow(_chained, INDEX).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(INDEX).parquet(path)


def groups(index: DataFrame) -> DataFrame:
    """``id, keep_id, group_size, kept, text_sha256`` of each indexed row. Within a group the smallest id stays, null ids last; of rows with
    the same id and text one stays."""
    links = index.select("key", "page", "link", "entry", "ids", "text_sha256")
    heads = index.where("pages > 1 and text is not null").select("key", "page", "link", "text")
    merged = heads.repartition("key").sortWithinPartitions("key", "page", "link").mapInArrow(_merged, "key long, page int, link int, same int")
    links = links.join(stored(merged, "pages"), ["key", "page", "link"], "left").withColumn("same", F.coalesce("same", "link"))
    smallest = F.array_min("ids")
    classes = links.groupBy("key", "same").agg(
        F.min(F.struct(smallest.isNull().alias("last"), smallest.alias("id"), "entry")).alias("first"), F.sum(F.size("ids")).cast("long").alias("group_size"),
        F.max("text_sha256").alias("digest"))
    each = links.select("key", "same", "entry", "ids").join(classes, ["key", "same"])
    each = each.select("entry", "first", "group_size", "digest", F.coalesce(F.array_position("ids", F.col("first.id")), F.lit(1)).alias("at"), F.posexplode("ids").alias("pos", "id"))
    return each.select("id", F.col("first.id").alias("keep_id"), "group_size", ((F.col("entry") == F.col("first.entry")) & (F.col("pos") + 1 == F.col("at"))).alias("kept"),
                       F.col("digest").alias("text_sha256"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """``id, keep_id, group_size, kept, text_sha256`` of each row of ``docs``; texts are equal when identical after ``normalised``.

    Null counts as the empty text, and all empty texts are one group. Texts are compared whole, whatever their length. Rows that repeat are
    rows of their own, of which one stays; null ids come last. An empty table gives no rows. Other columns of the input don't matter, names
    included. A text that many rows share is combined in each task before the shuffle, and its entries are spread over pages.
    """
    return groups(build_index(docs, None, id_col, text_col, capacity))
