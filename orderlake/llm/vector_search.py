"""Nearest vectors by cross-polytope hashing: fast Hadamard pseudo-rotations take a unit vector to its nearest signed axis.

Each table rotates by three rounds of random signs and a Hadamard transform, and the nearest of the ``2 * dim`` signed axes is the bucket.
A query looks into the buckets of its nearest axes in every table, and all vectors there are ranked by their exact inner product. Vectors
of unequal norms get one more coordinate that makes them unit vectors without changing the order of their inner products.

Equal vectors are indexed once: of their ids only the smallest ``k + 1`` can be among the nearest ``k`` of any query. Large buckets are
split into blocks, and queries go to all blocks of a bucket, so a crowded bucket is neither one task nor dropped.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlake.llm._runtime import stored, tuned

BLOCK = 4096
HELD_QUERIES = 50_000


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Orthonormal fast Walsh-Hadamard transform of each row; the width is a power of two."""
    out, half = rows, 1
    while half < rows.shape[1]:
        pairs = out.reshape(len(rows), -1, 2, half)
        out = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), 2).reshape(rows.shape)
        half *= 2
    return out / math.sqrt(rows.shape[1])


def rotations(tables: int, width: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).choice([-1.0, 1.0], (tables, 3, width))


def nearest_axes(units: np.ndarray, signs: np.ndarray, probes: int) -> np.ndarray:
    """The ``probes`` nearest signed axes of each row, nearest first: ``2 * axis``, plus 1 for the negative direction."""
    turned = units
    for s in signs:
        turned = hadamard(turned * s)
    both = np.stack((turned, -turned), 2).reshape(len(units), -1)
    if probes == 1:
        return both.argmax(1)[:, None]
    best = np.argpartition(-both, probes - 1, axis=1)[:, :probes] if probes < both.shape[1] else np.tile(np.arange(both.shape[1]), (len(both), 1))
    order = np.argsort(-np.take_along_axis(both, best, 1), axis=1, kind="stable")
    return np.take_along_axis(best, order, 1)


def _hash(tables: int, seed: int, probes: int | None, largest: float, even: bool):
    """``even``: all norms are about equal, and no further coordinate is needed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, tuple[int, int, np.ndarray]] = {}
        for batch in batches:
            vectors = [np.asarray(v, np.float64) for v in batch.column(1).to_numpy(zero_copy_only=False)]
            asked = batch.column(2).to_pylist()
            codes: list[list[int]] = [[] for _ in vectors]
            looks: list[list[int]] = [[] for _ in vectors]
            for dim in {len(v) for v in vectors}:
                rows = [i for i, v in enumerate(vectors) if len(v) == dim]
                wide = dim + (not even)
                width = 1 << max(0, wide - 1).bit_length()
                count = probes or min(2 * width, max(2, width // 8))
                signs = made.setdefault(dim, (width, count, rotations(tables, width, seed + dim)))[2]
                x = np.array([vectors[i] for i in rows])
                norms = np.sqrt((x * x).sum(1))
                base = np.zeros((len(rows), width))
                base[:, :dim] = x / norms[:, None] if even else x / largest
                query = np.zeros((len(rows), width))
                query[:, :dim] = x / norms[:, None]
                if not even:
                    base[:, dim] = np.sqrt(np.maximum(0, 1 - (norms / largest) ** 2))
                for t in range(tables):
                    # A code is the table's and the dimension's own: vectors of different lengths never meet.
                    offset = (dim * tables + t) * 2 * width
                    own = nearest_axes(base, signs[t], 1)[:, 0] + offset
                    for i, c in zip(rows, own.tolist()):
                        codes[i].append(c)
                    ask = [(k, i) for k, i in enumerate(rows) if asked[i]]
                    if ask:
                        near = nearest_axes(query[[k for k, _ in ask]], signs[t], count) + offset
                        for (_, i), c in zip(ask, near.tolist()):
                            looks[i].extend(c)
            body = pa.array([v.tobytes() for v in vectors], pa.binary())
            yield pa.record_batch([batch.column(0), batch.column(3), body, pa.array(codes, pa.list_(pa.int64())), pa.array(looks, pa.list_(pa.int64()))],
                                  names=["rep", "low", "vector", "codes", "looks"])
    return run


def _rank(k: int):
    """Rows come sorted by ``code, block, asks``: the vectors of a block and then the queries that look into it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here: tuple[int, int] | None = None
        reps: list[int] = []
        lows: list[int] = []
        parts: list[bytes] = []
        block = np.zeros((0, 0))
        # By query, for each class found: the negated score and the smallest id, which is the order of the result.
        best: dict[int, dict[int, tuple[float, int]]] = {}

        def shortened(found: dict[int, tuple[float, int]]) -> dict[int, tuple[float, int]]:
            return dict(sorted(found.items(), key=lambda x: x[1])[:k])

        def out() -> pa.RecordBatch:
            rows = [(q, r, low, -s) for q, found in best.items() for r, (s, low) in shortened(found).items()]
            best.clear()
            return pa.record_batch([pa.array([x[i] for x in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.float64()))],
                                   names=["query", "rep", "low", "score"])

        def ask(queries: list[int], vectors: list[bytes]) -> None:
            q = np.frombuffer(b"".join(vectors)).reshape(len(vectors), -1)
            ids, low = np.array(reps), np.array(lows)
            sums = q @ block.T
            for row, query in enumerate(queries):
                near = sums[row]
                if len(near) > k:
                    kth = np.partition(near, -k)[-k]
                    chosen = np.flatnonzero(near >= kth - 1e-9 * (1 + abs(kth)))
                else:
                    chosen = np.arange(len(near))
                exact = (block[chosen] * q[row]).sum(1)
                top = np.lexsort((low[chosen], -exact))[:k]
                found = best.setdefault(query, {})
                found.update(zip(ids[chosen][top].tolist(), zip((-exact[top]).tolist(), low[chosen][top].tolist())))
                if len(found) > 4 * k:
                    best[query] = shortened(found)

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(6)]
            queries: list[int] = []
            vectors: list[bytes] = []
            for code, part, asks, rep, smallest, vector in zip(*columns):
                if (code, part) != here:
                    if queries:
                        ask(queries, vectors)
                        queries, vectors = [], []
                    here, reps, lows, parts, block = (code, part), [], [], [], np.zeros((0, 0))
                if not asks:
                    reps.append(rep)
                    lows.append(smallest)
                    parts.append(vector)
                elif reps:
                    if not len(block):
                        block = np.frombuffer(b"".join(parts)).reshape(len(parts), -1)
                    queries.append(rep)
                    vectors.append(vector)
            if queries:
                ask(queries, vectors)
            if len(best) > HELD_QUERIES:
                yield out()
        yield out()
    return run


def nearest(
    vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", tables: int = 16, probes: int | None = None, seed: int = 11,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: of each row for which the SQL condition ``is_query`` holds, the ``k`` vectors of other ids with the
    largest inner product among those found, ties to the smaller id. ``probes`` is by default an eighth of the (padded) dimension.

    Rows with a null id and vectors that are null, zero, or hold null or non-finite numbers take no part. A query for which the tables give
    too few candidates is compared with all vectors. Vectors of different lengths are never compared. Repeated rows count once; an empty
    table gives no rows.
    """
    spark = tuned(vectors.sparkSession)
    v = F.col("v")
    sound = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    slim = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.expr(f"coalesce({is_query}, false)").alias("asks"))
    clean = slim.where(F.col("id").isNotNull() & sound)
    clean = clean.withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(1), "v")})
    first = Window.partitionBy("h1", "h2").orderBy("id")
    few = clean.withColumn("place", F.dense_rank().over(first)).where(F.col("place") <= k + 1)
    asked = clean.where("asks").select("h1", "h2", "id").distinct()
    classes = few.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.sort_array(F.collect_set("id")).alias("ids"), F.first("v").alias("v"))
    marked = classes.join(asked.select("h1", "h2", F.lit(True).alias("asks")).distinct(), ["h1", "h2"], "left")
    # The smallest id names a class; one id may have several vectors, so classes are named by a number of their own.
    base = stored(marked.withColumn("rep", F.col("h1")).select("rep", "h1", "h2", "ids", "v", F.coalesce("asks", F.lit(False)).alias("asks")), "classes")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    least, largest, total = base.agg(F.min(norm), F.max(norm), F.count("*")).first()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    even = largest - least <= 1e-3 * largest
    hashed = stored(base.select("rep", "v", "asks", F.array_min("ids").alias("low")).mapInArrow(_hash(tables, seed, probes, largest, even), "rep long, low long, vector binary, codes array<long>, looks array<long>"), "hashed")

    def ranked(rows: DataFrame, looks: DataFrame) -> DataFrame:
        blocks = rows.groupBy("code").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        held = rows.join(blocks, "code").select("code", F.expr("pmod(xxhash64(rep), blocks)").cast("int").alias("block"), F.lit(0).alias("asks"), "rep", "low", "vector")
        queries = looks.join(blocks, "code").select("code", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("asks"), "rep", "low", "vector")
        dealt = held.union(queries).repartition("code", "block").sortWithinPartitions("code", "block", "asks")
        found = dealt.mapInArrow(_rank(k + 1), "query long, rep long, low long, score double")
        # Every class has an id of its own, so the nearest k + 1 ids are among the nearest k + 1 classes.
        order = Window.partitionBy("query").orderBy(F.desc("score"), "low", "rep")
        once = found.groupBy("query", "rep", "low").agg(F.max("score").alias("score"))
        return once.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1).select("query", "rep", "score")

    found = ranked(hashed.select(F.explode("codes").alias("code"), "rep", "low", "vector"), hashed.select(F.explode("looks").alias("code"), "rep", "low", "vector"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    named = base.select("rep", "ids")

    def expand(pairs: DataFrame) -> DataFrame:
        each = pairs.join(named, "rep").select("query", "score", F.explode("ids").alias("vec_id"))
        return stored(each.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1).select("query", "score", "vec_id"), "found")

    lists = expand(found)
    enough = lists.groupBy("query").agg(F.count("*").alias("n")).where(F.col("n") > k)
    short = hashed.where(F.size("looks") > 0).join(enough.withColumnRenamed("query", "rep"), "rep", "left_anti").select("rep", "low", "vector")
    short = stored(short, "short")
    if not short.isEmpty():
        width = F.octet_length("vector").cast("long").alias("code")
        whole = ranked(hashed.select(width, "rep", "low", "vector"), short.select(width, "rep", "low", "vector"))
        lists = lists.join(short.select(F.col("rep").alias("query")), "query", "left_anti").union(expand(whole))
    own = asked.join(base.select("h1", "h2", F.col("rep").alias("query")), ["h1", "h2"]).select("query", F.col("id").alias("query_id"))
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    out = own.join(lists, "query").where("query_id <> vec_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return out.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
