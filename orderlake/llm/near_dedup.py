"""Near-duplicate documents by SetSketch registers: band the registers, estimate jointly by likelihood, then verify on full sets.

A register is the smallest of exponentially distributed hashes of a set's shingles, truncated to an exponentially spaced scale, so two
registers are equal with a probability close to the Jaccard similarity, and the sketch of a union is the maximum of the sketches.

Texts with equal sets form one class, and only classes are compared. A bucket of equal register bands isn't expanded into pairs: its
best-connected member is a hub that every other member is compared with, and components form. Members of all buckets of a hub make a
group; where it still holds several components, blocks of its full sets are compared with each other, each block pair in one bounded
task that gives no more links than join its components. So no candidate link between components is lost, and no pairs are emitted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm._graph import components
from orderlake.llm._runtime import free_worker_state, stored, tuned
from orderlake.llm._text import Powers, binaries, chunks, mix, shingles, words

SPACING = 1.1
RATE = 1 / 20
TOP = 255
BLOCK = 256
STRANGERS = 0.1
MOST_REGISTERS = 1024


def register_equality(similarity: float, spacing: float = SPACING) -> float:
    """Probability that a register is equal for two sets of one size."""
    return 1 + 2 * math.log(1 - (1 - similarity) / 2 * (spacing - 1) / spacing) / math.log(spacing)


def band_width(registers: int, similarity: float, miss: float) -> int:
    """Most registers in a band with which a pair at ``similarity`` shares no band with at most the probability ``miss``."""
    p = register_equality(similarity)
    return max(r for r in range(1, registers + 1) if r == 1 or (1 - p**r) ** (registers // r) <= miss)


def sketch_size(documents: int, registers: int, similarity: float, miss: float) -> tuple[int, int]:
    """Registers, ``registers`` or more, and the width of their bands: so wide that on average a document shares a band with at most ``STRANGERS``
    of ``documents`` disjoint sets, and so many that a pair at ``similarity`` is still missed with at most the probability ``miss``.

    Chance buckets would otherwise grow with the square of the documents; so the sketch grows with their logarithm. Beyond ``MOST_REGISTERS``,
    which low similarities reach, bands stay narrower and strangers are left to the comparisons that follow."""
    width, unlike, p = band_width(registers, similarity, miss), register_equality(0), register_equality(similarity)
    while documents * (registers // width) * unlike**width > STRANGERS:
        wider = (width + 1) * math.ceil(math.log(miss) / math.log1p(-(p ** (width + 1))))
        if wider > max(MOST_REGISTERS, registers):
            break
        registers, width = max(registers, wider), width + 1
    return registers, width


def sketch(sets: list[np.ndarray], registers: int) -> np.ndarray:
    """Registers of each non-empty set of 64-bit hashes, a row of uint8 each."""
    sizes = np.array([len(s) for s in sets])
    at = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    h = np.concatenate(sets)
    h = (h >> np.uint64(32)).astype(np.uint32) ^ h.astype(np.uint32)
    factors = np.random.default_rng(7).integers(1, 1 << 31, (registers, 3), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    least = np.empty((registers, len(sets)), np.uint32)
    v, w = np.empty_like(h), np.empty_like(h)
    for i, (a, b, c) in enumerate(factors):
        np.multiply(h, a, out=v)
        v += b
        np.right_shift(v, np.uint32(15), out=w)
        v ^= w
        v *= c
        np.right_shift(v, np.uint32(16), out=w)
        v ^= w
        np.minimum.reduceat(v, at, out=least[i])
    smallest = -np.log1p(-(least + 0.5) / 2.0**32) * RATE
    return np.clip(np.floor(1 - np.log(smallest) / math.log(SPACING)), 0, TOP).astype(np.uint8).T


def unlikely(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, threshold: float, slack: float) -> np.ndarray:
    """Pairs whose joint likelihood peaks below ``threshold`` and falls by more than ``slack`` until there."""
    higher, lower = (a > b).sum(1), (a < b).sum(1)
    equal = a.shape[1] - higher - lower
    u = (na / (na + nb))[:, None]
    v = 1 - u
    top = np.minimum(u, v) / np.maximum(u, v)
    grid = np.concatenate((np.linspace(0, threshold, 41), np.linspace(threshold, 1, 11)[1:]))[None, :]
    j = np.minimum(grid, top)
    scale, ratio = math.log(SPACING), (SPACING - 1) / SPACING
    up = -np.log1p(-np.maximum(u - v * j, 0) * ratio) / scale
    down = -np.log1p(-np.maximum(v - u * j, 0) * ratio) / scale
    tiny = 1e-300
    like = higher[:, None] * np.log(up + tiny) + lower[:, None] * np.log(down + tiny) + equal[:, None] * np.log(np.maximum(1 - up - down, tiny))
    return (like.argmax(1) < 40) & (like.max(1) - like[:, 40] > slack)


def _signatures(id_col: str, text_col: str, size: int, registers: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_worker_state()
        powers = Powers()
        for batch in batches:
            ids, text = batch.column(0), batch.column(1)
            for chunk in chunks(text):
                sets = shingles(words(chunk, powers, lower=True), size)
                full = [i for i, s in enumerate(sets) if len(s)]
                rows = np.zeros((len(sets), registers), np.uint8)
                if full:
                    rows[full] = sketch([sets[i] for i in full], registers)
                sums = np.array([[s.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(s * np.uint64(0x9E3779B97F4A7C15)))] for s in sets], np.uint64).reshape(-1, 2).view(np.int64)
                yield pa.record_batch([
                    ids.slice(chunk.first, len(sets)), pa.array([len(s) for s in sets], pa.int64()), pa.array(sums[:, 0]), pa.array(sums[:, 1]),
                    binaries(list(rows))], names=["id", "n", "h1", "h2", "sketch"])
    return run


def _bands(registers: int, width: int):
    count = registers // width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            rows = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, registers).astype(np.uint64)
            for band in range(count):
                key = np.full(len(rows), band + 1, np.uint64)
                for k in range(band * width, (band + 1) * width):
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
                yield pa.record_batch([pa.array(key.view(np.int64)), pa.array(ids)], names=["key", "id"])
    return run


def _likely(threshold: float, registers: int, slack: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, registers) for c in ("sa", "sb"))
            na, nb = (batch.column(c).to_numpy().astype(float) for c in ("na", "nb"))
            keep = pa.array(~unlikely(a, b, na, nb, threshold, slack))
            yield pa.record_batch([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(keep)
    return run


def _full_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_worker_state()
        powers = Powers()
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                sets = shingles(words(chunk, powers, lower=True), size)
                yield pa.record_batch([batch.column(0).slice(chunk.first, len(sets)), binaries(sets)], names=["id", "hashes"])
    return run


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.concatenate((x, y))
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (len(both) - shared))
            yield pa.record_batch([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each two sets of distinct hashes, by products of their incidence matrix in runs of columns."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(np.concatenate(sets), kind="stable")
    row, ranked = row[order], np.concatenate(sets)[order]
    fresh = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    column = np.cumsum(fresh) - 1
    often = np.bincount(column)[column] > 1
    row, column = row[often], column[often]
    counts = np.zeros((len(sets), len(sets)), np.float32)
    if len(column):
        column = np.cumsum(np.concatenate(([0], (column[1:] != column[:-1]).astype(np.int64))))
        for first in range(0, int(column[-1]) + 1, 4096):
            a, b = np.searchsorted(column, [first, first + 4096])
            some = np.zeros((len(sets), 4096), np.float32)
            some[row[a:b], column[a:b] - first] = 1
            counts += some @ some.T
    return counts.astype(np.int64)


def _across(percent: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        labels = group.column("label").to_pylist()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("hashes")]
        out: list[tuple[int, int]] = []
        if len(set(labels)) > 1:
            sizes = np.array([len(s) for s in sets])
            inter = shared_counts(sets)
            linked = np.triu(100 * inter >= percent * (sizes[:, None] + sizes[None, :] - inter), 1)
            top = {x: x for x in labels}

            def find(x: int) -> int:
                while top[x] != x:
                    top[x] = x = top[top[x]]
                return x
            for p, q in np.argwhere(linked).tolist():
                a, b = find(labels[p]), find(labels[q])
                if a != b:
                    top[max(a, b)] = min(a, b)
                    out.append((a, b))
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})
    return run


def block_pairs(members: DataFrame, block: int = BLOCK) -> DataFrame:
    """``hub, id, label, i, j``: the blocks to be compared so that any two members of a hub with different labels meet.

    Members under a group's most frequent label are linked already, so their blocks (``i >= 0``) meet only the blocks of all other members
    (``j < 0``), which also meet each other. A group with one label has none.
    """
    sizes = members.groupBy("hub", "label").agg(F.count("*").alias("n"))
    counts = sizes.groupBy("hub").agg(F.max(F.struct("n", "label")).alias("most"), F.sum("n").alias("n"))
    blocks = counts.select(
        "hub", F.col("most.label").alias("main"), F.ceil(F.col("most.n") / block).cast("int").alias("mains"),
        F.ceil((F.col("n") - F.col("most.n")) / block).cast("int").alias("others")).where("others > 0")
    dealt = members.join(blocks, "hub").withColumn("main", F.col("label") == F.col("main"))
    dealt = dealt.withColumn("own", F.expr("cast(if(main, pmod(xxhash64(id), mains), -1 - pmod(xxhash64(id), others)) as int)"))
    # A block of others goes to each block of the main label and to each block of others, its own included.
    meets = F.when(F.col("main"), F.sequence(-F.col("others"), F.lit(-1))).otherwise(F.sequence(-F.col("others"), F.col("mains") - 1))
    paired = dealt.select("hub", "id", "label", "own", F.explode(meets).alias("met"))
    return paired.select("hub", "id", "label", F.greatest("own", "met").alias("i"), F.least("own", "met").alias("j"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80, registers: int = 160,
    miss: float = 1e-6, slack: float = 14.0,
) -> DataFrame:
    """Per row of ``docs``: ``id, n_shingles, component_id`` (smallest id reachable over links), ``class_id`` (smallest id with an equal set)
    and ``kept`` (``id = component_id``).

    ``registers`` is the least size of a sketch; many documents get larger ones (``sketch_size``), for which their rows are counted first.
    Two documents link if ``100 * |intersection| >= percent * |union|`` of their distinct lower-cased ``shingle``-word sets. ``miss`` bounds
    the probability that a pair just at the threshold shares no band; ``slack`` is how much log-likelihood below its peak the threshold
    may be before a pair is left out. Null or empty texts have an empty set and link with nothing. Rows that share an id are one document.
    A null id links with nothing, its component is null and it is kept. An empty table gives no rows; other columns
    don't matter. An id with several texts links if any of them does.
    """
    spark = tuned(docs.sparkSession)
    threshold = percent / 100
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    registers, width = sketch_size(slim.count(), registers, threshold, miss)
    signed = stored(slim.mapInArrow(_signatures("id", "text", shingle, registers), "id long, n long, h1 long, h2 long, sketch binary"), "signed")
    full = signed.where("n > 0 and id is not null")
    classes = stored(full.groupBy("h1", "h2", "n").agg(F.min("id").alias("class_id")), "classes")
    own = full.join(classes.withColumnRenamed("class_id", "id"), ["h1", "h2", "n", "id"], "left_semi").select("id", "n", "h1", "h2", "sketch").dropDuplicates(["id", "h1", "h2"])
    nodes = stored(own.select("id", "n", "sketch"), "nodes")
    homes = full.join(classes, ["h1", "h2", "n"]).select("id", "class_id")
    mixed_ids = homes.groupBy("id").agg(F.min("class_id").alias("lo"), F.max("class_id").alias("hi")).where("lo <> hi").select("id")
    one_id = homes.where("id <> class_id").join(mixed_ids, "id").select(F.col("id").alias("a"), F.col("class_id").alias("b")).distinct()
    bands = nodes.select("id", "sketch").mapInArrow(_bands(registers, width), "key long, id long")
    crowded = bands.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
    shared = stored(bands.join(crowded, "key"), "shared")
    reach = shared.groupBy("id").agg(F.sum("c").alias("reach"))
    hubs = shared.join(reach, "id").groupBy("key").agg(F.max_by("id", "reach").alias("hub"))
    members = stored(shared.join(hubs, "key").select("hub", "id").distinct(), "members")
    # One shuffle of the texts, at any size: only documents that share a bucket need their full sets.
    needed = members.select("id").distinct()
    sets = stored(slim.join(needed.hint("merge"), "id", "left_semi").mapInArrow(_full_sets(shingle), "id long, hashes binary"), "sets")

    ends = {x: nodes.select(F.col("id").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}")) for x in "ab"}
    spokes = members.where("hub <> id").select(F.least("hub", "id").alias("a"), F.greatest("hub", "id").alias("b")).distinct()
    sized = spokes.join(ends["a"], "a").join(ends["b"], "b").where(f"100 * least(na, nb) >= {int(percent)} * greatest(na, nb)")
    likely = stored(sized.mapInArrow(_likely(threshold, registers, slack), "a long, b long"), "likely")
    both = likely.join(sets.select(F.col("id").alias("a"), F.col("hashes").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("hashes").alias("y")), "b")
    links = stored(both.mapInArrow(_linked(percent), "a long, b long").union(one_id), "links")
    labels = components(links)

    now = members.join(labels, "id", "left").select("hub", "id", F.coalesce("label", "id").alias("label"))
    crossed = block_pairs(now).join(sets, "id").groupBy("hub", "i", "j").applyInArrow(_across(percent), "a long, b long")
    labels = components(links.union(stored(crossed, "links")))
    out = signed.join(classes, ["h1", "h2", "n"], "left")
    out = out.join(labels.withColumnRenamed("id", "class_id"), "class_id", "left")
    component = F.when(F.col("id").isNull(), None).otherwise(F.coalesce("label", "class_id", "id"))
    return out.select(
        "id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.when(F.col("id").isNull(), None).otherwise(F.coalesce("class_id", "id")).alias("class_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
