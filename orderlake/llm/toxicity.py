"""Toxicity by nearest labelled examples: exact TF-IDF cosine by a block-max inverted index, distance-weighted votes, calibration.

Terms are lower-cased words and their first bytes (5, 6 and 7 of longer words). The vocabulary is the terms whose document frequencies differ
most between the labels of the examples; inverse document frequencies come from all documents. Examples of one vector are one entry. Entries stand in
blocks, and every term keeps its postings and its largest weight for each block that holds it. A query reads only blocks whose upper bound reaches its
``k``-th cosine, so the neighbours are exact. Votes weigh by cosine and by how many labelled rows an entry stands for.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlake.llm._runtime import free_worker_state, tuned
from orderlake.llm._text import BYTES, Chunk, Powers, chunks, mix, words

PREFIXES = (5, 6, 7)
BLOCK = 64
EXAMPLES_PER_LABEL = 10_000
VOCABULARY = 4096
ROWS = 512
SHARE = 20
TIE = 1e-9
PRIOR = 0.25
SALTS = {p: np.uint64(p * 0xD6E8FEB86659FD93 % (1 << 64)) for p in PREFIXES}
APART = np.ones(256, bool)
APART[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def small_letters(data: np.ndarray) -> np.ndarray:
    """Lower-case ASCII and the Latin capitals of two bytes that begin with 0xC3."""
    out = data.copy()
    out[(data >= 0x41) & (data <= 0x5A)] += 32
    if len(data) > 1:
        second = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
        out[second] += 32
    return out


def term_keys(chunk: Chunk, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Key and row of every term occurrence of a chunk."""
    chunk = Chunk(chunk.first, small_letters(chunk.data), chunk.at)
    w = words(chunk, powers, apart=APART)
    row = np.repeat(np.arange(len(chunk.at) - 1), np.diff(w.at))
    keys, rows = [w.hash], [row]
    if len(w.start):
        up, down = powers.upto(len(chunk.data))
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTES[chunk.data] * up[: len(chunk.data)], dtype=np.uint64)))
        size = w.end - w.start
        for p in PREFIXES:
            longer = np.flatnonzero(size > p)
            at = w.start[longer]
            keys.append(mix((total[at + p] - total[at]) * down[at] + SALTS[p]))
            rows.append(row[longer])
    return np.concatenate(keys), np.concatenate(rows)


class Vocabulary:
    """Sorted term keys; a bitmap of their low bits turns most other terms away before the search."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = np.sort(keys)
        self.maybe = np.zeros(1 << 18, bool)
        self.maybe[(self.keys & np.uint64((1 << 18) - 1)).astype(np.int64)] = True

    def counts(self, chunk: Chunk, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, term and number of occurrences, sorted, of the vocabulary's terms in a chunk."""
        key, row = term_keys(chunk, powers)
        some = np.flatnonzero(self.maybe[(key & np.uint64((1 << 18) - 1)).astype(np.int64)])
        key, row = key[some], row[some]
        if not len(self.keys) or not len(key):
            return (np.zeros(0, np.int64),) * 3
        term = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[term] == key
        both, n = np.unique(row[hit] * len(self.keys) + term[hit], return_counts=True)
        return both // len(self.keys), both % len(self.keys), n


class Model(NamedTuple):
    """All that scoring needs; its size is bounded by the bounds on examples and vocabulary.

    An entry is one vector: ``ids`` has the smallest id of its examples, ``votes`` their weight, ``labels`` the share of the weight that is toxic.
    ``example`` (an entry's place), ``term`` and ``weight`` are the postings. ``member_*`` name the entry and label of each example.
    """

    keys: np.ndarray
    idf: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    votes: np.ndarray
    example: np.ndarray
    term: np.ndarray
    weight: np.ndarray
    base: float
    unknown: float
    raw: np.ndarray
    level: np.ndarray
    member_ids: np.ndarray = np.zeros(0, np.int64)
    member_entry: np.ndarray = np.zeros(0, np.int64)
    member_label: np.ndarray = np.zeros(0)
    member_votes: np.ndarray = np.ones(2)


def unit(term: np.ndarray, n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weight = (1 + np.log(n)) * idf[term]
    return weight / np.sqrt((weight * weight).sum())


def spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of all spans, one after the other."""
    before = np.cumsum(size) - size
    return np.arange(size.sum()) + np.repeat(start - before, size)


def kth(values: np.ndarray, k: int) -> float:
    """The ``k``-th largest value, 0 if there are fewer or it is negative."""
    return max(0.0, float(np.partition(values, len(values) - k)[len(values) - k])) if len(values) >= k else 0.0


class Index:
    """Block-max inverted index over the entries of a model.

    A term in a large share of the entries (at most ``ROWS`` terms) has its weights as a row over all entries, any other term its postings and
    largest weights by block, stored only for the blocks that hold it. Each entry's own terms stand together once more, for its exact cosine.
    """

    def __init__(self, model: Model) -> None:
        self.model, self.count, terms = model, len(model.ids), len(model.keys)
        self.blocks = max(1, -(-self.count // BLOCK))
        self.own_term, self.own_weight = model.term, model.weight
        self.own = np.searchsorted(model.example, np.arange(self.count + 1))
        holds = np.bincount(model.term, minlength=terms)
        frequent = np.argsort(-holds, kind="stable")[:ROWS]
        frequent = frequent[holds[frequent] * SHARE > self.count]
        self.row_of = np.full(terms, -1)
        self.row_of[frequent] = np.arange(len(frequent))
        self.rows = np.zeros((len(frequent), self.blocks * BLOCK), np.float32)
        here = self.row_of[model.term] >= 0
        self.rows[self.row_of[model.term[here]], model.example[here]] = model.weight[here]
        order = np.flatnonzero(~here)
        order = order[np.argsort(model.term[order], kind="stable")]
        self.example, self.weight, term = model.example[order].astype(np.int64), model.weight[order], model.term[order]
        block = self.example // BLOCK
        new = np.concatenate(([True], (term[1:] != term[:-1]) | (block[1:] != block[:-1]))) if len(term) else np.zeros(0, bool)
        self.start = np.flatnonzero(new)
        self.size = np.diff(np.append(self.start, len(term)))
        self.block = block[self.start]
        self.top = np.maximum.reduceat(self.weight, self.start) if len(term) else np.zeros(0)
        self.cells = np.searchsorted(term[self.start], np.arange(terms + 1))
        self.query = np.zeros(terms)

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int, barred: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the ``k`` nearest entries with a common term, and of all that tie with the ``k``-th, nearest first.

        The rows of frequent terms come first. With them every block has a best entry, and the ``k``-th best of these is a cosine that the
        ``k``-th neighbour reaches. Postings of the other terms are read only in blocks that can reach it. The sums are of single precision; all
        entries that reach the ``k``-th best within its error then get their exact cosine.
        """
        slack = (len(term) + 4) * 2.0**-23
        row, single = self.row_of[term], weight.astype(np.float32)
        total, part = np.zeros(self.blocks * BLOCK, np.float32), np.empty(self.blocks * BLOCK, np.float32)
        for r, q in zip(row[row >= 0].tolist(), single[row >= 0]):
            total += np.multiply(self.rows[r], q, out=part)
        if barred >= 0:
            total[barred] = -1
        seldom = term[row < 0]
        size = self.cells[seldom + 1] - self.cells[seldom]
        cell, query = spans(self.cells[seldom], size), np.repeat(weight[row < 0], size)
        best = total.reshape(-1, BLOCK).max(1)
        bounds = np.maximum(best, 0) + np.bincount(self.block[cell], query * self.top[cell], minlength=self.blocks)
        wanted = (bounds >= kth(best, k) - slack)[self.block[cell]]
        cell, query = cell[wanted], query[wanted]
        size = self.size[cell]
        place = spans(self.start[cell], size)
        total += np.bincount(self.example[place], np.repeat(query, size) * self.weight[place], minlength=len(total)).astype(np.float32)
        if barred >= 0:
            total[barred] = -1
        at = np.flatnonzero(total >= max(kth(total.reshape(-1, BLOCK).max(1), k) - slack, 2.0**-60))
        self.query[term] = weight
        cosines = self._cosines(at)
        self.query[term] = 0
        keep = cosines >= kth(cosines, k) - TIE
        at, cosines = at[keep], cosines[keep]
        order = np.lexsort((at, -cosines))
        return at[order], cosines[order]

    def _cosines(self, at: np.ndarray) -> np.ndarray:
        if not len(at):
            return np.zeros(0)
        size = self.own[at + 1] - self.own[at]
        place = spans(self.own[at], size)
        return np.add.reduceat(self.query[self.own_term[place]] * self.own_weight[place], np.cumsum(size) - size)

    def vote(self, at: np.ndarray, cosine: np.ndarray, left_out: tuple[int, float] | None = None) -> float:
        """Share of the toxic votes; ``left_out`` is the entry and label of one example whose vote doesn't count."""
        every = self.model.votes[at]
        toxic = every * self.model.labels[at]
        if left_out is not None:
            own = (at == left_out[0]) * self.model.member_votes[int(left_out[1])]
            every, toxic = every - own, toxic - own * left_out[1]
        power, prior = cosine**2, PRIOR * self.model.member_votes.min()
        return float(((power * toxic).sum() + prior * self.model.base) / ((power * every).sum() + prior))


def calibrate(raw: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression: centres and levels of its steps, to be interpolated."""
    order = np.argsort(raw, kind="stable")
    steps: list[list[float]] = []
    for r, t, w in zip(raw[order].tolist(), y[order].tolist(), weight[order].tolist()):
        steps.append([r * w, t * w, w])
        while len(steps) > 1 and steps[-2][1] * steps[-1][2] >= steps[-1][1] * steps[-2][2]:
            last = steps.pop()
            steps[-1] = [a + b for a, b in zip(steps[-1], last)]
    return np.array([s[0] / s[2] for s in steps]), np.array([s[1] / s[2] for s in steps])


def held_out(id_col: str = "doc_id"):
    """Rows from whose labels nothing is learned."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", k: int = 15,
        examples_per_label: int = EXAMPLES_PER_LABEL, vocabulary: int = VOCABULARY, least_documents: int = 1, least_g: float = 0.0,
        least_ratio: float = 1.0) -> Model:
    """Learn from at most ``examples_per_label`` labelled rows of each label, spread by a hash of the id, none of them held out.

    The share of each label comes from all rows that may be learned from. Labels of an id that differ count as the larger one, null labels
    as none. Terms are the ``vocabulary`` ones of the largest G statistic against the label; thresholds may leave out more of them: terms in fewer
    than ``least_documents`` examples, of a G below ``least_g``, or whose shares among the labels differ less than ``least_ratio`` times. Cosines are
    over these terms. Examples of equal vectors are one entry that votes with all their labels. Ids of the examples are sent to all tasks: ``2 * examples_per_label`` numbers at most.
    """
    spark = tuned(docs.sparkSession)
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col)).groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    totals = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect() if r["y"] in (0, 1)}
    every = sum(totals.values())
    base = totals.get(1, 0) / every if every else 0.0
    slim = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    some = None
    for y in (0, 1):
        drawn = known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(examples_per_label)
        some = drawn if some is None else some.union(drawn)
    drawn = [(r["id"], r["y"]) for r in some.collect()]
    chosen = F.broadcast(spark.createDataFrame(drawn, "id long, y int"))
    sample = slim.join(chosen, "id").select("id", "y", "text")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_worker_state()
        powers = Powers()
        for batch in batches:
            y = batch.column(1).to_numpy()
            for chunk in chunks(batch.column(2)):
                key, row = term_keys(chunk, powers)
                order = np.lexsort((row, key))
                key, row = key[order], row[order]
                once = np.concatenate(([True], (key[1:] != key[:-1]) | (row[1:] != row[:-1]))) if len(key) else np.zeros(0, bool)
                key, label = key[once], y[chunk.first + row[once]]
                distinct, back = np.unique(key, return_inverse=True)
                ones = np.bincount(back, label, minlength=len(distinct)).astype(np.int64)
                every = np.bincount(back, minlength=len(distinct))
                yield pa.record_batch([pa.array(distinct.view(np.int64)), pa.array(ones), pa.array(every - ones)], names=["key", "ones", "zeros"])

    ones, zeros = (max(1, sum(y == v for _, y in drawn)) for v in (1, 0))
    counted = sample.mapInArrow(frequencies, "key long, ones long, zeros long").groupBy("key").agg(F.sum("ones").alias("a"), F.sum("zeros").alias("b"))
    a, b = F.col("a"), F.col("b")
    share = ones / (ones + zeros)
    part = lambda n, expected: F.when(n > 0, n * F.log(n / expected)).otherwise(0.0)
    g = 2 * (part(a, (a + b) * share) + part(b, (a + b) * (1 - share)))
    ratio = ((a + 0.5) / (ones + 1)) / ((b + 0.5) / (zeros + 1))
    telling = counted.where(a + b >= least_documents).select("key", g.alias("g"), ratio.alias("ratio")).where((F.col("g") >= least_g) & ((F.col("ratio") >= least_ratio) | (F.col("ratio") <= 1 / least_ratio)))
    keys = np.sort(np.array([r["key"] for r in telling.orderBy(F.desc("g"), "key").limit(vocabulary).collect()], np.int64).view(np.uint64))
    lexicon = Vocabulary(keys)

    def document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_worker_state()
        powers, seen, rows = Powers(), np.zeros(len(keys) + 1, np.int64), 0
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                _, term, _ = lexicon.counts(chunk, powers)
                seen[:-1] += np.bincount(term, minlength=len(keys))
            rows += batch.num_rows
        seen[-1] = rows
        yield pa.record_batch([pa.array(np.arange(len(seen))), pa.array(seen)], names=["term", "n"])

    frequency = np.zeros(len(keys) + 1)
    for r in slim.mapInArrow(document_counts, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        frequency[r["term"]] = r["n"]
    idf = np.log((1 + frequency[-1]) / (1 + frequency[:-1])) + 1

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            for chunk in chunks(batch.column(2)):
                row, term, n = lexicon.counts(chunk, powers)
                size = len(chunk.at) - 1
                cuts = np.searchsorted(row, np.arange(size + 1))
                lists = [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(x.astype(np.int64))) for x in (term, n)]
                yield pa.record_batch([batch.column(0).slice(chunk.first, size), batch.column(1).slice(chunk.first, size), *lists], names=["id", "y", "term", "n"])

    found = sample.mapInArrow(vectors, "id long, y int, term array<long>, n array<long>").toArrow().combine_chunks()
    ids, labels_of = found.column("id").to_numpy(), found.column("y").to_numpy().astype(float)
    lists = [column.combine_chunks() if isinstance(column := found.column(c), pa.ChunkedArray) else column for c in ("term", "n")]
    at = np.concatenate(([0], np.cumsum(lists[0].value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64)
    terms, counts = (x.flatten().to_numpy(zero_copy_only=False) for x in lists)
    weight_of = np.array([totals.get(v, 0) / max(1, (labels_of == v).sum()) for v in (0, 1)])
    blank = labels_of[np.diff(at) == 0].astype(int)
    unknown = float((weight_of[blank] * blank).sum() / max(1e-9, weight_of[blank].sum())) if len(blank) else base
    entries: dict[bytes, list[int]] = {}
    units: list[tuple[np.ndarray, np.ndarray]] = []
    for i in np.argsort(ids, kind="stable").tolist():
        term = terms[at[i] : at[i + 1]]
        if len(term):
            weight = unit(term, counts[at[i] : at[i + 1]], idf)
            same = entries.setdefault(term.tobytes() + np.round(weight, 12).tobytes(), [])
            if not same:
                units.append((term, weight))
            same.append(i)
    # Entries of the same heaviest term stand together, so that few blocks have a high bound for it.
    spoken = sorted(zip(entries.values(), units), key=lambda x: (int(x[1][0][x[1][1].argmax()]), int(ids[x[0][0]])))
    sizes = [len(term) for _, (term, _) in spoken]
    flat = lambda part, kind: np.concatenate([x[1][part] for x in spoken]).astype(kind) if spoken else np.zeros(0, kind)
    member = np.array([i for same, _ in spoken for i in same], np.int64)
    entry = np.repeat(np.arange(len(spoken)), [len(same) for same, _ in spoken])
    votes = np.bincount(entry, weight_of[labels_of[member].astype(int)], minlength=len(spoken))
    toxic = np.bincount(entry, weight_of[1] * labels_of[member], minlength=len(spoken))
    model = Model(
        keys, idf, np.array([ids[same[0]] for same, _ in spoken], np.int64), toxic / np.maximum(votes, 1e-9), votes,
        np.repeat(np.arange(len(spoken), dtype=np.int32), sizes), flat(0, np.int32), flat(1, float), base, unknown, np.zeros(0), np.zeros(0),
        ids[member], entry, labels_of[member], np.where(weight_of > 0, weight_of, weight_of.max()))
    if not spoken:
        return model
    trial = apply(sample, model, k, text_col="text", id_col="id", leave_out=True).join(chosen, "id").where("known").select("raw", "y").collect()
    y = np.array([r["y"] for r in trial], float)
    raw, level = calibrate(np.array([r["raw"] for r in trial]), y, np.where(y > 0, weight_of[1], weight_of[0]))
    return model._replace(raw=raw, level=level)


def apply(docs: DataFrame, model: Model, k: int = 15, id_col: str = "doc_id", text_col: str = "text", leave_out: bool = False, keep: bool = False) -> DataFrame:
    """``id, raw, score, known, evidence`` of each row: the vote, the calibrated score, whether a term of the vocabulary occurs, and the nearest
    entries as ``(id, cosine, label)``, the label being the toxic share of the entry's examples. With ``leave_out`` an example isn't its own neighbour; with ``keep`` the columns of ``docs`` come with it, but
    for those of these names."""
    tuned(docs.sparkSession)
    others = [c for c in docs.columns if c not in ("id", "raw", "score", "known", "evidence")] if keep else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_worker_state()
        powers, lexicon, index = Powers(), Vocabulary(model.keys), Index(model)
        own = {i: (e, y) for i, e, y in zip(model.member_ids.tolist(), model.member_entry.tolist(), model.member_label.tolist())} if leave_out else {}
        members = np.bincount(model.member_entry, minlength=len(model.ids))
        nothing = np.zeros(0, np.int64), np.zeros(0)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for chunk in chunks(batch.column(1 + len(others))):
                size = len(chunk.at) - 1
                row, term, n = lexicon.counts(chunk, powers)
                cuts = np.searchsorted(row, np.arange(size + 1)).tolist()
                raw, known = np.full(size, model.base), np.zeros(size, bool)
                found: list[tuple[np.ndarray, np.ndarray]] = []
                for i in range(size):
                    a, b = cuts[i], cuts[i + 1]
                    at, cosine = nothing
                    if b > a:
                        out = own.get(ids[chunk.first + i])
                        alone = out is not None and members[out[0]] == 1
                        at, cosine = index.nearest(term[a:b], unit(term[a:b], n[a:b], model.idf), k, out[0] if alone else -1)
                        known[i] = len(at) > 0
                        raw[i] = index.vote(at, cosine, None if alone else out)
                    found.append((at, cosine))
                near = np.concatenate([nothing[0], *(at for at, _ in found)])
                cosines = np.concatenate([nothing[1], *(cosine for _, cosine in found)])
                until = np.concatenate(([0], np.cumsum([len(at) for at, _ in found]))).astype(np.int32)
                evidence = pa.StructArray.from_arrays([pa.array(model.ids[near]), pa.array(cosines), pa.array(model.labels[near])], names=["id", "cosine", "label"])
                score = np.interp(raw, model.raw, model.level) if len(model.raw) else raw
                score = np.clip(np.where(known, score, model.unknown), 0, 1)
                yield pa.record_batch([
                    *(batch.column(c).slice(chunk.first, size) for c in range(1 + len(others))), pa.array(raw), pa.array(score), pa.array(known),
                    pa.ListArray.from_arrays(pa.array(until), evidence)],
                    names=["id", *others, "raw", "score", "known", "evidence"])
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), *(F.col(f"`{c}`") for c in others), F.col(f"`{text_col}`").cast("string").alias("scored text"))
    fields = ", ".join(f"`{c}` {t}" for c, t in slim.dtypes[:-1])
    return slim.mapInArrow(run, f"{fields}, raw double, score double, known boolean, evidence array<struct<id: long, cosine: double, label: double>>")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options: float) -> DataFrame:
    """``id, held_out, score, predicted, evidence`` for each row of ``docs``.

    A null or empty text, or one without a term of the vocabulary, gets the share of toxic rows among such labelled rows. Without labels all
    scores are 0. Texts decide alone: equal texts have equal scores. Repeated rows are scored each; an empty table gives no rows.
    """
    model = fit(docs, labels, **options)
    scored = apply(docs, model)
    return scored.select("id", held_out("id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence")
