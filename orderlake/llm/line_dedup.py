"""Repeated lines across documents by a deletion-neighbourhood join.

Two lines match if their words are equal up to one word inserted, deleted or replaced. A line's neighbourhood is the line and every line
that it becomes when one word is left out. Two lines match exactly if they are equal, if one is among the other's neighbours, or if both
become equal when the word at the same place is left out. All three are equalities of hashed keys, and the earliest line under a key
stands for all the others there, so no group is expanded into pairs. The witness is verified on the words themselves.

Only lines that can have a match give their neighbours: one edit leaves the first or the second half as it is, so a line none of whose
halves occurs in another line matches nothing, and where only the first half does, the edit lies in the second. That filter loses no match.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlake.llm._runtime import free_worker_state, stored, tuned
from orderlake.llm._text import Chunk, Powers, Words, chunks, mix, words

LAST = (1 << 63) - 1
LENGTH = np.uint64(0xD6E8FEB86659FD93)
# Bytes hashed at once: their numbers fit in a core's cache.
RUN = 1 << 17
WHOLE, CUT = 0, 1
# First and last words of a line of n words: halves of n words as they are, and of the n - 1 words left when one goes from the other half.
HALVES = ("p0", "s0", "p1", "s1")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Lines(NamedTuple):
    """Lines of a chunk with enough words: their text's row, their number in the text, and their first and last word (exclusive)."""

    row: np.ndarray
    number: np.ndarray
    first: np.ndarray
    stop: np.ndarray


def long_lines(chunk: Chunk, w: Words, least: int) -> Lines:
    breaks = np.flatnonzero(chunk.data == 10)
    begins = np.union1d(breaks + 1, chunk.at[:-1])
    row = np.searchsorted(chunk.at, begins, "right") - 1
    inside = row < len(chunk.at) - 1
    begins, row = begins[inside], row[inside]
    number = np.arange(len(begins)) - np.searchsorted(begins, chunk.at[row])
    first = np.searchsorted(w.start, begins)
    stop = np.append(first[1:], len(w.start))
    enough = stop - first >= least
    return Lines(row[enough], number[enough], first[enough], stop[enough])


class Sums:
    """Hashes of any run of words in constant time, from running sums."""

    def __init__(self, w: Words, powers: Powers) -> None:
        self.up, self.down = powers.upto(len(w.hash) + 2)
        self.total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(w.hash * self.up[: len(w.hash)], dtype=np.uint64)))

    def plain(self, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.total[stop] - self.total[first]) * self.down[first]

    def key(self, first: np.ndarray, stop: np.ndarray, salt: np.ndarray | int) -> np.ndarray:
        return mix(self.plain(first, stop) + np.asarray(salt).astype(np.uint64) * LENGTH)

    def without(self, first: np.ndarray, stop: np.ndarray, left_out: np.ndarray) -> np.ndarray:
        """Key of the line without one word, comparable with ``key`` of whole lines salted by their length."""
        rest = (self.total[stop] - self.total[left_out + 1]) * self.down[first + 1]
        return mix(self.plain(first, left_out) + rest + (stop - first - 1).astype(np.uint64) * LENGTH)


def _joined(batches: Iterator[pa.RecordBatch], rows: int = 1 << 15) -> Iterator[pa.RecordBatch]:
    """Small batches put together: each costs Spark some time of its own."""
    parts, n = [], 0
    for batch in batches:
        parts.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.concat_batches(parts)
            parts, n = [], 0
    if parts:
        yield pa.concat_batches(parts)


def _occurrences(exact: int, least: int):
    """Lines of ``exact`` words or more; those under ``least`` words have no halves, so nothing but an equal line matches them. A line that
    its own text holds earlier is no occurrence, as it goes anyway: it comes as a row without ``line``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_worker_state()
        powers = Powers()
        for batch in batches:
            for chunk in chunks(batch.column(1), RUN):
                w = words(chunk, powers)
                at = long_lines(chunk, w, exact)
                if not len(at.row):
                    continue
                sums = Sums(w, powers)
                n = at.stop - at.first
                line = sums.key(at.first, at.stop, n)
                _, once = np.unique(mix(line + at.row.astype(np.uint64) * LENGTH), return_index=True)
                again = np.ones(len(line), bool)
                again[once] = False
                halves = []
                for m in (n, n - 1):
                    half = m // 2
                    halves.append(sums.key(at.first, at.first + half, 4 * m + 2))
                    halves.append(sums.key(at.stop - (m - half), at.stop, 4 * m + 3))
                none = again | (n < least)
                here, of = slice(chunk.first, chunk.first + len(chunk.at) - 1), pa.array(at.row)
                yield pa.record_batch([
                    batch.column(0)[here].take(of), batch.column(2)[here].take(of), pa.array(at.number.astype(np.int32)),
                    pa.array(line.view(np.int64), mask=again), *(pa.array(c.view(np.int64), mask=none) for c in halves)],
                    names=["doc", "body", "number", "line", *HALVES])
    return lambda batches: _joined(run(batches))


def _neighbours(least: int):
    """Rows ``doc, text, numbers, sides``: for each listed line its whole key with its words, and its keys without one word. A bit of
    ``sides`` tells that the half of this place in ``HALVES`` occurs elsewhere, so words of the other half are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_worker_state()
        powers = Powers()
        for batch in batches:
            wanted = batch.column(2)
            listed = np.repeat(np.arange(len(wanted)), pc.list_value_length(wanted).to_numpy()) << 32 | wanted.flatten().field("number").to_numpy()
            order = np.argsort(listed)
            listed, sides = listed[order], wanted.flatten().field("sides").to_numpy()[order]
            for chunk in chunks(batch.column(1), RUN):
                w = words(chunk, powers)
                at = long_lines(chunk, w, least)
                own = (at.row + chunk.first) << 32 | at.number
                pick = np.flatnonzero(np.isin(own, listed))
                if not len(pick):
                    continue
                side = sides[np.searchsorted(listed, own[pick])]
                sums = Sums(w, powers)
                first, stop = at.first[pick], at.stop[pick]
                n = stop - first
                line = sums.key(first, stop, n)
                each = np.repeat(np.arange(len(pick)), n)
                place = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
                late, late1, of = place >= (n // 2)[each], place >= ((n - 1) // 2)[each], side[each]
                able = np.where(late, of & 1, of & 2) | np.where(late1, of & 4, of & 8) > 0
                each, place = each[able], place[able]
                cut = sums.without(first[each], stop[each], first[each] + place)
                docs = batch.column(0).slice(chunk.first, len(chunk.at) - 1).take(pa.array(at.row[pick]))
                numbers = pa.array(at.number[pick].astype(np.int32))
                spelt = pa.array([chunk.data[w.start[a] : w.end[b - 1]].tobytes().decode() for a, b in zip(first.tolist(), stop.tolist())], pa.string())
                unspelt = pa.nulls(len(each), pa.string())
                for key, of, role, where, body in ((line, np.arange(len(pick)), WHOLE, np.full(len(pick), -1), spelt), (cut, each, CUT, place, unspelt)):
                    of = pa.array(of)
                    yield pa.record_batch([
                        pa.array(key.view(np.int64)), pa.array(where.astype(np.int32)), pa.array(np.full(len(key), role, np.int32)), pa.array(line.view(np.int64)).take(of),
                        docs.take(of), numbers.take(of), body], names=["key", "place", "role", "line", "doc", "number", "words"])
    return lambda batches: _joined(run(batches))


def within_one(a: list[str], b: list[str]) -> bool:
    """Whether one word inserted, deleted or replaced makes the lists equal."""
    if abs(len(a) - len(b)) > 1:
        return False
    same = 0
    while same < min(len(a), len(b)) and a[same] == b[same]:
        same += 1
    return a[same + (len(a) >= len(b)) :] == b[same + (len(b) >= len(a)) :]


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        split = [[_WORD.findall(x) for x in batch.column(c).to_pylist()] for c in ("mine", "its")]
        yield batch.filter(pa.array([within_one(a, b) for a, b in zip(*split)], pa.bool_())).select(["line", "witness"])


OCCURRENCES = "doc long, body long, number int, line long, p0 long, s0 long, p1 long, s1 long"
NEIGHBOURS = "key long, place int, role int, line long, doc long, number int, words string"


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc, text, body``: a row is known by its id and the hash of its text, as very many rows may share an id or have none."""
    text = F.col(f"`{text_col}`").cast("string")
    return docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST)).alias("doc"), text.alias("text"), F.xxhash64(text).alias("body"))


def _seen(slim: DataFrame, least: int, exact: int) -> DataFrame:
    return stored(slim.mapInArrow(_occurrences(min(exact, least), least), OCCURRENCES), "lines")


def _able(first: DataFrame) -> DataFrame:
    """Lines that can have a match, and the ``sides`` of theirs that occur elsewhere."""
    each = first.select("line", F.posexplode(F.array(*HALVES)).alias("side", "half")).where("half is not null")
    # Halves of a line as it is meet such halves (a word replaced), and halves of longer lines (a word more).
    under = Window.partitionBy("half")
    met = each.select("line", "side", F.count(F.when(F.col("side") < 2, 1)).over(under).alias("same"), F.count(F.when(F.col("side") >= 2, 1)).over(under).alias("longer"))
    bit = F.when((F.col("side") >= 2) | (F.col("same") > 1), F.expr("shiftleft(1, side)")).otherwise(0)
    return met.where("same > 1 or same > 0 and longer > 0").groupBy("line").agg(F.bit_or(bit).alias("sides"))


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = 5, exact_words: int = 1) -> DataFrame:
    """Distinct lines: ``line`` (hash), ``times`` (documents that hold it), ``doc, number`` of the first occurrence, and ``witness``: the first
    occurrence of the earliest line that matches it up to one word, null if there is none. See ``dedup_lines``."""
    tuned(docs.sparkSession)
    slim = _slim(docs, id_col, text_col)
    return _repeated(slim, _seen(slim, least_words, exact_words), least_words)


def _repeated(slim: DataFrame, seen: DataFrame, least: int) -> DataFrame:
    earliest = seen.where("line is not null").groupBy("line").agg(F.count("*").alias("times"), F.min(F.struct("doc", "number", "body")).alias("at"), *(F.max(h).alias(h) for h in HALVES))
    first = stored(earliest.select("line", "times", "at.*", *HALVES), "first")
    able = stored(_able(first), "able")
    listed = first.join(able, "line").groupBy("doc", "body").agg(F.collect_list(F.struct("number", "sides")).alias("numbers"))
    near = stored(slim.join(listed.hint("merge"), ["doc", "body"]).select("doc", "text", "numbers").mapInArrow(_neighbours(least), NEIGHBOURS), "near")
    # Most keys come once and match nothing.
    twice = near.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    meet = stored(near.drop("words").join(twice.hint("merge"), "key", "left_semi"), "meet")

    rank = F.struct("doc", "number", "line")
    # Cut at the same place: one word replaced. Whole against cut: one word inserted or deleted.
    cut, whole = meet.where(F.col("role") == CUT), meet.where(F.col("role") == WHOLE)
    replaced = cut.groupBy("key", "place").agg(F.min(rank).alias("witness"), F.count("*").alias("n")).where("n > 1")
    longer = cut.groupBy("key").agg(F.min(rank).alias("witness"))
    shorter = whole.select("key", rank.alias("witness"))
    found = cut.join(replaced.select("key", "place", "witness"), ["key", "place"]).select("line", "doc", "number", "witness")
    found = found.union(whole.join(longer, "key").select("line", "doc", "number", "witness")).union(cut.join(shorter, "key").select("line", "doc", "number", "witness"))
    earlier = (F.col("witness.doc") < F.col("doc")) | ((F.col("witness.doc") == F.col("doc")) & (F.col("witness.number") < F.col("number")))
    best = stored(found.where(earlier).groupBy("line").agg(F.min("witness").alias("witness")), "best")
    spelt = near.where(F.col("role") == WHOLE).select("line", "words").dropDuplicates(["line"])
    pairs = best.join(spelt.withColumnRenamed("words", "mine"), "line").join(spelt.select(F.col("line").alias("of"), F.col("words").alias("its")), F.col("witness.line") == F.col("of"))
    sure = pairs.select("line", "witness", "mine", "its").mapInArrow(_verified, "line long, witness struct<doc: long, number: int, line: long>")
    return first.join(sure, "line", "left").select("line", "times", "doc", "number", "witness")


def _rebuild(keep: int):
    """Rows carry the id, other columns, the text and the numbers of its ``gone`` lines; ``keep`` counts the columns before the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free_worker_state()
        for batch in batches:
            text, gone = batch.column(keep), batch.column(keep + 1)
            total = pc.fill_null(pc.add(pc.count_substring(text, "\n").cast(pa.int64()), 1), 0)
            dropped = pc.fill_null(pc.list_value_length(gone).cast(pa.int64()), 0)
            cut = pc.is_valid(gone)
            out = []
            for whole, numbers in zip(text.filter(cut).to_pylist(), gone.filter(cut).to_pylist()):
                drop = set(numbers)
                out.append("\n".join(x for k, x in enumerate(whole.split("\n")) if k not in drop))
            text = pc.replace_with_mask(text, cut, pa.array(out, text.type))
            yield pa.record_batch([*(batch.column(i) for i in range(keep)), text, total, dropped], names=[*batch.schema.names[:keep], "text", "n_lines", "n_dropped"])
    return run


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = 5, exact_words: int = 1) -> DataFrame:
    """``docs`` with repeated lines taken out of the text, and ``n_lines`` (lines before) and ``n_dropped`` (those taken out).

    Lines are parts between line feeds; their words are runs of other characters than white space (0x20, 0x09-0x0D). A line of
    ``exact_words`` words or more goes if an earlier line, in the order of id and line number, has equal words; one of ``least_words`` or
    more also if an earlier line matches it up to one word, however long it is: a similarity of 0.8 at five words, and closer to 1 the
    longer the line. It goes whether the earlier line itself stays or not. A text without such a repetition stays as it is, to the
    character. Null texts stay null with no lines; the empty text is one line. Rows with one id are one document for the order, null ids
    come last. Columns ``n_lines`` and ``n_dropped`` of the input are replaced; others may have any names.
    """
    kept = [c for c in docs.columns if c not in (text_col, "n_lines", "n_dropped")]
    tuned(docs.sparkSession)
    slim = _slim(docs, id_col, text_col)
    seen = _seen(slim, least_words, exact_words)
    repeats = _repeated(slim, seen, least_words).where("times > 1 or witness is not null").select("line", F.when(F.col("witness").isNull(), F.col("doc")).alias("keep_doc"))
    repeats = stored(repeats, "repeats")
    gone = seen.join(repeats, "line").where("keep_doc is null or doc <> keep_doc").select("doc", "body", "number")
    gone = gone.union(seen.where("line is null").select("doc", "body", "number")).groupBy("doc", "body").agg(F.collect_set("number").alias("gone"))
    # The input's columns go by their place meanwhile, so that none clashes.
    aside = [F.col(f"`{c}`").alias(f"in_{i}") for i, c in enumerate(kept)]
    text = F.col(f"`{text_col}`").cast("string")
    plain = docs.select(*aside, text.alias("text"), F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(text).alias("body"))
    marked = plain.join(gone.hint("merge"), ["doc", "body"], "left").select(*(f"in_{i}" for i in range(len(kept))), "text", "gone")
    fields = "".join(f"{c} {t}, " for c, t in docs.select(*aside).dtypes)
    result = marked.mapInArrow(_rebuild(len(kept)), f"{fields}text string, n_lines long, n_dropped long")
    place = {c: f"in_{i}" for i, c in enumerate(kept)} | {text_col: "text"}
    return result.select(*(F.col(place[c]).alias(c) for c in docs.columns if c in place), "n_lines", "n_dropped")
