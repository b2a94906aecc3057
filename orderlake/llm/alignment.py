"""Which tokens of two tokenizers belong together, by products of sparse incidence matrices.

Token-byte incidence A (tokens of the first tokenizer x bytes) times the transpose of B's gives the overlap links. Where no link crosses a
border between two tokens, both tokenizers end a token, so the links cut the bytes into groups. Group incidences (ids x groups, with how often
an id stands in a group) are multiplied in the same way: the entries of the product count the links of an id pair that share a group.
Matrices are rows of compressed indices (CSR); a product takes, for each row, the sum of the rows that its entries point to (Gustavson).

Both tokenizers cut a text in front of a single space or line feed between other characters, so such pieces are aligned once per chunk of documents,
and a third product, documents x pieces times pieces x id pairs, tells which documents hold a pair.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlake.llm._pieces import plain
from orderlake.llm._runtime import stored, tuned, worker_state
from orderlake.llm.bpe import byte_letters

CHUNK_CHARS = 8 << 20
ALIGNED_CHARS = 1 << 20
TERMS = 1 << 21
SHIFT = 20


class Csr(NamedTuple):
    """Row ``i`` has ``values[start[i]:start[i + 1]]`` in the columns ``cols[start[i]:start[i + 1]]``, which ascend."""

    start: np.ndarray
    cols: np.ndarray
    values: np.ndarray
    width: int

    @property
    def height(self) -> int:
        return len(self.start) - 1

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(self.height), np.diff(self.start))

    def transpose(self) -> Csr:
        order = np.argsort(self.cols, kind="stable")
        return Csr(np.concatenate(([0], np.cumsum(np.bincount(self.cols, minlength=self.width)))), self.rows()[order], self.values[order], self.height)

    def _terms(self, other: Csr) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """The product's terms in blocks of rows with about ``TERMS`` terms (a row with more is a block of its own): first and last row, keys
        ``row in the block * width + column``, and the entries of both factors."""
        spans = other.start[self.cols + 1] - other.start[self.cols]
        upto = np.concatenate(([0], np.cumsum(spans)))
        row_upto = upto[self.start]
        row = 0
        while row < self.height:
            stop = max(row + 1, int(np.searchsorted(row_upto, row_upto[row] + TERMS, "right")) - 1)
            a, b = self.start[row], self.start[stop]
            span = spans[a:b]
            term = np.arange(upto[b] - upto[a]) + np.repeat(other.start[self.cols[a:b]] - (upto[a:b] - upto[a]), span)
            key = np.repeat(np.repeat(np.arange(stop - row) * other.width, np.diff(self.start[row : stop + 1])), span)
            key += other.cols[term]
            yield row, stop, key, np.repeat(np.arange(a, b), span), term
            row = stop

    def times(self, other: Csr) -> Csr:
        none = np.zeros(0, np.int64)
        counts, cols, values = [none], [none], [none]
        for row, stop, key, mine, its in self._terms(other):
            value = self.values[mine] * other.values[its]
            if len(key) and (key[1:] < key[:-1]).any():
                order = np.argsort(key, kind="stable")
                key, value = key[order], value[order]
            new = _firsts(key)
            values.append(np.add.reduceat(value, new) if len(new) else value)
            place = key[new]
            cols.append(place % other.width)
            counts.append(np.bincount(place // other.width, minlength=stop - row))
        return Csr(np.concatenate(([0], np.cumsum(np.concatenate(counts)))).astype(np.int64), np.concatenate(cols), np.concatenate(values), other.width)

    def rows_with(self, other: Csr) -> np.ndarray:
        """In how many rows of the product each column has an entry; values don't matter."""
        held = np.zeros(other.width, np.int64)
        for _, _, key, _, _ in self._terms(other):
            key.sort()
            held += np.bincount(key[_firsts(key)] % other.width, minlength=other.width)
        return held


def _firsts(key: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)


def incidence(lengths: np.ndarray) -> Csr:
    """Tokens x bytes, for tokens of the given lengths one after the other."""
    start = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64)
    total = int(start[-1])
    return Csr(start, np.arange(total), np.ones(total, np.int64), total)


def counted(rows: np.ndarray, cols: np.ndarray, height: int, width: int) -> Csr:
    """How often each (row, column) occurs."""
    key, n = np.unique(rows * width + cols, return_counts=True)
    return Csr(np.concatenate(([0], np.cumsum(np.bincount(key // width, minlength=height)))), key % width, n, width)


class Overlaps(NamedTuple):
    """``links`` has the number of common bytes of each overlapping pair; ``group_a`` and ``group_b`` the group of each token."""

    links: Csr
    group_a: np.ndarray
    group_b: np.ndarray
    n_groups: int


def overlaps(lengths_a: np.ndarray, lengths_b: np.ndarray) -> Overlaps:
    """Links and groups of tokens of two tokenizers over the same bytes; no token is without bytes."""
    links = incidence(lengths_a).times(incidence(lengths_b).transpose())
    if not links.height:
        return Overlaps(links, np.zeros(0, np.int64), np.zeros(0, np.int64), 0)
    first, last = links.cols[links.start[:-1]], links.cols[links.start[1:] - 1]
    group_a = np.cumsum(np.concatenate(([0], first[1:] > last[:-1])))
    group_b = np.zeros(len(lengths_b), np.int64)
    group_b[links.cols] = group_a[links.rows()]
    return Overlaps(links, group_a, group_b, int(group_a[-1]) + 1)


class Tokenizers:
    """Ids of both tokenizers, and the bytes of each id."""

    def __init__(self, byte_path: str, piece_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        letters = byte_letters()
        with open(byte_path, encoding="utf-8") as file:
            spec = json.load(file)
        known = {i: bytes(letters[c] for c in t) for t, i in spec["model"]["vocab"].items() if all(c in letters for c in t)}
        known.update((t["id"], t["content"].encode()) for t in spec["added_tokens"])
        self.bytes_a = [known.get(i, b"") for i in range(max(known) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode() for p in pieces]
        self.length_a, self.length_b = (np.array(list(map(len, t)), np.int64) for t in (self.bytes_a, self.bytes_b))
        self.space = self.b.piece_to_id("▁")
        # Pieces stand alone if no entry goes on after a space or across a line feed.
        self.cuts = self.bytes_b[self.space] == b" " and not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces)
        self.spelt = [[str(i).encode() + end for i in range(max(len(self.bytes_a), len(self.bytes_b)))] for end in (b",", b"|", b";")]

    def pieces(self, text: str) -> list[str]:
        """A space and the text, cut where both tokenizers end a token anyway."""
        whole = " " + text
        if not self.cuts:
            return [whole]
        if plain(whole) and whole[-1] != " ":
            return whole.replace(" ", "\x1e ").replace("\n", "\x1e\n").split("\x1e")[1:]
        return _CUTS.split(whole)

    def encode(self, pieces: list[str]) -> tuple[list[list[int]], list[list[int]], np.ndarray]:
        """Ids of both for each piece, and whether the bytes of both are the piece's. A piece begins with the space that the second tokenizer
        puts in front of a text, or with a line feed, which stands after such a space."""
        a = [e.ids for e in self.a.encode_batch_fast(pieces, add_special_tokens=False)]
        b = self.b.encode([p[1:] if p[0] == " " else p for p in pieces], num_threads=1) if pieces else []
        good = np.ones(len(pieces), bool)
        for i, piece in enumerate(pieces):
            if piece[0] != " ":
                good[i] = b[i][0] == self.space
                b[i] = b[i][1:]
            whole = piece.encode()
            if not good[i] or b"".join(map(self.bytes_a.__getitem__, a[i])) != whole or b"".join(map(self.bytes_b.__getitem__, b[i])) != whole:
                a[i], b[i], good[i] = [], [], False
        return a, b, good


_CUTS = re.compile(r"(?<=\S)(?= \S)|(?<=\S)(?=\n\S)")


class Aligned(NamedTuple):
    """A list of pieces: whether both tokenizers give it back, numbers of tokens and groups, its id pairs from ``at_pair`` on (``keys`` are
    ``a << SHIFT | b``, ``times`` their links), and its groups as text."""

    good: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    at_pair: np.ndarray
    keys: np.ndarray
    times: np.ndarray
    spelt: list[bytes]


def _offsets(sizes: list[int] | np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)


def align(tokenizers: Tokenizers, pieces: list[str]) -> Aligned:
    parts_a, parts_b, good = tokenizers.encode(pieces)
    at_a, at_b = _offsets(list(map(len, parts_a))), _offsets(list(map(len, parts_b)))
    a, b = (np.fromiter(chain.from_iterable(parts), np.int64, int(at[-1])) for parts, at in ((parts_a, at_a), (parts_b, at_b)))
    found = overlaps(tokenizers.length_a[a], tokenizers.length_b[b])
    piece = np.repeat(np.arange(len(pieces)), np.diff(at_a))
    n_groups = np.bincount(piece[_firsts(found.group_a)], minlength=len(pieces))

    # Rows are the distinct ids of each piece.
    mine, row = np.unique((piece << SHIFT) + a, return_inverse=True)
    by_group = counted(found.group_b, b, found.n_groups, len(tokenizers.bytes_b))
    shared = counted(row.astype(np.int64), found.group_a, len(mine), max(1, found.n_groups)).times(by_group)
    of = shared.rows()
    keys = (mine[of] & ((1 << SHIFT) - 1)) << SHIFT | shared.cols
    at_pair = np.searchsorted(mine[of] >> SHIFT, np.arange(len(pieces) + 1))
    return Aligned(good, np.diff(at_a), np.diff(at_b), n_groups, at_pair, keys, shared.values, _spelt_groups(tokenizers, a, b, at_a, at_b, found))


def _spelt_groups(tokenizers: Tokenizers, a: np.ndarray, b: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, found: Overlaps) -> list[bytes]:
    """Each piece's groups, ids of A before those of B; empty without tokens."""
    in_a, in_b = (np.bincount(g, minlength=found.n_groups) for g in (found.group_a, found.group_b))
    before_a, before_b = np.cumsum(in_a), np.cumsum(in_b) - in_b
    size = len(tokenizers.spelt[0])
    order = np.zeros(len(a) + len(b), np.int64)
    last_a, last_b = (np.diff(g, append=found.n_groups) > 0 for g in (found.group_a, found.group_b))
    order[np.arange(len(a)) + before_b[found.group_a]] = a + size * last_a
    order[np.arange(len(b)) + before_a[found.group_b]] = b + 2 * size * last_b
    table = worker_state("align_spelt", lambda: [x for part in tokenizers.spelt for x in part])
    words = list(map(table.__getitem__, order.tolist()))
    at = (at_a + at_b).tolist()
    return [b"".join(words[x:y])[:-1] for x, y in zip(at[:-1], at[1:])]


LINKED = ("chunk long, kind int, place long, key long, held long, id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "sizes binary, places binary, times binary")
PAIR, PIECES, DOCUMENT = range(3)
PIECE_ROWS = 1 << 15
_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_TYPES = {"kind": pa.int32(), "groups_sha256": pa.string(), "sizes": pa.binary(), "places": pa.binary(), "times": pa.binary()}


def _table(n: int, **columns: Any) -> pa.RecordBatch:
    names = [f.split()[0] for f in LINKED.split(", ")]
    types = [_TYPES.get(c, pa.int64()) for c in names]
    return pa.record_batch([pa.nulls(n, t) if c not in columns else pa.array(columns[c], t) for c, t in zip(names, types)], names=names)


class Chunk:
    """Documents of a chunk as places in the list of its distinct pieces."""

    def __init__(self, number: int) -> None:
        self.number, self.size = number, 0
        self.pieces: dict[str, int] = {}
        self.ids: list[int | None] = []
        self.places: list[np.ndarray] = []

    def add(self, tokenizers: Tokenizers, doc: int | None, text: str) -> None:
        known = self.pieces
        self.ids.append(doc)
        self.places.append(np.array([known.setdefault(p, len(known)) for p in tokenizers.pieces(text)] if text else [], np.int32))
        self.size += len(text)

    def rows(self, tokenizers: Tokenizers) -> Iterator[pa.RecordBatch]:
        pieces = list(self.pieces)
        borders = np.unique(np.searchsorted(_offsets(list(map(len, pieces))), np.arange(0, self.size + ALIGNED_CHARS, ALIGNED_CHARS))).clip(0, len(pieces)).tolist()
        parts = [align(tokenizers, pieces[a:b]) for a, b in zip([0, *borders], [*borders, len(pieces)]) if b > a]
        if not parts:
            parts = [align(tokenizers, [])]
        good, n_a, n_b, n_groups, sizes, keys, times = (np.concatenate(x) for x in zip(*((p.good, p.n_a, p.n_b, p.n_groups, np.diff(p.at_pair), p.keys, p.times) for p in parts)))
        spelt = [x for p in parts for x in p.spelt]
        at_pair = _offsets(sizes)
        pairs, place = np.unique(keys, return_inverse=True)
        linked = Csr(at_pair, place.astype(np.int64), times, max(1, len(pairs)))

        whole = [bool(len(p)) and bool(good[p].all()) for p in self.places]
        places = [p if w else p[:0] for p, w in zip(self.places, whole)]
        doc = np.repeat(np.arange(len(places)), list(map(len, places)))
        flat = np.concatenate([np.zeros(0, np.int32), *places]).astype(np.int64)
        held = counted(doc, flat, len(places), max(1, len(pieces))).rows_with(linked) if len(pairs) else np.zeros(0, np.int64)
        n = len(pairs)
        for a in range(0, n, 1 << 17):
            k = len(pairs[a : a + (1 << 17)])
            yield _table(k, chunk=np.full(k, self.number), kind=np.full(k, PAIR), place=np.arange(a, a + k), key=pairs[a : a + k], held=held[a : a + k])
        for a in range(0, len(pieces), PIECE_ROWS):
            b = min(len(pieces), a + PIECE_ROWS)
            cut = slice(at_pair[a], at_pair[b])
            yield _table(1, chunk=[self.number], kind=[PIECES], place=[a], sizes=[sizes[a:b].astype(np.int32).tobytes()], places=[place[cut].astype(np.int32).tobytes()], times=[times[cut].tobytes()])
        n_links = np.diff(_offsets(times)[at_pair])
        digests = [hashlib.sha256(b";".join(map(spelt.__getitem__, p.tolist()))).hexdigest() if w else "" for p, w in zip(places, whole)]
        at = _offsets(list(map(len, places)))
        sums = {c: np.diff(_offsets(v[flat])[at]) for c, v in zip(_COUNTS, (n_a, n_b, n_groups, n_links))}
        k = len(places)
        yield _table(k, chunk=np.full(k, self.number), kind=np.full(k, DOCUMENT), id=self.ids, groups_sha256=digests, places=[p.tobytes() for p in places], **sums)


def _linked(byte_path: str, piece_path: str):
    """Rows of three kinds for each chunk: its distinct id pairs with the number of its documents that hold them; its pieces, whose pairs are
    places in that list; and its documents, which are places in the list of pieces."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = worker_state(f"align_{byte_path}_{piece_path}", lambda: Tokenizers(byte_path, piece_path), large=True)
        chunk = Chunk(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                chunk.add(tokenizers, doc, text.as_py() or "")
                if chunk.size >= CHUNK_CHARS:
                    yield from chunk.rows(tokenizers)
                    chunk = Chunk(chunk.number + 1)
        if chunk.ids:
            yield from chunk.rows(tokenizers)
    return run


def _valued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by chunk and kind: the counts of a chunk's pairs, its pieces, then its documents."""
    at, pairs, values, kinds = None, [], [], -1
    joined: list[np.ndarray] = []
    for batch in batches:
        chunk, kind = batch.column("chunk").to_numpy(), batch.column("kind").to_numpy()
        borders = (np.flatnonzero((chunk[1:] != chunk[:-1]) | (kind[1:] != kind[:-1])) + 1).tolist()
        for first, stop in zip([0, *borders], [*borders, len(chunk)]):
            if stop == first:
                continue
            if chunk[first] != at:
                at, pairs, values, kinds = chunk[first], [], [], -1
            rows = batch.slice(first, stop - first)
            if kind[first] != kinds:
                kinds = kind[first]
                parts = {PIECES: pairs, DOCUMENT: values}.get(kinds)
                if parts is not None:
                    joined = [np.concatenate([np.zeros(0, np.int64), *(p[k] for p in parts)]) for k in (0, 1)]
            if kinds == PAIR:
                pairs.append((rows.column("held").to_numpy(), rows.column("highest").to_numpy(zero_copy_only=False)))
            elif kinds == PIECES:
                for sizes, places, times in zip(*(rows.column(c).to_pylist() for c in ("sizes", "places", "times"))):
                    offsets, place, time = _offsets(np.frombuffer(sizes, np.int32)), np.frombuffer(places, np.int32), np.frombuffer(times, np.int64)
                    values.append(tuple(np.diff(_offsets(time * v[place].astype(np.int64))[offsets]) for v in joined))
            else:
                places = [np.frombuffer(p, np.int32) for p in rows.column("places").to_pylist()]
                offsets, flat = _offsets(list(map(len, places))), np.concatenate(places)
                held, best = (np.diff(_offsets(v[flat])[offsets]) for v in joined)
                yield pa.record_batch([rows.column(c) for c in ("id", *_COUNTS)] + [pa.array(v, pa.int64()) for v in (best, held)] + [rows.column("groups_sha256")],
                                      names=["id", *_COUNTS, "n_best", "count_sum", "groups_sha256"])


def links(docs: DataFrame, byte_tokenizer: str, piece_tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id pairs, pieces and documents of all chunks (``LINKED``); written to the shared folder."""
    tuned(docs.sparkSession)
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return stored(slim.mapInArrow(_linked(byte_tokenizer, piece_tokenizer), LINKED), "links", compression="zstd")


def pair_counts(linked: DataFrame) -> DataFrame:
    """``a, b, held, highest``: how many documents hold an id pair linked, and whether no pair of the same ``a`` is held by more."""
    pairs = linked.where("kind = 0").groupBy("key").agg(F.sum("held").alias("held")).withColumn("a", F.shiftright("key", SHIFT))
    most = F.max("held").over(Window.partitionBy("a"))
    return pairs.select("key", "a", F.col("key").bitwiseAND((1 << SHIFT) - 1).alias("b"), "held", (F.col("held") == most).alias("highest"))


def alignment_scores(docs: DataFrame, byte_tokenizer: str, piece_tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of each text, encoded by a byte-level file of the tokenizers library
    (with a space in front) and a sentencepiece model.

    Null and empty texts, and texts that either tokenizer doesn't give back byte by byte, have no tokens. Texts are read whole. Rows that repeat are documents of
    their own, null ids too. An empty table gives no rows; other columns don't matter, names included. Documents share the list of pairs of their chunk (about
    ``CHUNK_CHARS``), so corpus-wide counts are joined once per chunk and pair; no list of all pairs is sent to a task.
    """
    linked = links(docs, byte_tokenizer, piece_tokenizer, id_col, text_col)
    pairs = linked.where("kind = 0").select("chunk", "kind", "place", "key")
    valued = pairs.join(pair_counts(linked).select("key", "held", "highest"), "key").drop("key")
    scored = linked.where("kind > 0").drop("key", "held")
    both = valued.unionByName(scored, allowMissingColumns=True)
    return both.repartition("chunk").sortWithinPartitions("chunk", "kind", "place").mapInArrow(
        _valued, "id long, " + ", ".join(f"{c} long" for c in (*_COUNTS, "n_best", "count_sum")) + ", groups_sha256 string")
