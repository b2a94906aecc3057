"""Byte-level BPE by speculation: greedy longest match proposes tokens, every adjacent pair is checked, failing words are merged exactly.

A sequence of tokens is the one that merging gives if each token is merged from its own bytes and each two neighbours stay apart when
their joint bytes are merged. Verdicts on pairs are remembered and looked up for all words of a batch at once; only words with a pair
that doesn't hold go through the merge list.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderlake.llm._pieces import Remembered, byte_borders, id_bytes, text_runs
from orderlake.llm._runtime import tuned, worker_state

KNOWN_PAIRS = 1_000_000
# Planes beyond hold no letters, numbers or white space in any version of Unicode.
ASSIGNED = [*range(0xD800), *range(0xE000, 0x34000), *range(0xE0000, 0xE1000)]


def _ranges(points: set[int]) -> str:
    """A character class of code points."""
    ordered = sorted(points)
    firsts = [p for p in ordered if p - 1 not in points]
    lasts = [p for p in ordered if p + 1 not in points]
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(firsts, lasts)) + "]"


def pre_tokens(path: str) -> regex.Pattern:
    """The file's published pattern with the letters, numbers and white space of the library, whose tables differ from this package's.

    A code point is a letter if it joins two letters to one pre-token, a number between two digits, neither nor white space between marks.
    """
    pre = Tokenizer.from_file(path).pre_tokenizer
    text = "".join(f"a{c}a\n1{c}1\n!{c}!\n" for c in map(chr, ASSIGNED))
    whole = np.zeros(len(text), bool)
    whole[[a for _, (a, b) in pre.pre_tokenize_str(text) if b - a == 3]] = True
    points = np.array(ASSIGNED)
    own = {"L": set(points[whole[0::12]].tolist()), "N": set(points[whole[4::12]].tolist())}
    own["s"] = set(points[~(whole[0::12] | whole[4::12] | whole[8::12])].tolist())
    every = "".join(map(chr, ASSIGNED))
    classes = {}
    for name, prop in (("L", r"\p{L}"), ("N", r"\p{N}"), ("s", r"\s")):
        known = set(map(ord, regex.findall(prop, every)))
        out = prop
        if known - own[name]:
            out = f"[{out}--{_ranges(known - own[name])}]"
        if own[name] - known:
            out = f"[{out}||{_ranges(own[name] - known)}]"
        classes[name] = out
    letter, number, space = (classes[c] for c in "LNs")
    return regex.compile(rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+| ?[^{space}{letter}{number}]+|{space}+(?![^{space}])|{space}+")


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Bpe:
    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        to_bytes = lambda token: bytes(letters[c] for c in token)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocabulary = {t: i for t, i in spec["model"]["vocab"].items() if t not in self.added}
        self.token: dict[bytes, int] = {to_bytes(t): i for t, i in vocabulary.items()}
        self.bytes: list[bytes] = [b""] * (1 + max([*vocabulary.values(), *self.added.values()]))
        for token, i in self.token.items():
            self.bytes[i] = token
        for token, i in self.added.items():
            self.bytes[i] = token.encode()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.merges = {(vocabulary[a], vocabulary[b]): (rank, vocabulary[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.longest: dict[bytes, int] = {}
        for token in self.token:
            self.longest[token[:2]] = max(self.longest.get(token[:2], 1), len(token))
        self.pairs, self.holds = np.zeros(0, np.int64), np.zeros(0, bool)
        self.width = len(self.bytes)
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None
        self.pre_tokens = pre_tokens(path)
        self.memory = Remembered(lambda pieces: id_bytes(self.encode_pieces(pieces.to_pylist())), byte_borders, list(self.added))

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: always the pair that stands first in the merge list, leftmost first."""
        ids = [self.token[word[i : i + 1]] for i in range(len(word))]
        merges = self.merges
        if len(ids) < 40:
            while len(ids) > 1:
                best, at = None, -1
                for i in range(len(ids) - 1):
                    found = merges.get((ids[i], ids[i + 1]))
                    if found is not None and (best is None or found < best):
                        best, at = found, i
                if best is None:
                    break
                ids[at : at + 2] = [best[1]]
            return ids
        after = [*range(1, len(ids)), -1]
        before = [*range(-1, len(ids) - 1)]
        heap = [(*merges[p], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in merges]
        heapq.heapify(heap)
        while heap:
            _, new, i, pair = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else -1
            if j < 0 or (ids[i], ids[j]) != pair:
                continue
            ids[i], ids[j] = new, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else -1
                if right >= 0 and (p := (ids[left], ids[right])) in merges:
                    heapq.heappush(heap, (*merges[p], left, p))
        return [i for i in ids if i >= 0]

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match."""
        out, at, n = [], 0, len(word)
        token, longest = self.token, self.longest
        while at < n:
            stop = min(n, at + longest.get(word[at : at + 2], 1))
            while (found := token.get(word[at:stop])) is None:
                stop -= 1
            out.append(found)
            at = stop
        return out

    def compatible(self, keys: np.ndarray) -> np.ndarray:
        """For pairs as ``left * (width + 1) + right``, whether merging their joint bytes leaves just these two; ``width`` stands for nothing."""
        distinct, back = np.unique(keys, return_inverse=True)
        place = np.searchsorted(self.pairs, distinct)
        known = np.zeros(len(distinct), bool)
        inside = place < len(self.pairs)
        known[inside] = self.pairs[place[inside]] == distinct[inside]
        verdict = np.zeros(len(distinct), bool)
        verdict[known] = self.holds[place[known]]
        fresh = np.flatnonzero(~known)
        if len(fresh):
            for k in fresh.tolist():
                left, right = divmod(int(distinct[k]), self.width + 1)
                pair = [left] if right == self.width else [left, right]
                verdict[k] = self.merge(b"".join(self.bytes[t] for t in pair)) == pair
            if len(self.pairs) > KNOWN_PAIRS:
                self.pairs, self.holds = np.zeros(0, np.int64), np.zeros(0, bool)
            pairs = np.concatenate((self.pairs, distinct[fresh]))
            order = np.argsort(pairs, kind="stable")
            self.holds = np.concatenate((self.holds, verdict[fresh]))[order]
            self.pairs = pairs[order]
        return verdict[back]

    def words(self, distinct: list[bytes]) -> list[list[int]]:
        """Ids of each word. A lone token is checked as the pair of it and nothing."""
        proposed = [self.propose(w) for w in distinct]
        if not proposed:
            return []
        sizes = np.array([len(p) for p in proposed])
        flat = np.concatenate([np.array(p, np.int64) for p in proposed])
        last = np.cumsum(sizes) - 1
        right = np.append(flat[1:], self.width)
        right[last] = self.width
        test = np.ones(len(flat), bool)
        test[last[sizes > 1]] = False
        good = np.ones(len(flat), bool)
        good[test] = self.compatible(flat[test] * (self.width + 1) + right[test])
        whole = np.logical_and.reduceat(good, last - sizes + 1)
        for k in np.flatnonzero(~whole).tolist():
            proposed[k] = self.merge(distinct[k])
        return proposed

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit bytes."""
        cut: list[list[bytes | int]] = []
        for piece in pieces:
            segments = self.split_added.split(piece) if self.split_added else [piece]
            words: list[bytes | int] = []
            for k, segment in enumerate(segments):
                if k % 2:
                    words.append(self.added[segment])
                else:
                    words.extend(w.encode() for w in self.pre_tokens.findall(segment))
            cut.append(words)
        distinct = list({w for words in cut for w in words if isinstance(w, bytes)})
        found = {w: np.array(ids, "<u4").tobytes() for w, ids in zip(distinct, self.words(distinct))}
        return [b"".join(found[w] if isinstance(w, bytes) else w.to_bytes(4, "little") for w in words) for words in cut]

    def encode(self, texts: list[str]) -> list[bytes]:
        return self.memory.ids(texts)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")


def _model(path: str) -> Bpe:
    return worker_state(f"bpe_{path}", lambda: Bpe(path), large=True)


def bpe_encode(df: DataFrame, tokenizer: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Replace the text column by the list of its ids. Null and empty texts have no ids. Other columns stay as they are; one named
    ``ids_col`` gives way."""
    return _mapped(df, text_col, ids_col, "array<int>", lambda column: pa.array(
        [np.frombuffer(x, np.int32) for _, run in text_runs(column) for x in _model(tokenizer).encode(run)], pa.list_(pa.int32())))


def bpe_decode(df: DataFrame, tokenizer: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """Replace the list of ids by its text; bytes that are no UTF-8 become the replacement character. A null list is the empty text."""
    return _mapped(df, ids_col, text_col, "string", lambda column: pa.array([_model(tokenizer).decode(x or []) for x in column.to_pylist()], pa.string()))


def _mapped(df: DataFrame, old: str, new: str, kind: str, change) -> DataFrame:
    tuned(df.sparkSession)
    kept = [c for c in df.columns if c not in (old, new)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([*(batch.column(i) for i in range(len(kept))), change(batch.column(len(kept)))], names=[*kept, new])
    fields = ", ".join(f"`{c}` {t}" for c, t in df.select(*(F.col(f"`{c}`") for c in kept)).dtypes)
    return df.select(*(F.col(f"`{c}`") for c in [*kept, old])).mapInArrow(run, ", ".join(filter(None, [fields, f"`{new}` {kind}"])))


def bpe_digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256``: the ids of each text and the text decoded from them, in one pass.

    Null and empty texts have no ids and the digests of the empty string. Texts are encoded whole, in runs of about four million characters or one longer text.
    Rows that repeat, and null ids, give a row each. An empty table gives no rows; other columns don't matter, names included.
    """
    tuned(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(tokenizer)
        shown = worker_state("decimals", lambda: [str(i) for i in range(len(model.bytes))])
        for batch in batches:
            for first, texts in text_runs(batch.column(1)):
                counts, ids_hash, text_hash = [], [], []
                for coded in model.encode(texts):
                    ids = np.frombuffer(coded, "<u4").tolist()
                    counts.append(len(ids))
                    ids_hash.append(hashlib.sha256(",".join(map(shown.__getitem__, ids)).encode()).hexdigest())
                    text_hash.append(hashlib.sha256(model.decode(ids).encode()).hexdigest())
                yield pa.record_batch([batch.column(0).slice(first, len(texts)), pa.array(counts, pa.int64()), pa.array(ids_hash), pa.array(text_hash)],
                                      names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return slim.mapInArrow(run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
