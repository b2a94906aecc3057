"""Words, lines and hashes of a whole Arrow batch of texts at once, on its byte buffer.

A word is a run of bytes other than 0x20 and 0x09-0x0D; no byte of a multi-byte UTF-8 character is one of these, so this equals
splitting code points. Hashes are 64-bit: a polynomial over the bytes of a word, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
_RANDOM = np.random.default_rng(20240607)
BYTES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTES[SPACES] = 0
STEPS = _RANDOM.integers(1, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15


def mix(h: np.ndarray) -> np.ndarray:
    """Finalize 64-bit values in place so that every bit depends on all bits."""
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Powers:
    """Powers of the base and of its inverse modulo 2**64, long enough for the longest chunk seen."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(0, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * CHUNK)
            self.up, self.down = _powers(BASE, n), _powers(pow(BASE, -1, 1 << 64), n)
        return self.up, self.down


class Chunk(NamedTuple):
    """Some neighbouring rows of a batch: ``first`` is the row of its first text, ``at`` the byte offsets of its texts in ``data``."""

    first: int
    data: np.ndarray
    at: np.ndarray


class Words(NamedTuple):
    """``start`` and ``end`` are byte offsets of each word, ``at`` the offset of each text's first word, ``hash`` the word hashes."""

    start: np.ndarray
    end: np.ndarray
    at: np.ndarray
    hash: np.ndarray


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a column on end, and offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string())
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return body, at - at[0]


def chunks(column: pa.Array, size: int = CHUNK) -> Iterator[Chunk]:
    """Whole texts in runs of about ``size`` bytes; one longer text makes a run of its own."""
    data, at = raw(column)
    row, rows = 0, len(at) - 1
    while row < rows:
        stop = max(row + 1, int(np.searchsorted(at, at[row] + size, "right")) - 1)
        yield Chunk(row, data[at[row] : at[stop]], at[row : stop + 1] - at[row])
        row = stop


def words(chunk: Chunk, powers: Powers, lower: bool = False, apart: np.ndarray = SPACES) -> Words:
    """``apart`` marks the bytes between words."""
    data = LOWER[chunk.data] if lower else chunk.data
    n = len(data)
    if not n:
        return Words(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(chunk.at), np.int64), np.zeros(0, np.uint64))
    space = np.empty(n + 1, bool)
    np.take(apart, data, out=space[:n])
    space[n] = True
    border = np.zeros(n + 1, bool)
    border[chunk.at] = True
    start = np.flatnonzero(~space[:-1] & np.concatenate(([True], space[:-2] | border[1:-1])))
    end = np.flatnonzero(~space[:-1] & (space[1:] | border[1:])) + 1
    up, down = powers.upto(n)
    hashes = np.zeros(0, np.uint64)
    if len(start):
        terms = BYTES[data]
        terms *= up[:n]
        if apart is not SPACES:
            terms[space[:n]] = 0
        hashes = np.add.reduceat(terms, start)
        hashes *= down[start]
        mix(hashes)
    return Words(start, end, np.searchsorted(start, chunk.at), hashes)


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each ``n`` neighbouring words, by the first of them."""
    count = max(0, len(hashes) - n + 1)
    out = np.zeros(count, np.uint64)
    for j in range(n):
        out += hashes[j : j + count] * STEPS[j]
    return mix(out)


def shingles(w: Words, n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``n``-word shingles of each text; with fewer words the whole sequence is one, without words none."""
    every = runs(w.hash, n)
    out = []
    for a, b in zip(w.at[:-1].tolist(), w.at[1:].tolist()):
        if b - a >= n:
            own = every[a : b - n + 1]
            own = np.sort(own)
            out.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif b > a:
            short = np.concatenate((w.hash[a:b] * STEPS[: b - a], np.array([b - a], np.uint64) * STEPS[n]))
            out.append(mix(short.sum(dtype=np.uint64, keepdims=True)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def binaries(parts: list[np.ndarray]) -> pa.Array:
    """Arrays as one Arrow column of bytes."""
    at = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([p.nbytes for p in parts], out=at[1:])
    body = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(parts), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(body))]).cast(pa.binary())
