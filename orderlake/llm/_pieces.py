"""Cut texts where a tokenizer cuts them anyway, so that each distinct piece is encoded once and remembered.

``byte`` pieces suit a byte-level pre-tokenizer that puts one space in front of a word: between a character that isn't white space and
a single space or line feed, and after such a line feed, a pre-token always ends. ``word`` pieces suit one that drops white space.
Encoding the pieces and joining the ids equals encoding the whole text. A text that holds an added token of the tokenizer is one piece.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

GENERATION_BYTES = 80 << 20
ENTRY_BYTES = 200
REMEMBERED_CHARS = 64
JOINED = 128
TEXT_RUN = 4 << 20
Borders = Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]
Encode = Callable[[pa.Array], pa.Array]
_CUTS = re.compile(r"(?<=\S)(?= \S)|(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)")
_RUNS = ("  ", "\n\n", " \n", "\n ")
_OTHER = re.compile("[\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def plain(text: str) -> bool:
    """Whether the only white space is single spaces and line feeds between other characters."""
    return not any(x in text for x in _RUNS) and not _OTHER.search(text)


def byte_borders(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the bytes of plain texts, which ones begin a piece, text starts aside, and which are in none."""
    feed = data == 0x0A
    start = feed | (data == 0x20)
    start[1:] |= feed[:-1]
    return start, np.zeros(len(data), bool)


def word_borders(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for words, which any text can be cut into: other white space stays in its piece."""
    space = (data == 0x20) | (data == 0x0A)
    start = np.zeros(len(data), bool)
    start[1:] = space[:-1]
    return start, space


def after_letter(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether the character before each place is a letter after which a comma or full stop is a pre-token of its own for both kinds: those below
    U+0250 but the dotted capital I, which is lower-cased to a letter and a mark. Letters of further blocks may change under the file's normalizer
    or be unknown to the library."""
    last, lead = data[np.maximum(places - 1, 0)], data[np.maximum(places - 2, 0)]
    ascii_letter = ((last | 0x20) >= 0x61) & ((last | 0x20) <= 0x7A) & (places >= 1)
    pair = (lead.astype(np.int32) << 8) | last
    latin = (lead >= 0xC3) & (lead <= 0xC9) & (last >= 0x80) & (last <= 0xBF) & (pair <= 0xC98F) & ~np.isin(pair, [0xC397, 0xC3B7, 0xC4B0])
    return ascii_letter | ((latin | np.isin(pair, [0xC2AA, 0xC2B5, 0xC2BA])) & (places >= 2))


def pieces_of(texts: list[str], borders: Borders) -> tuple[pa.Array, np.ndarray]:
    """The pieces of plain texts on end, and the place of each text's first one and of the end; a last comma or full stop of a piece is one of its
    own. Words between neighbouring spaces are empty."""
    _, offsets, body = pa.array(texts, pa.large_string()).buffers()
    at = np.frombuffer(offsets, np.int64)[: len(texts) + 1]
    data = np.frombuffer(body, np.uint8)[: at[-1]] if at[-1] else np.zeros(0, np.uint8)
    start, between = borders(data)
    start[at[:-1][at[:-1] < at[1:]]] = True
    marks = np.flatnonzero((data == 0x2C) | (data == 0x2E))
    marks = marks[np.append(start | between, True)[marks + 1]]
    start[marks[after_letter(data, marks)]] = True
    starts = np.flatnonzero(start)
    first, ends = np.searchsorted(starts, at), np.append(starts, len(data))
    if between.any():
        passed = np.zeros(len(data) + 1, np.int32 if len(data) < 1 << 31 else np.int64)
        np.cumsum(between, out=passed[1:])
        ends -= passed[ends]
        data = data[~between]
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(data)), first


def numbered(found: pa.Array, first: int) -> pa.Array:
    """Places, with numbers from ``first`` on where there are none."""
    place, lacking = found.fill_null(0).to_numpy(zero_copy_only=False).copy(), found.is_null().to_numpy(zero_copy_only=False)
    place[lacking] = first + np.arange(lacking.sum())
    return pa.array(place)


class Remembered:
    """Ids of texts as little-endian unsigned 32-bit bytes. Two generations of pieces are kept as Arrow columns: when the newer one holds
    ``GENERATION_BYTES`` it becomes the older one, so memory is bounded and frequent pieces stay. ``encode`` takes pieces of texts with only single
    spaces and line feeds, ``odd`` any others; a text that holds an added token is one piece and isn't remembered."""

    def __init__(self, encode: Encode, borders: Borders, added: list[str], odd: Encode | None = None) -> None:
        self.encode, self.borders, self.added, self.odd = encode, borders, added, odd or encode
        self.new = self.old = pa.array([], pa.large_string())
        self.new_ids = self.old_ids = pa.array([], pa.large_binary())

    def learned(self, pieces: pa.Array, encode: Encode) -> pa.Array:
        """Ids of distinct pieces, looked up or encoded; those that the newer generation lacks are added to it unless they are long."""
        found = pc.index_in(pieces, value_set=self.new)
        lacking = pieces.filter(found.is_null())
        older = pc.index_in(lacking, value_set=self.old)
        coded = pa.concat_arrays([self.old_ids, encode(lacking.filter(older.is_null()))]).take(numbered(older, len(self.old)))
        ids = pa.concat_arrays([self.new_ids, coded]).take(numbered(found, len(self.new)))
        short = pc.less_equal(pc.utf8_length(lacking), REMEMBERED_CHARS)
        self.new, self.new_ids = pa.concat_arrays([self.new, lacking.filter(short)]), pa.concat_arrays([self.new_ids, coded.filter(short)])
        # Characters and ids of an entry, and its share of the tables that are made to look it up.
        if len(self.new) * ENTRY_BYTES > GENERATION_BYTES:
            self.old, self.old_ids = self.new, self.new_ids
            self.new, self.new_ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        return ids

    def ids(self, texts: list[str]) -> list[bytes]:
        found = [b""] * len(texts)
        whole = [i for i, t in enumerate(texts) if any(x in t for x in self.added)]
        odd = {i for i, t in enumerate(texts) if not plain(t)}.difference(whole) if self.borders is byte_borders else set()
        rest = sorted({*range(len(texts))}.difference(whole, odd))
        cut = [_CUTS.split(texts[i]) for i in odd]
        some = [
            (whole, pa.array([texts[i] for i in whole], pa.large_string()), np.arange(len(whole) + 1), None),
            (list(odd), pa.array(list(chain.from_iterable(cut)), pa.large_string()), np.cumsum([0, *map(len, cut)]), self.odd),
            (rest, *pieces_of([texts[i] for i in rest], self.borders), self.encode)]
        for rows, pieces, first, encode in some:
            if not rows:
                continue
            coded = pieces.dictionary_encode()
            ids = self.learned(coded.dictionary, encode) if encode else self.odd(coded.dictionary)
            # Python sees no piece by itself: ids of all occurrences are put on end as Arrow bytes, and cut by text.
            _, offsets, body = ids.take(coded.indices).buffers()
            stops = np.frombuffer(offsets, np.int64)[first].tolist()
            view = memoryview(body or b"")
            for i, a, b in zip(rows, stops, stops[1:]):
                found[i] = bytes(view[a:b])
        return found


def id_bytes(ids: list[bytes]) -> pa.Array:
    return pa.array(ids, pa.large_binary())


def library_encoder(path: str, kind: str) -> Remembered:
    """The tokenizers library at ``path``, in this thread only. Pieces are handed to it joined by a mark that is a token of its own, and the ids
    are cut there: a line feed for ``byte`` files, for ``word`` files, which drop white space, a nought. Pieces with the mark, or of white space, go alone."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    mark, joint = {"byte": ("\n", "\n"), "word": ("0", " 0 ")}[kind]
    mark_ids = tokenizer.encode(mark, add_special_tokens=False).ids

    def coded(texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def single(pieces: pa.Array) -> pa.Array:
        return id_bytes([ids.tobytes() for ids in coded(pieces.to_pylist())])

    def joined(pieces: pa.Array) -> pa.Array:
        alone = pc.or_(pc.match_substring(pieces, mark), pc.is_in(pieces, value_set=pa.array(["", " "], pieces.type))).to_numpy(zero_copy_only=False)
        rows = np.flatnonzero(~alone)
        others = pieces.take(pa.array(rows))
        starts = np.append(np.arange(0, len(rows), JOINED), len(rows))
        groups = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), others.cast(pa.string()))
        ids = coded([x + joint for x in pc.binary_join(groups, joint).to_pylist()])
        sizes = np.diff(starts)
        good = [len(mark_ids) == 1 and int((x == mark_ids[0]).sum()) == n for x, n in zip(ids, sizes.tolist())]
        flat = np.concatenate([np.zeros(0, "<u4"), *(x for x, g in zip(ids, good) if g)])
        stop = np.flatnonzero(flat == mark_ids[0])
        at = 4 * np.concatenate(([0], stop - np.arange(len(stop))))
        body = flat[flat != mark_ids[0]]
        split = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(stop), [None, pa.py_buffer(at), pa.py_buffer(body)])
        ended = np.repeat(np.array(good, bool), sizes)
        rest = np.sort(np.concatenate((np.flatnonzero(alone), rows[~ended])))
        place = np.empty(len(pieces), np.int64)
        place[rows[ended]] = np.arange(len(stop))
        place[rest] = len(stop) + np.arange(len(rest))
        return pa.concat_arrays([split, single(pieces.take(pa.array(rest)))]).take(pa.array(place))
    return Remembered(joined, {"byte": byte_borders, "word": word_borders}[kind], added, single)


def text_runs(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """First row and texts of runs of about ``TEXT_RUN`` characters; null counts as empty."""
    first, run, size = 0, [], 0
    for row, value in enumerate(column):
        text = value.as_py() or ""
        run.append(text)
        size += len(text)
        if size >= TEXT_RUN:
            yield first, run
            first, run, size = row + 1, [], 0
    if run:
        yield first, run
