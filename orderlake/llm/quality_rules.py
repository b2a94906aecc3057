"""Quality rules as a ledger: every rule is evaluated once per document, failures are bits beside the measurements.

A policy is a versioned set of rules, that is a mask: a document passes if no bit of the mask is set. What a policy would keep, what a rule
rejects alone and what leaving it out would bring back follow from the stored bits by bitwise aggregation; no text is read again.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm._runtime import free_worker_state, tuned
from orderlake.llm._text import Powers, chunks, mix, runs, words

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters"]
SYMBOLS = b"#*$%&|<>"
WINDOW = 8


class Rule(NamedTuple):
    """A document fails if ``fails``, SQL over the measurements, is true. The place in RULES is the bit and never changes."""

    name: str
    fails: str


RULES = [
    Rule("few_words", "n_words < 20"),
    Rule("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "100 * n_symbols > 10 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule("capitals", "100 * n_upper > 40 * n_letters"),
    Rule("short_words", "10 * word_chars < 25 * n_words"),
    Rule("long_words", "word_chars > 12 * n_words"),
]
POLICIES = {
    "base-1": ["few_words", "repeated_words"],
    "strict-1": [r.name for r in RULES],
}
CURRENT = "strict-1"


def mask(policy: str) -> int:
    names = [r.name for r in RULES]
    return sum(1 << names.index(n) for n in POLICIES[policy])


def _count(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """True flags in each slice of ``at``."""
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[at[1:]] - total[at[:-1]]


def _repeats(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Per text, words covered by a window of words that occurs twice or more in it."""
    sizes = np.diff(at)
    row = np.repeat(np.arange(len(sizes)), sizes)
    window = runs(hashes, WINDOW)
    inside = row[: len(window)] == row[WINDOW - 1 :] if len(window) else np.zeros(0, bool)
    first = np.flatnonzero(inside)
    if not len(first):
        return np.zeros(len(sizes), np.int64)
    key = mix(window[first] + row[first].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(first), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    begins = np.zeros(len(hashes) + WINDOW, np.int64)
    hit = first[twice]
    begins[hit] += 1
    np.subtract.at(begins, hit + WINDOW, 1)
    return _count(np.cumsum(begins)[: len(hashes)] > 0, at)


def _lines(data: np.ndarray, text_at: np.ndarray, word_start: np.ndarray, powers: Powers, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text, lines with a word, and those equal to an earlier line of it."""
    ends = np.union1d(np.flatnonzero(data == 10), text_at[1:])
    begins = np.union1d(np.flatnonzero(data == 10) + 1, text_at[:-1])
    begins = begins[begins < len(data)]
    line_of_word = np.unique(np.searchsorted(begins, word_start, "right") - 1)
    begins = begins[line_of_word]
    stops = ends[np.searchsorted(ends, begins, "right")]
    row = np.searchsorted(text_at, begins, "right") - 1
    up, down = powers.upto(len(data) + 1)
    terms = np.concatenate((np.zeros(1, np.uint64), np.cumsum(table[data] * up[: len(data)], dtype=np.uint64)))
    key = mix((terms[stops] - terms[begins]) * down[begins] + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(key, return_index=True)
    again = np.ones(len(key), bool)
    again[first] = False
    rows = len(text_at) - 1
    return np.bincount(row, minlength=rows), np.bincount(row[again], minlength=rows)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last column is the text; the others are handed on."""
    free_worker_state()
    powers = Powers()
    is_symbol = np.zeros(256, bool)
    is_symbol[list(SYMBOLS)] = True
    line_table = np.random.default_rng(3).integers(1, 1 << 63, 256, dtype=np.uint64)
    for batch in batches:
        for chunk in chunks(batch.column(batch.num_columns - 1)):
            w = words(chunk, powers)
            data, rows = chunk.data, len(chunk.at) - 1
            n_words = np.diff(w.at)
            lead = (data & 0xC0) != 0x80
            heads = np.concatenate(([0], np.cumsum(lead, dtype=np.int64)))
            per_word = np.concatenate(([0], np.cumsum(heads[w.end] - heads[w.start])))
            upper = (data >= 0x41) & (data <= 0x5A)
            low = (data >= 0x61) & (data <= 0x7A)
            # Latin letters of two bytes: 0xC3 and then 0x80-0x9E for capitals, 0x9F-0xBF for small letters; the cross and the division sign aren't.
            after = np.concatenate(([False], data[:-1] == 0xC3)) if len(data) else np.zeros(0, bool)
            letter2 = after & (data != 0x97) & (data != 0xB7)
            upper |= letter2 & (data < 0x9F)
            low |= letter2 & (data >= 0x9F)
            lines, dup = (_lines(data, chunk.at, w.start, powers, line_table) if len(w.start) else (np.zeros(rows, np.int64),) * 2)
            values = {
                "n_words": n_words, "word_chars": per_word[w.at[1:]] - per_word[w.at[:-1]], "n_symbols": _count(is_symbol[data], chunk.at),
                "n_dup_lines": dup, "n_repeat_words": _repeats(w.hash, w.at), "n_lines": lines, "n_upper": _count(upper, chunk.at),
                "n_letters": _count(upper | low, chunk.at)}
            kept = [batch.column(i).slice(chunk.first, rows) for i in range(batch.num_columns - 1)]
            yield pa.record_batch([*kept, *(pa.array(values[m].astype(np.int64)) for m in MEASURES)], names=[*batch.schema.names[:-1], *MEASURES])


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """The ledger: ``id``, the measurements and ``failed_rules`` (bits by place in RULES), a row for each row of ``docs``. With ``keep`` the columns of
    ``docs`` come with it; measurements replace columns of their names.

    Null texts count as empty: no words, all measurements 0. Repeated rows, null ids and other columns don't matter; an empty table gives
    no rows.
    """
    tuned(docs.sparkSession)
    others = [c for c in docs.columns if c not in ("id", "failed_rules", *MEASURES)] if keep else []
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), *(F.col(f"`{c}`") for c in others), F.col(f"`{text_col}`").cast("string").alias("measured text"))
    fields = ", ".join(f"`{c}` {t}" for c, t in slim.dtypes[:-1])
    measured = slim.mapInArrow(_measure, f"{fields}, " + ", ".join(f"{m} long" for m in MEASURES))
    bits = sum((F.when(F.expr(r.fails), 1 << i).otherwise(0) for i, r in enumerate(RULES)), F.lit(0))
    return measured.withColumn("failed_rules", bits.cast("int"))


def passes(policy: str = CURRENT, failed: str = "failed_rules") -> Column:
    """Whether a ledger row is kept under a policy."""
    return F.col(failed).bitwiseAND(mask(policy)) == 0


def ablation(ledger: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of the policy: ``failing`` documents, ``only_this`` that no other rule of it rejects (leaving the rule out brings these back)."""
    m = mask(policy)
    patterns = ledger.groupBy(F.col("failed_rules").bitwiseAND(m).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << i).alias("bit")) for i, r in enumerate(RULES) if m >> i & 1]))
    each = patterns.select("bits", "n", rules.alias("r")).select("bits", "n", "r.rule", "r.bit")
    return each.groupBy("rule").agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("failing"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("only_this"))
