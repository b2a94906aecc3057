"""Cheapest repair of a conversation's structure by depth-first branch-and-bound.

A repair keeps, re-roles, deletes or inserts turns until the role initials read ``(s?(ua)+)?``. A node of the search is a row and a state of
that pattern. The search has an explicit stack; suffix bounds say what the remaining rows cost at least from a state; a table per node
drops prefixes that a cheaper one, or an equally cheap one with an earlier audit, has reached; a branch that can't beat the incumbent
(cost, audit) goes. An empty stack proves the incumbent.

Rows are numbered in a global order and cut into segments of at most ``SEGMENT`` rows. A segment that holds a whole conversation is
searched once; the others are searched from each state to each state, and their results are composed in a second search. So a conversation with
a large share of all rows is spread over its segments, and texts are read once, in order, to apply the edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import Any, NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm._runtime import stored, tuned

SEGMENT = 256
WORD = r"[^\x20\x09-\x0D]"
START, SYSTEM, USER, PAIR = range(4)
ACCEPTED = (START, PAIR)
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): PAIR, (PAIR, "u"): USER}
FILLED = {START: USER, SYSTEM: USER, USER: PAIR, PAIR: USER}
LEGAL = ("su", "ua", "au")
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
NEVER = 1 << 60


class Costs(NamedTuple):
    """``truncated`` is added to a truncated row that isn't deleted. All are at least 0, and ``insert`` is more."""

    keep: int = 0
    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


def edits(row: tuple[str, int] | None, state: int, costs: Costs) -> list[tuple[str, int, int, int]]:
    """``letter, cost, next state, rows taken`` of each edit that a state allows before ``row`` (an initial and a fault) or at the end."""
    out = [("I", costs.insert, FILLED[state], 0)]
    if row is not None:
        initial, fault = row
        out.append(("D", costs.delete, state, 1))
        if fault not in (BLANK, DUPLICATE):
            more = costs.truncated if fault == TRUNCATED else 0
            out.append(("R", costs.rerole + more, FILLED[state], 1))
            if (state, initial) in KEPT:
                out.append(("K", costs.keep + more, KEPT[state, initial], 1))
    return out


def suffix_bounds(rows: list[tuple[str, int]], exits: Iterable[int], costs: Costs) -> list[list[int]]:
    """What is still to be paid, at least, from each row and state to one of ``exits``."""
    ends = set(exits)
    bounds = [[0 if s in ends else NEVER for s in range(4)]]
    for row in [None, *reversed(rows)]:
        after = bounds[-1]
        here = list(after) if row is None else [min(cost + after[state] for _, cost, state, taken in edits(row, s, costs) if taken) for s in range(4)]
        for _ in range(3):
            here = [min(here[s], costs.insert + here[FILLED[s]]) for s in range(4)]
        if row is None:
            bounds = [here]
        else:
            bounds.append(here)
    return bounds[::-1]


def branch_and_bound(steps: int, expand: Any, bounds: list[list[int]], entry: int, exits: Iterable[int]) -> tuple[int, str] | None:
    """Least (cost, audit) from ``entry`` before step 0 to one of ``exits`` after the last; None if there is no way.

    ``expand(step, state)`` gives ``text, cost, next state, steps taken``. An audit that another one of equal cost extends can't reach the
    same node, because every further letter without a step costs something; so a table entry may drop all that come after it.
    """
    ends = set(exits)
    best: tuple[int, str] | None = None
    table: list[list[tuple[int, str] | None]] = [[None] * 4 for _ in range(steps + 1)]
    stack = [(0, entry, 0, "")]
    while stack:
        step, state, cost, audit = stack.pop()
        known = table[step][state]
        if cost + bounds[step][state] >= NEVER or (best is not None and (cost + bounds[step][state], audit) >= best) or (known is not None and known <= (cost, audit)):
            continue
        table[step][state] = (cost, audit)
        if step == steps and state in ends:
            best = (cost, audit)
        children = []
        for text, price, after, taken in expand(step, state):
            least = cost + price + bounds[step + taken][after]
            if least < NEVER and (best is None or least <= best[0]):
                children.append((least, text, step + taken, after, cost + price))
        children.sort(reverse=True)
        stack.extend((at, after, paid, audit + text) for _, text, at, after, paid in children)
    return best


def repair_rows(rows: list[tuple[str, int]], entry: int = START, exits: Iterable[int] = ACCEPTED, costs: Costs = Costs()) -> tuple[int, str] | None:
    """Cost and audit of the cheapest repair of ``rows`` (initial, fault), ties ASCII-least."""
    n = len(rows)
    return branch_and_bound(n, lambda i, s: edits(rows[i] if i < n else None, s, costs), suffix_bounds(rows, exits, costs), entry, exits)


def compose(ways: list[dict[tuple[int, int], tuple[int, str]]], sizes: list[int]) -> tuple[int, list[str]]:
    """Cost and each segment's edits of the cheapest way through all segments. ``ways`` has the least (cost, audit) of a segment by the states
    before and after it, ``sizes`` its rows. Where an insertion stands on a border, it goes to the later segment."""
    bounds = [[0 if s in ACCEPTED else NEVER for s in range(4)]]
    for way in reversed(ways):
        after = bounds[-1]
        bounds.append([min([cost + after[t] for (f, t), (cost, _) in way.items() if f == s], default=NEVER) for s in range(4)])
    bounds.reverse()

    def expand(i: int, s: int) -> list[tuple[str, int, int, int]]:
        return [(audit, cost, t, 1) for (f, t), (cost, audit) in ways[i].items() if f == s] if i < len(ways) else []
    cost, audit = branch_and_bound(len(ways), expand, bounds, START, ACCEPTED)
    pieces, at = [], 0
    for size in sizes[:-1]:
        stop = at
        while size:
            size -= audit[stop] != "I"
            stop += 1
        pieces.append(audit[at:stop])
        at = stop
    return cost, [*pieces, audit[at:]]


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with faults set in by crc32 of ``conv:turn`` modulo 20; null roles and texts are one space, also within the hashed string."""
    def spaced(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(spaced(conv), F.lit(":"), spaced(turn))) % 20
    faulty = rows.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), spaced(role).alias("role"), spaced(text).alias("text"), fault.alias("fault")).where("fault <> 0")
    return faulty.select(
        "conv", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


def _marked(rows: DataFrame) -> DataFrame:
    """``mark`` is a digest of conversation, role and text, which orders rows of one turn and role, and tells equal rows."""
    spelt = F.concat_ws("\x1f", F.coalesce(F.col("conv").cast("string"), F.lit("\x1e")), F.length("role").cast("string"), "role", "text")
    return rows.withColumn("mark", F.substring(F.unhex(F.sha2(spelt, 256)), 1, 16))


NUMBERED = "turn long, mark binary, initial string, blank boolean, truncated boolean, conv {conv}, role string, pos long, segment long, head boolean, tail boolean"


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Positions in the global order, and segments: a new one at each conversation and after ``SEGMENT`` rows. ``head`` and ``tail`` say that the
    conversation begins and ends in the segment, as far as this partition shows."""
    part, count, first = TaskContext.get().partitionId(), 0, True
    schema = run = None
    runs: list[tuple[list[dict], bool, bool]] = []

    def emit() -> Iterator[pa.RecordBatch]:
        nonlocal count
        columns: dict[str, list] = {n: [] for n in [*schema.names, "pos", "segment", "head", "tail"]}
        for rows, head, tail in runs:
            start = (part << 40) + count
            for i, row in enumerate(rows):
                for n, v in row.items():
                    columns[n].append(v)
                columns["pos"].append(start + i)
                columns["segment"].append(start)
                columns["head"].append(head)
                columns["tail"].append(tail)
            count += len(rows)
        runs.clear()
        types = [*schema.types, pa.int64(), pa.int64(), pa.bool_(), pa.bool_()]
        yield pa.record_batch([pa.array(v, t) for v, t in zip(columns.values(), types)], names=list(columns))
    rows: list[dict] = []
    head = False
    for batch in batches:
        schema = batch.schema
        for row in batch.to_pylist():
            if rows and row["conv"] != run:
                runs.append((rows, head, True))
                rows, head = [], True
            elif len(rows) == SEGMENT:
                runs.append((rows, head, False))
                rows, head = [], False
            run = row["conv"]
            rows.append(row)
        if len(runs) > 256:
            yield from emit()
    if rows:
        runs.append((rows, head, False))
    if runs:
        yield from emit()


WAYS = "array<struct<before: int, after: int, cost: long, audit: string>>"
SEGMENTS = ("conv {conv}, pos long, turn long, role string, mark binary, size long, low long, high long, turns long, last_turn long, first_initial string, last_initial string, "
            f"blank long, duplicate long, truncated long, illegal long, whole boolean, ways {WAYS}")


def _segments(costs: Costs, names: list[str], types: list[pa.DataType]):
    def solved(rows: list[dict]) -> dict:
        faults = [BLANK if r["blank"] else DUPLICATE if r["again"] else TRUNCATED if r["truncated"] else SOUND for r in rows]
        pairs = [(r["initial"], f) for r, f in zip(rows, faults)]
        first, last = rows[0], rows[-1]
        whole = first["head"] and first["tail"]
        ways = []
        for before in (START,) if first["head"] else range(4):
            for exits in (ACCEPTED,) if whole else ((s,) for s in (ACCEPTED if first["tail"] else range(4))):
                way = repair_rows(pairs, before, exits, costs)
                if way is not None:
                    ways.append({"before": before, "after": exits[-1], "cost": way[0], "audit": way[1]})
        turns = [r["turn"] for r in rows if r["turn"] is not None]
        return {
            "conv": first["conv"], "pos": first["pos"], "turn": first["turn"], "role": first["role"], "mark": first["mark"], "size": len(rows), "low": turns[0] if turns else None,
            "high": turns[-1] if turns else None, "turns": len(set(turns)), "last_turn": last["turn"], "first_initial": first["initial"], "last_initial": last["initial"],
            "blank": faults.count(BLANK), "duplicate": faults.count(DUPLICATE), "truncated": faults.count(TRUNCATED),
            "illegal": sum(a["initial"] + b["initial"] not in LEGAL for a, b in zip(rows, rows[1:])), "whole": whole, "ways": ways}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        done: list[dict] = []

        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array([d[n] for d in done], t) for n, t in zip(names, types)], names=names)
        for batch in batches:
            for row in batch.to_pylist():
                if rows and row["segment"] != rows[0]["segment"]:
                    done.append(solved(rows))
                    rows = []
                rows.append(row)
            if len(done) >= 500:
                yield out()
                done = []
        if rows:
            done.append(solved(rows))
        if done:
            yield out()
    return run


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
CHOSEN = "conv {conv}, turn long, role string, mark binary, pos long, edits string, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string"


def _composed(conv_type: pa.DataType):
    """Segments sorted by conversation and position to the edits of each; the last one of a conversation carries its counts and whole audit."""
    types = [conv_type, pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), *[pa.int64()] * len(COUNTS), pa.string()]
    names = ["conv", "turn", "role", "mark", "pos", "edits", *COUNTS, "audit"]

    def chosen(segments: list[dict]) -> list[tuple]:
        if segments[0]["whole"]:
            way = segments[0]["ways"][0]
            cost, path = way["cost"], [way["audit"]]
        else:
            cost, path = compose([{(w["before"], w["after"]): (w["cost"], w["audit"]) for w in s["ways"]} for s in segments], [s["size"] for s in segments])
        borders = list(zip(segments, segments[1:]))
        lows, highs = [s["low"] for s in segments if s["low"] is not None], [s["high"] for s in segments if s["high"] is not None]
        turns = sum(s["turns"] for s in segments) - sum(a["last_turn"] is not None and a["last_turn"] == b["turn"] for a, b in borders)
        illegal = sum(s["illegal"] for s in segments) + sum(a["last_initial"] + b["first_initial"] not in LEGAL for a, b in borders)
        totals = (max(highs) - min(lows) + 1 - turns if lows else 0, *(sum(s[c] for s in segments) for c in ("blank", "duplicate", "truncated")), illegal, cost)
        out = [(s["conv"], s["turn"], s["role"], s["mark"], s["pos"], p, *[None] * (len(COUNTS) + 1)) for s, p in zip(segments, path)]
        out[-1] = (*out[-1][:6], *totals, "".join(path))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments: list[dict] = []
        done: list[tuple] = []
        for batch in batches:
            for s in batch.to_pylist():
                if segments and s["conv"] != segments[0]["conv"]:
                    done += chosen(segments)
                    segments = []
                segments.append(s)
            if done:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)
                done = []
        if segments:
            done = chosen(segments)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)
    return run


def plan_repairs(rows: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """``conv, turn, role, mark, pos, edits`` of each segment of ``rows(conv, turn, role, text)``, and in a conversation's last one
    its counts (``COUNTS``) and whole ``audit``; written to the shared folder."""
    spark = tuned(rows.sparkSession)
    conv = dict(rows.dtypes)["conv"]
    marked = _marked(_whole(rows))
    slim = marked.select("turn", "mark", F.substring("role", 1, 1).alias("initial"), (~F.col("text").rlike(WORD)).alias("blank"),
                         (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"), "conv", "role", F.monotonically_increasing_id().alias("any"))
    ordered = slim.repartitionByRange("conv", "turn", "role", "mark", "any").sortWithinPartitions("conv", "turn", "role", "mark").drop("any")
    turns = stored(ordered.mapInArrow(_numbered, NUMBERED.format(conv=conv)), "turns")
    several = turns.groupBy("mark").agg(F.min("pos").alias("earliest"), F.count("*").alias("n")).where("n > 1").select("mark", "earliest")
    flagged = turns.join(several, "mark", "left").withColumn("again", F.coalesce(F.col("pos") > F.col("earliest"), F.lit(False))).drop("earliest")
    schema = spark.createDataFrame([], SEGMENTS.format(conv=conv)).toArrow().schema
    solved = flagged.repartition("segment").sortWithinPartitions("segment", "pos").mapInArrow(_segments(costs, schema.names, schema.types), SEGMENTS.format(conv=conv))
    composed = solved.repartition("conv").sortWithinPartitions("conv", "pos").mapInArrow(_composed(schema.types[0]), CHOSEN.format(conv=conv))
    return stored(composed, "repairs")


def _whole(rows: DataFrame) -> DataFrame:
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    return rows.select("conv", F.col("turn").cast("long").alias("turn"), *spaced)


def _applied(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Any, list[tuple[str, str]]]]:
    """Repaired rows as ``conversation, [(role, text)]``, in order and in parts; edits come before the rows that they concern."""
    at: Any = None
    begun, letters, state = False, "", START

    def filled(letters: str, state: int, out: list) -> tuple[str, int]:
        while letters[:1] == "I":
            out.append(("assistant" if state == USER else "user", ""))
            letters, state = letters[1:], FILLED[state]
        return letters, state
    for batch in batches:
        for row in batch.to_pylist():
            out: list[tuple[str, str]] = []
            if not begun or row["conv"] != at:
                if begun:
                    last: list[tuple[str, str]] = []
                    filled(letters, state, last)
                    yield at, last
                at, begun, letters, state = row["conv"], True, "", START
            if row["edits"] is not None:
                letters += row["edits"]
                continue
            letters, state = filled(letters, state, out)
            edit, letters = letters[0], letters[1:]
            if edit == "K":
                out.append((row["role"], row["text"]))
                state = KEPT[state, row["role"][:1]]
            elif edit == "R":
                out.append(("assistant" if state == USER else "user", row["text"]))
                state = FILLED[state]
            if out:
                yield at, out
    if begun:
        last = []
        filled(letters, state, last)
        yield at, last


def _in_order(rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """Rows of a conversation and, before the first row of each segment, its edits; texts are shuffled once."""
    texts = _marked(_whole(rows)).select("conv", "turn", "role", "mark", F.lit(1).alias("kind"), F.lit(0).cast("long").alias("pos"), "text", F.lit(None).cast("string").alias("edits"))
    letters = repairs.select("conv", "turn", "role", "mark", F.lit(0).alias("kind"), "pos", F.lit(None).cast("string").alias("text"), "edits")
    return texts.unionByName(letters).repartition("conv").sortWithinPartitions("conv", "turn", "role", "mark", "kind", "pos").select("conv", "role", "text", "edits")


def repaired_turns(rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv, place, role, text``, places from 0 without gaps."""
    conv = dict(rows.dtypes)["conv"]
    conv_type = rows.sparkSession.createDataFrame([], f"conv {conv}").toArrow().schema.types[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, place, begun = None, 0, False
        for conv, parts in _applied(batches):
            if not begun or conv != at:
                at, place, begun = conv, 0, True
            if parts:
                yield pa.record_batch([pa.array([conv] * len(parts), conv_type), pa.array(range(place, place + len(parts)), pa.int64()),
                                       pa.array([r for r, _ in parts], pa.string()), pa.array([t for _, t in parts], pa.string())], names=["conv", "place", "role", "text"])
                place += len(parts)
    return _in_order(rows, repairs).mapInArrow(run, f"conv {conv}, place long, role string, text string")


def repaired_digests(rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """``conv, repaired_sha256``: of ``role:text`` of the repaired rows, joined by line feeds."""
    conv = dict(rows.dtypes)["conv"]
    conv_type = rows.sparkSession.createDataFrame([], f"conv {conv}").toArrow().schema.types[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest, empty, done = None, None, True, []

        def out() -> pa.RecordBatch:
            return pa.record_batch([pa.array([c for c, _ in done], conv_type), pa.array([d for _, d in done], pa.string())], names=["conv", "repaired_sha256"])
        for conv, parts in _applied(batches):
            if digest is None or conv != at:
                if digest is not None:
                    done.append((at, digest.hexdigest()))
                at, digest, empty = conv, hashlib.sha256(), True
            for role, text in parts:
                digest.update((("" if empty else "\n") + role + ":" + text).encode())
                empty = False
            if len(done) >= 1000:
                yield out()
                done = []
        if digest is not None:
            done.append((at, digest.hexdigest()))
            yield out()
    return _in_order(rows, repairs).mapInArrow(run, f"conv {conv}, repaired_sha256 string")


def repair(rows: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """``conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of each conversation of ``rows(conv, turn, role, text)``.

    Rows are taken by turn, nulls first, and rows of one turn by role and then by a digest of role and text. Null roles and texts are one space; an
    empty text is blank; texts are read whole. Equal rows are rows of their own, all but the first duplicates. Rows without a conversation are one.
    An empty table gives no rows. Further columns don't matter. The audit has a letter for each edit, so one value per row at most grows with a
    conversation in a task; its texts are streamed.
    """
    repairs = plan_repairs(rows, costs)
    whole = repairs.where("audit is not null").select("conv", *COUNTS, "audit")
    return whole.join(repaired_digests(rows, repairs).withColumnRenamed("conv", "same"), F.col("conv").eqNullSafe(F.col("same"))).drop("same")
