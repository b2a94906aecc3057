import hashlib
import itertools
import random
import re
import zlib

import pytest

from orderlake.llm import conversation_repair as cr
from orderlake.llm.conversation_repair import Costs, compose, plan_repairs, repair, repair_rows, repaired_turns
from orderlake.llm.queries import QUERIES


def brute(rows, costs=Costs(), inserts=3):
    """All edit sequences with at most so many insertions."""
    best = None
    n = len(rows)
    letters = [("D",) if f in (cr.BLANK, cr.DUPLICATE) else ("D", "K", "R") for _, f in rows]
    for picks in itertools.product(*letters):
        for k in range(inserts + 1):
            for places in itertools.combinations_with_replacement(range(n + 1), k):
                audit = "".join("I" * places.count(i) + (picks[i] if i < n else "") for i in range(n + 1))
                out, cost, at = "", 0, 0
                for letter in audit:
                    expected = "a" if out.endswith("u") else "u"
                    if letter == "I":
                        out, cost = out + expected, cost + costs.insert
                        continue
                    initial, fault = rows[at]
                    at += 1
                    if letter == "D":
                        cost += costs.delete
                    else:
                        out += initial if letter == "K" else expected
                        cost += (costs.keep if letter == "K" else costs.rerole) + (costs.truncated if fault == cr.TRUNCATED else 0)
                if re.fullmatch("(s?(ua)+)?", out) and (best is None or (cost, audit) < best):
                    best = (cost, audit)
    return best


@pytest.mark.parametrize("costs", [Costs(), Costs(insert=1), Costs(0, 3, 4, 1, 2), Costs(1, 1, 1, 1, 0)])
def test_search_finds_the_cheapest_repair_with_the_least_audit(costs):
    rng = random.Random(7)
    for _ in range(60):
        rows = [(rng.choice("suaat"), rng.choice([0, 0, 0, 1, 2, 3])) for _ in range(rng.randint(0, 4))]
        assert repair_rows(rows, costs=costs) == brute(rows, costs, 3 if len(rows) < 4 else 2), rows


def test_segments_compose_to_the_search_of_the_whole():
    rng = random.Random(8)
    for costs in (Costs(), Costs(insert=1), Costs(0, 2, 3, 1, 1)):
        for _ in range(60):
            rows = [(rng.choice("suat"), rng.choice([0, 0, 0, 0, 1, 2, 3])) for _ in range(rng.randint(1, 30))]
            cuts = sorted({0, len(rows), *(rng.randrange(len(rows) + 1) for _ in range(4))})
            parts = [rows[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
            ways = [{(f, t): w for f in range(4) for t in range(4) if (w := repair_rows(p, f, (t,), costs))} for p in parts]
            cost, pieces = compose(ways, [len(p) for p in parts])
            assert (cost, "".join(pieces)) == repair_rows(rows, costs=costs)
            assert [sum(c != "I" for c in piece) for piece in pieces] == [len(p) for p in parts]


def plain(rows):
    """The contract in plain Python for damaged rows ``(turn, role, text)`` of one conversation in order."""
    if not rows:
        return 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()
    seen, marked = set(), []
    for _, role, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = cr.BLANK if not words else cr.DUPLICATE if (role, text) in seen else cr.TRUNCATED if words[-1] not in ".!?" else cr.SOUND
        seen.add((role, text))
        marked.append((role[:1], fault))
    turns = [t for t, _, _ in rows if t is not None]
    cost, audit = dynamic(marked)
    out, at = [], 0
    for letter in audit:
        expected = "assistant" if out and out[-1][0][:1] == "u" else "user"
        if letter == "I":
            out.append((expected, ""))
        else:
            _, role, text = rows[at]
            at += 1
            if letter != "D":
                out.append((role if letter == "K" else expected, text))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(sum(f == k for _, f in marked) for k in (1, 2, 3)),
            sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:])), cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


def dynamic(rows):
    """Least (cost, audit) by the best suffix of each state."""
    after = {cr.START: (0, ""), cr.PAIR: (0, ""), cr.USER: (5, "I"), cr.SYSTEM: (10, "II")}
    for initial, fault in reversed(rows):
        here = {}
        for s in range(4):
            options = [(2 + after[s][0], "D" + after[s][1])]
            if fault not in (1, 2):
                more = 5 if fault == 3 else 0
                t = cr.FILLED[s]
                options.append((1 + more + after[t][0], "R" + after[t][1]))
                if (s, initial) in cr.KEPT:
                    t = cr.KEPT[s, initial]
                    options.append((more + after[t][0], "K" + after[t][1]))
            here[s] = min(options)
        for _ in range(3):
            here = {s: min(here[s], (5 + here[cr.FILLED[s]][0], "I" + here[cr.FILLED[s]][1])) for s in range(4)}
        after = here
    return after[cr.START]


def got(df, key="conv"):
    return {r[key]: tuple(r[c] for c in (*cr.COUNTS, "audit", "repaired_sha256")) for r in df.collect()}


def conversations(rng, n, longest):
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            text = rng.choice(["Yes.", "No", "", " \t", "What is it?", "Well, see!", "an open end", "Fine. "])
            rows.append((conv, turn + (turn > 5), rng.choice(["user", "assistant", "assistant", "system", "tool", ""]), text))
    return rows


@pytest.mark.parametrize("segment", [3, 256])
def test_repair_equals_the_plain_form(spark, monkeypatch, segment):
    monkeypatch.setattr(cr, "SEGMENT", segment)
    rows = conversations(random.Random(segment), 40, 25)
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv long, turn long, role string, text string, mark string, segment int").repartition(5)
    want = {c: plain([r[1:] for r in rows if r[0] == c]) for c in range(40)}
    assert got(repair(frame)) == want


def test_a_conversation_with_most_rows_is_cut_into_segments(spark):
    rng = random.Random(5)
    rows = [(1, t, "user" if rng.random() < 0.5 else "assistant", f"text {t}." if rng.random() < 0.9 else "same") for t in range(3000)] + conversations(rng, 20, 4)[:30]
    rows = [(c if c != 1 or len(t) > 5 else 99, n, r, t) for c, n, r, t in rows]
    frame = spark.createDataFrame(rows, "conv long, turn long, role string, text string").repartition(6)
    assert plan_repairs(frame).where("conv = 1").count() > 10
    for conv in (1, 99):
        own = sorted(r[1:] for r in rows if r[0] == conv)
        if conv == 1:
            assert got(repair(frame))[conv] == plain(own)
    turns = repaired_turns(frame, plan_repairs(frame)).where("conv = 1").orderBy("place").collect()
    assert [r["place"] for r in turns] == list(range(len(turns)))
    assert re.fullmatch("s?(ua)+", "".join(r["role"][0] for r in turns))


def test_nulls_repeats_and_empty_tables(spark):
    rows = [(None, None, "user", "Hi."), (None, None, "user", "Hi."), (None, 3, None, None), (7, None, "user", "A."), (7, 2, "assistant", "B."), (7, 2, "assistant", "B."), (8, 1, "user", "é" * 100_000 + ".")]
    frame = spark.createDataFrame(rows, "conv long, turn long, role string, text string")
    found = got(repair(frame))
    assert found[None] == plain([(None, "user", "Hi."), (None, "user", "Hi."), (3, " ", " ")])
    assert found[7] == plain([r[1:] for r in rows if r[0] == 7]) and found[8][6] == "D"
    assert repair(frame.where("turn > 9")).count() == 0


def test_query_on_the_whole_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    damaged = {c: [] for c, *_ in rows}
    for conv, turn, role, text in sorted(rows):
        fault = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        damaged[conv] += [(turn, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
    assert got(QUERIES["op12_conversation_repair"](spark, sf), "conv_id") == {c: plain(r) for c, r in damaged.items()}
