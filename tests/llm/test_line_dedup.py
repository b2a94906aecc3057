import random
import re
from collections import Counter

from hypothesis import given
from hypothesis import strategies as st

from orderlake.llm import line_dedup
from orderlake.llm.line_dedup import CUT, dedup_lines, within_one


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@given(st.lists(st.sampled_from("abc"), max_size=6), st.lists(st.sampled_from("abc"), max_size=6))
def test_within_one_is_the_edit_distance(a, b):
    assert within_one(a, b) == (distance(a, b) <= 1)


def close(a, b):
    return abs(len(a) - len(b)) <= 1 and sum((Counter(a) - Counter(b)).values()) <= 1 and distance(a, b) <= 1


def words(line):
    return re.findall(r"[^\x20\x09-\x0D]+", line)


def brute(rows, least=5):
    order = {i: 1 << 63 if i is None else i for i, _ in rows}
    worded = sorted((order[i], n, words(x)) for i, t in rows for n, x in enumerate((t or "").split("\n")) if words(x))
    long = [line for line in worded if len(line[2]) >= least]
    out = []
    for i, t in rows:
        if t is None:
            out.append((i, None, 0, 0))
            continue
        kept, dropped = [], 0
        for n, x in enumerate(t.split("\n")):
            w = words(x)
            same = [(d, m) for d, m, v in worded if v == w]
            first = min(same) if same else None
            near = len(w) >= least and any((d, m) < first and close(w, v) for d, m, v in long)
            go = bool(w) and (first[0] < order[i] or first[1] < n or near)
            dropped += go
            kept += [] if go else [x]
        out.append((i, "\n".join(kept), t.count("\n") + 1, dropped))
    return out


def test_equals_brute_force(spark):
    rng = random.Random(8)
    stock = [[rng.choice("abcdefgh") for _ in range(rng.randint(1, 12))] for _ in range(25)]
    rows = [(0, None), (1, ""), (2, "\n\n"), (3, "a a b c d\na c b c d"), (4, "the same five words here\nthe same five words here\n x"), (5, "the  same\tfive words here \r\nend")]
    for i in range(10, 70):
        text = []
        for _ in range(rng.randint(1, 5)):
            line = list(rng.choice(stock))
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                at = rng.randrange(len(line) + 1)
                kind = rng.randrange(3)
                line[at : at + (kind > 0)] = [rng.choice("abcdefgh")] if kind < 2 else []
            text.append(" ".join(line))
        rows.append((i, "\n".join(text)))
    rows.append((None, rows[10][1]))
    rows.append((90, "é ü ñ a b c\n" + "long " * 2000))
    rows.append((91, "é ü ñ a b\n" + "long " * 1999 + "x"))
    docs = spark.createDataFrame([(7, i, t, "q", "z") for i, t in rows], "n_lines long, doc_id long, text string, doc string, number string").repartition(3)
    got = [(r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in dedup_lines(docs).collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_repeated_rows_and_no_rows(spark):
    docs = spark.createDataFrame([(1, "one two three four five"), (1, "one two three four five"), (2, "one two three four six")], "doc_id long, text string")
    assert sorted((r["doc_id"], r["text"]) for r in dedup_lines(docs).collect()) == [(1, "one two three four five")] * 2 + [(2, "")]
    assert dedup_lines(docs.limit(0)).count() == 0


def test_short_lines_go_if_equal(spark):
    rows = [(1, "Les.\nAll rights reserved.\n\na b c d e\na b c d"), (2, " Les. \nall rights reserved.\n\na b c d x\na b c"), (3, "All rights  reserved.\nLes. Les.\nLes.\nLes.\na b c x"), (None, "a b c d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["n_dropped"]) for r in dedup_lines(docs).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("all rights reserved.\n\na b c", 2), 3: ("Les. Les.\na b c x", 3), None: ("", 1)}
    assert {r["doc_id"]: r["n_dropped"] for r in dedup_lines(docs, exact_words=5).collect()} == {1: 0, 2: 1, 3: 0, None: 0}


def test_columns_of_any_name(spark):
    rows = [(1, "one two", "x", 5, None, 8, "body", 1), (2, "one two\nthree", "y", 6, [3], 9, None, 2)]
    docs = spark.createDataFrame(rows, "key long, page string, text string, gone int, `doc of the row` array<int>, `in_0` int, body string, `a.b` int")
    got = dedup_lines(docs, "key", "page")
    assert got.columns == [*docs.columns, "n_lines", "n_dropped"]
    assert sorted(map(tuple, got.collect())) == [(1, "one two", *rows[0][2:], 1, 0), (2, "three", *rows[1][2:], 2, 1)]


def test_rows_without_an_id_keep_lines_of_their_own(spark):
    rows = [(None, "a b\nown line"), (None, "c d\na b"), (1, "c d"), (None, "other line\nc d"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r["doc_id"] or 0, r["text"] or "", r["n_dropped"]) for r in dedup_lines(docs).collect()) == [
        (0, "", 0), (0, "a b", 1), (0, "a b\nown line", 0), (0, "other line", 1), (1, "c d", 0)]


def test_few_neighbours_and_texts_hashed_once(spark, monkeypatch):
    kept, hashed = {}, []
    stored, occurrences = line_dedup.stored, line_dedup._occurrences
    monkeypatch.setattr(line_dedup, "stored", lambda df, name: kept.setdefault(name, stored(df, name)))
    monkeypatch.setattr(line_dedup, "_occurrences", lambda *a: hashed.append(a) or occurrences(*a))
    ten, twelve = [f"a{i}" for i in range(10)], [f"b{i}" for i in range(12)]
    rows = [ten, [*ten[:7], "x", *ten[8:]], twelve, [*twelve[:2], *twelve[3:]], [*ten[:2], "y", "y", *ten[4:7], "y", "y", "y"], [f"c{i}" for i in range(9)]]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id long, text string")
    assert sorted((r["doc_id"], r["n_dropped"]) for r in dedup_lines(docs).collect()) == [(0, 0), (1, 1), (2, 0), (3, 1), (4, 0), (5, 0)]
    # The second half of two lines of ten words, the first of the one of twelve; keys that only one line has are not joined.
    assert kept["near"].where(f"role = {CUT}").count() == 5 + 5 + 5
    assert kept["meet"].count() == 4
    assert len(hashed) == 1


def test_one_word_at_every_place(spark):
    rows = []
    for n in range(5, 11):
        for at in range(n + 1):
            for kind in range(4):
                line = [f"w{len(rows)}x{i}" for i in range(n)]
                edit = [["new"], ["new"], [], line[at - 1 : at]][kind]
                rows += [line, line[:at] + edit + line[at + (kind in (0, 2)) :]]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id long, text string")
    gone = {r["doc_id"] for r in dedup_lines(docs).where("n_dropped = 1").collect()}
    assert gone == {i for i in range(1, len(rows), 2) if len(rows[i]) >= 5 or rows[i] == rows[i - 1]}


def test_lines_repeated_within_texts(spark):
    rows = [(1, "a b\n\na b\nc\na b"), (2, "c\nd\nd\nc\n"), (2, "c\nd\nd\nc\n"), (3, "e\n" * 3000 + "end"), (4, "\n\n"), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in dedup_lines(docs).collect())
    assert got == [(1, "a b\n\nc", 5, 2), (2, "d\n", 5, 3), (2, "d\n", 5, 3), (3, "e\nend", 3001, 2999), (4, "\n\n", 3, 0), (5, None, 0, 0)]
