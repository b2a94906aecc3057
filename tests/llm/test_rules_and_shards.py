import zlib

from pyspark.sql import functions as F

from orderlake.llm.quality_rules import POLICIES, RULES, ablation, mask, measure, passes
from orderlake.llm.queries import QUERIES
from orderlake.llm.sharding import read_shards, write_shuffled

TEXTS = [None, "", " \n\t ", "one", "a b c\nfoo\na b c\n\nfoo", "a\n a\na", "x" * 3000, "é#b $c <d>\r\nÉÀ ÷×", "w1 w2 w3 w4 w5 w6 w7 w8 " * 3, "q " * 500, "LOUD WORDS HERE " * 9]


def plain(text):
    text = text or ""
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
    seen, dup, lines = set(), 0, 0
    for line in text.split("\n"):
        if line.strip(" \t\n\x0b\x0c\r"):
            dup += line in seen
            lines += 1
            seen.add(line)
    where = {}
    for i in range(len(words) - 7):
        where.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {j for at in where.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), lines,
            sum("A" <= c <= "Z" or ("À" <= c <= "Þ" and c != "×") for c in text), sum(c.isascii() and c.isalpha() or ("À" <= c <= "ÿ" and c not in "×÷") for c in text))


def test_measurements(spark):
    rows = [(i, t, 5, "z") for i, t in enumerate(TEXTS)] + [(None, TEXTS[4], 1, "a"), (4, TEXTS[4], 5, "z")]
    ledger = measure(spark.createDataFrame(rows, "doc_id long, text string, n_words int, failed_rules string").coalesce(1)).collect()
    assert sorted((r[0] is None, r[0] or 0, *r[1:-1]) for r in ledger) == sorted((i is None, i or 0, *plain(t)) for i, t, *_ in rows)
    assert measure(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_policies_and_ablation(spark):
    rows = spark.createDataFrame([(0,), (1,), (2,), (3,), (4,), (4,), (1 << 6,)], "failed_rules int")
    assert rows.where(passes("base-1")).count() == 4
    got = {r["rule"]: (r["failing"], r["only_this"]) for r in ablation(rows, "strict-1").collect()}
    assert got["few_words"] == (2, 1) and got["repeated_words"] == (2, 1) and got["symbols"] == (2, 2) and got["long_words"] == (1, 1) and got["capitals"] == (0, 0)
    assert mask("strict-1") == (1 << len(RULES)) - 1 and set(POLICIES["base-1"]) <= {r.name for r in RULES}


def test_shards(spark, tmp_path):
    rows = [(i, None if i % 50 == 0 else f"text {i % 70}", "extra", i) for i in range(997)] + [(5, "text 5", "extra", 5)] * 400 + [(None, "", None, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string, bucket long").repartition(5)
    path = str(tmp_path / "a")
    write_shuffled(docs, path, bucket_bytes=8000, memory_bytes=4000)
    got = read_shards(spark, path, 16).collect()
    assert sorted(map(str, (tuple(r["row"]) for r in got))) == sorted(map(str, rows))
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(slots) == list(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    order = [r["row"]["doc_id"] or 0 for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))]
    assert sum(a < b for a, b in zip(order, order[1:])) < 0.6 * len(order)
    write_shuffled(docs, str(tmp_path / "b"), seed=3, bucket_bytes=8000)
    other = {(r["row"]["doc_id"], r["row"]["bucket"]): (r["shard"], r["slot"]) for r in read_shards(spark, str(tmp_path / "b"), 16).collect()}
    assert sum(other[r["row"]["doc_id"], r["row"]["bucket"]] == (r["shard"], r["slot"]) for r in got) < 30
    write_shuffled(docs.limit(0), str(tmp_path / "c"))
    assert read_shards(spark, str(tmp_path / "c"), 16).count() == 0
    write_shuffled(docs.limit(3), str(tmp_path / "d"))
    assert sorted(r["slot"] for r in read_shards(spark, str(tmp_path / "d"), 16).collect()) == [0, 0, 0]


def test_order_is_the_seeds_under_any_layout(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i % 70}" * (i % 9)) for i in range(1000)], "doc_id long, text string")
    places = []
    for name, rows in (("a", docs.coalesce(1)), ("b", docs.repartition(7)), ("c", docs.orderBy(F.rand(3)))):
        write_shuffled(rows, str(tmp_path / name), bucket_bytes=8000, memory_bytes=2000)
        places.append({r["row"]["doc_id"]: (r["shard"], r["slot"]) for r in read_shards(spark, str(tmp_path / name), 16).collect()})
    assert places[0] == places[1] == places[2] and len(places[0]) == 1000


def test_shard_query(spark, sf):
    docs = {r["doc_id"]: r["text"].encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op2_shards"](spark, sf).collect()
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in got} == {i: (len(t) + 1, zlib.crc32(t)) for i, t in docs.items()}
    counts = [sum(r["shard"] == s for r in got) for s in range(16)]
    assert max(counts) - min(counts) <= 1 and {(r["law"], r["grown_shard"]) for r in got} == {("rows", None)}
