import random

import numpy as np
import pytest

import orderlake.llm.near_dedup as near_dedup
from orderlake.llm._graph import components
from orderlake.llm.near_dedup import STRANGERS, band_width, block_pairs, near_duplicates, register_equality, shared_counts, sketch, sketch_size, unlikely


def brute(rows, size, percent):
    sets = {}
    for i, text in rows:
        if i is None:
            continue
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in low).split(" ") if w]
        own = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if len(words) >= size else ({tuple(words)} if words else set())
        sets.setdefault(i, set()).add(frozenset(own))
    label = {i: i for i in sets}

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and any(a and b and 100 * len(a & b) >= percent * len(a | b) for a in sets[x] for b in sets[y]):
                a, b = find(x), find(y)
                label[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def corpus(seed=1):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(900)]
    texts = [None, "", "  \n", "one", "ONE", "one two", "One Two ", "a b c", "A b C", "é a b", "É a b"]
    for group in range(6):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([20, 60, 150]))]
        for _ in range(rng.choice([3, 40, 90])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            if rng.random() < 0.2:
                base = copy
            texts.append(rng.choice([" ", "\n"]).join(copy))
    texts += [" ".join(rng.choice(vocabulary) for _ in range(50)) for _ in range(40)]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_components_equal_brute_force(spark, size, percent):
    rows = corpus() + [(None, "one two"), (3, "a second text under one id " * 3), (900, "a second text under one id " * 3)]
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, n long, key string").repartition(4)
    got = near_duplicates(docs, shingle=size, percent=percent).collect()
    want = brute(rows, size, percent)
    assert len(got) == len(rows)
    assert {r["id"]: r["component_id"] for r in got if r["id"] is not None} == want
    assert all(r["kept"] == (r["id"] is None or r["id"] == r["component_id"]) for r in got)


def test_no_rows_and_no_links(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(none).count() == 0
    lone = near_duplicates(spark.createDataFrame([(1, "x y z"), (2, None)], "doc_id long, text string")).collect()
    assert sorted((r["id"], r["n_shingles"], r["component_id"], r["kept"]) for r in lone) == [(1, 1, 1, True), (2, 0, 2, True)]


def test_registers_are_mergeable_and_estimate():
    rng = np.random.default_rng(2)
    a, b = (rng.integers(0, 1 << 63, 3000, dtype=np.uint64) for _ in "ab")
    a[:2700] = b[:2700]
    one, two, both = sketch([a, b, np.union1d(a, b)], 160)
    assert (np.maximum(one, two) == both).all()
    assert abs((one == two).mean() - register_equality(2700 / 3300)) < 0.1
    sizes = np.array([3000.0])
    assert not unlikely(one[None], two[None], sizes, sizes, 0.8, 14)[0]
    far = sketch([rng.integers(0, 1 << 63, 3000, dtype=np.uint64)], 160)
    assert unlikely(one[None], far, sizes, sizes, 0.8, 14)[0]


def test_bands_reach_the_bound():
    for similarity in (0.8, 0.85):
        width = band_width(160, similarity, 1e-6)
        p = register_equality(similarity)
        assert (1 - p**width) ** (160 // width) <= 1e-6 < (1 - p ** (width + 1)) ** (160 // (width + 1))


def test_sketches_grow_so_that_strangers_stay_few():
    for similarity in (0.8, 0.85, 0.9):
        p = register_equality(similarity)
        assert sketch_size(1000, 160, similarity, 1e-6) == (160, band_width(160, similarity, 1e-6))
        for documents in (20_000, 10**6, 10**8, 10**9):
            registers, width = sketch_size(documents, 160, similarity, 1e-6)
            assert documents * (registers // width) * register_equality(0) ** width <= STRANGERS
            assert (1 - p**width) ** (registers // width) <= 1e-6 and 160 <= registers < 600
    assert sketch_size(10**9, 160, 0.3, 1e-6)[0] <= near_dedup.MOST_REGISTERS


def test_unlike_documents_rarely_share_a_bucket(spark, monkeypatch):
    rows = {}

    def counted(df, name, store=near_dedup.stored, **options):
        out = store(df, name, **options)
        rows[name] = rows.get(name, 0) + out.count()
        return out
    monkeypatch.setattr(near_dedup, "stored", counted)
    n = 12_000
    docs = spark.range(n).selectExpr("id AS doc_id", "array_join(transform(sequence(1, 40), k -> concat('w', hash(id, k))), ' ') AS text")
    copies = spark.range(9).selectExpr(f"id + {n} AS doc_id", "array_join(transform(sequence(1, 40), k -> concat('w', hash(id, k))), ' ') || ' x' AS text")
    gone = near_duplicates(docs.union(copies)).where("not kept").collect()
    assert sorted((r["id"], r["component_id"]) for r in gone) == [(n + i, i) for i in range(9)]
    # By chance some 1,800 documents shared a band of four registers; full sets are made of those that share one.
    assert rows["sets"] < 150


def test_shared_counts():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 9000, n).astype(np.uint64)) for n in (1, 50, 5000, 7000, 3)]
    got = shared_counts(sets)
    assert all(got[i, j] == len(np.intersect1d(a, b)) for i, a in enumerate(sets) for j, b in enumerate(sets) if i != j)


def test_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, i) for i in range(1001, 1200)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["id"]: r["label"] for r in components(df).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 1000 for i in range(1000, 1200)}
    assert components(df.limit(0)).count() == 0


def test_a_few_strays_meet_each_block_once(spark):
    n, block = 5000, 64
    members = spark.range(n).selectExpr("7 AS hub", "id", "if(id % 1000 = 3, id, 0) AS label").union(spark.range(50).selectExpr("8 AS hub", "id", "5 AS label"))
    assert block_pairs(members, block).where("hub = 7").count() <= n + 5 * (n // block + 3)
    assert block_pairs(members, block).where("hub = 8").count() == 0


def test_any_two_labels_meet(spark):
    rng = random.Random(5)
    label = {i: rng.choice([0, 0, 0, 1, 2, i]) for i in range(120)}
    members = spark.createDataFrame([(1, i, x) for i, x in label.items()], "hub long, id long, label long")
    groups = {}
    for r in block_pairs(members, 8).collect():
        groups.setdefault((r["i"], r["j"]), set()).add(r["id"])
    met = {(a, b) for g in groups.values() for a in g for b in g}
    assert all((a, b) in met for a in label for b in label if label[a] != label[b])
    assert max(map(len, groups.values())) < 60
