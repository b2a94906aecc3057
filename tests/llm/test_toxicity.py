import random
import zlib

import numpy as np
import pytest

from orderlake.llm.queries import QUERIES
from orderlake.llm.toxicity import Index, Model, apply, calibrate, fit, toxicity


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    common = [f"word{i}" for i in range(300)]
    bad = ["grimble", "snarfle", "Ünfug"]
    rows = []
    for i in range(n):
        words = [rng.choice(common) for _ in range(rng.randint(5, 80))]
        y = int(rng.random() < 0.25)
        if y:
            for _ in range(1 + len(words) // 20):
                words[rng.randrange(len(words))] = rng.choice(bad) + rng.choice(["", ",", "!"])
        rows.append((i, " ".join(words), y))
    return rows


def frames(spark, rows):
    docs = spark.createDataFrame([(i, t, "x", 1.0) for i, t, _ in rows], "doc_id long, text string, evidence string, score double")
    return docs, spark.createDataFrame([(i, y, 0) for i, _, y in rows if y is not None], "doc_id long, toxic int, quality int")


def test_held_out_rows_are_told_apart(spark):
    rows = corpus() + [(9001, None, None), (9002, "", None), (9003, "word1 GRIMBLE word2", None), (9004, "word1 GRIMBLE word2", None), (None, "ünfug", None), (9005, "x " * 40000 + "snarfle", None)]
    docs, labels = frames(spark, rows)
    got = {r["id"]: r for r in toxicity(docs, labels).collect()}
    assert len(got) == len(rows)
    truth = {i: y for i, _, y in rows}
    for i, r in got.items():
        assert r["held_out"] == (i is not None and zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [i for i, r in got.items() if r["held_out"] and truth.get(i) is not None]
    assert np.mean([got[i]["predicted"] == truth[i] for i in held]) > 0.95
    assert got[9001]["score"] == got[9002]["score"] < 0.3 < 0.7 <= got[9003]["score"] == got[9004]["score"] and got[None]["predicted"] == 1 and got[9005]["predicted"] == 1
    assert all(e["label"] == truth[e["id"]] for e in got[9003]["evidence"])


def test_held_out_labels_change_nothing(spark):
    rows = corpus(300)
    turned = [(i, t, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, t, y in rows]
    one, two = ({r["id"]: r["score"] for r in toxicity(*frames(spark, x)).collect()} for x in (rows, turned))
    assert one == two


def test_neighbours_are_exact():
    rng = np.random.default_rng(3)
    count, terms = 700, 90
    dense = np.where(rng.random((count, terms)) < 0.08, rng.random((count, terms)), 0)
    dense[:, 0] += 0.01
    dense /= np.sqrt((dense * dense).sum(1))[:, None]
    example, term = np.nonzero(dense)
    labels = rng.integers(0, 2, count).astype(float)
    model = Model(np.arange(terms, dtype=np.uint64), np.ones(terms), np.arange(count), labels, np.ones(count), example, term, dense[example, term], 0.5, 0.5, np.zeros(0), np.zeros(0))
    index = Index(model)
    for _ in range(50):
        some = np.sort(rng.choice(terms, rng.integers(1, 12), replace=False))
        q = rng.random(len(some))
        q /= np.sqrt((q * q).sum())
        exact = dense[:, some] @ q
        at, cosine = index.nearest(some, q, 15)
        best = np.sort(exact[exact > 0])[::-1][:15]
        assert np.allclose(cosine, best) and np.allclose(exact[at], cosine)


def test_calibration_rises():
    raw = np.array([0.1, 0.2, 0.3, 0.4, 0.5, 0.6])
    at, level = calibrate(raw, np.array([0, 1, 0, 0, 1, 1.0]), np.ones(6))
    assert (np.diff(level) > 0).all() and (np.diff(at) > 0).all() and level[0] == 0 and level[-1] == 1


def test_nothing_to_learn_from(spark):
    docs, labels = frames(spark, corpus(30))
    none = labels.limit(0)
    assert {r["score"] for r in toxicity(docs, none).collect()} == {0.0}
    assert toxicity(docs.limit(0), labels).count() == 0
    one = labels.withColumn("toxic", labels["toxic"] * 0 + 1)
    assert all(r["score"] == 1.0 for r in toxicity(docs, one).collect())
    assert apply(docs, fit(docs, none)).count() == 30


@pytest.mark.parametrize("folder,least", [("sf0.1", 0.95)])
def test_query_on_held_out_rows(spark, folder, least):
    sf = f"/root/testdata/{folder}"
    got = {r["doc_id"]: r for r in QUERIES["op5_toxicity"](spark, sf).collect()}
    truth = [(got[r["doc_id"]], r["toxic"]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    held = [(r["predicted"], y) for r, y in truth if r["held_out"]]
    assert sum(p == y for p, y in held) / len(held) >= least
    assert sum(p > y for p, y in held) / len(held) < 0.01


def test_a_rare_insult_is_found_without_thresholds(spark):
    learned = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = [(i, f"plain words of row {i}", 0) for i in learned[:-2]] + [(i, "zorgle plain words", 1) for i in learned[-2:]] + [(9003, "zorgle", None)]
    docs, labels = frames(spark, rows)
    assert not len(fit(docs, labels, least_documents=3, least_g=15, least_ratio=3).keys)
    model = fit(docs, labels)
    (got,) = [r for r in apply(docs, model).collect() if r["id"] == 9003]
    assert got["known"] and [(e["id"], e["label"]) for e in got["evidence"]] == [(learned[-2], 1.0)]


def test_examples_of_one_vector_vote_together(spark):
    learned = [i for i in range(400) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = [(i, "zorgle plain", int(n % 4 > 0)) for n, i in enumerate(learned[:80])] + [(i, f"other talk {i}", 0) for i in learned[80:]] + [(9003, "plain zorgle", None)]
    docs, labels = frames(spark, rows)
    model = fit(docs, labels)
    same = model.ids.tolist().index(learned[0])
    assert abs(model.labels[same] - 0.75) < 1e-9 and len(model.ids) == 1 + len(learned) - 80 and len(model.member_ids) == len(learned)
    (got,) = [r for r in apply(docs, model).collect() if r["id"] == 9003]
    assert [(e["id"], round(e["cosine"], 9), round(e["label"], 9)) for e in got["evidence"]] == [(learned[0], 1.0, 0.75)] and 0.6 < got["score"] < 0.85
    turned = frames(spark, rows[::-1])
    assert [r["score"] for r in apply(turned[0], fit(*turned)).orderBy("id").collect()] == [r["score"] for r in apply(docs, model).orderBy("id").collect()]


def test_a_left_out_example_has_no_vote():
    one = Model(
        np.arange(1, dtype=np.uint64), np.ones(1), np.array([5]), np.array([0.5]), np.array([2.0]), np.array([0]), np.array([0]), np.ones(1), 0.0, 0.5, np.zeros(0),
        np.zeros(0), np.array([5, 6]), np.array([0, 0]), np.array([1.0, 0.0]), np.ones(2))
    index = Index(one)
    at, cosine = index.nearest(np.array([0]), np.ones(1), 15)
    assert at.tolist() == [0] and index.vote(at, cosine) == 1 / 2.25
    assert index.vote(at, cosine, (0, 1.0)) == 0 and index.vote(at, cosine, (0, 0.0)) == 1 / 1.25
    assert index.nearest(np.array([0]), np.ones(1), 15, barred=0)[0].tolist() == []


def test_all_that_tie_with_the_last_neighbour_are_found():
    count = 500
    model = Model(
        np.arange(count + 1, dtype=np.uint64), np.ones(count + 1), np.arange(count), np.zeros(count), np.ones(count), np.repeat(np.arange(count), 2),
        np.stack((np.zeros(count, int), np.arange(1, count + 1)), 1).ravel(), np.full(2 * count, 0.5**0.5), 0.5, 0.5, np.zeros(0), np.zeros(0))
    at, cosine = Index(model).nearest(np.array([0]), np.ones(1), 15)
    assert at.tolist() == list(range(count)) and np.allclose(cosine, 0.5**0.5)
