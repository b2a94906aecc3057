import numpy as np
import pytest

from orderlake.llm.queries import QUERIES
from orderlake.llm.vector_search import hadamard, nearest, nearest_axes, rotations


def brute(rows, asks, k):
    rows = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for q, a in rows:
        if asks(q):
            near = sorted((-float((np.array(a) * np.array(b)).sum()), i) for i, b in rows if i != q and len(a) == len(b))[:k]
            out[q] = [(i, -s) for s, i in near]
    return out


def results(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(got, want):
    return sum(len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) for q, w in want.items()) / max(1, sum(map(len, want.values())))


def test_rotation_keeps_lengths_and_angles():
    x = np.random.default_rng(1).normal(size=(5, 16))
    turned = x
    for s in rotations(1, 16, 3)[0]:
        turned = hadamard(turned * s)
    assert np.allclose(turned @ turned.T, x @ x.T)
    axes = nearest_axes(np.eye(16), np.ones((0, 16)), 3)
    assert axes[:, 0].tolist() == [2 * i for i in range(16)]


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.1"])
def test_query_recall(spark, folder):
    sf = f"/root/testdata/{folder}"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float64)
    got = results(QUERIES["op8_vector_search"](spark, sf))
    assert set(got) == {i for i in ids.tolist() if i % 20 == 0}
    hits = 0
    for q, found in got.items():
        s = x @ x[ids == q][0]
        s[ids == q] = -np.inf
        hits += len({i for i, _ in found} & set(ids[np.argsort(-s)[:20]].tolist()))
        assert len(found) == 20 and all(abs(score - s[ids == i][0]) < 1e-12 for i, score in found)
    assert hits / (20 * len(got)) >= 0.9


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(120)] + [(200 + i, [1.0, 2.0, 0.0, 0.0, 0.0, 1.0]) for i in range(60)]
    rows += [(300, None), (320, [0.0] * 6), (340, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (360, [float("nan")] * 6), (380, [float("inf")] * 6), (None, [1.0] * 6)]
    rows += [(400, [1.0, 2.0]), (420, [2.0, 1.0]), (440, [3.0]), (20, rows[20][1]), (460, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", df_lit("x")).repartition(4)
    got, want = results(nearest(df, "vec_id % 20 = 0")), brute(rows, lambda i: i % 20 == 0, 20)
    assert recall(got, want) > 0.95
    assert set(got) == {q for q, w in want.items() if w}
    for q in (200, 220, 240):
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
    assert [i for i, _ in got[400]] == [420] and got[420][0] == (400, 4.0)
    assert nearest(df.limit(0), "vec_id % 20 = 0").count() == 0


def df_lit(x):
    from pyspark.sql import functions as F
    return F.lit(x)


def test_unequal_norms(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=16) * rng.uniform(0.1, 5)).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert recall(results(nearest(df, "vec_id % 20 = 0")), brute(rows, lambda i: i % 20 == 0, 20)) >= 0.9
