import pytest
from test_line_dedup import brute as line_brute
from test_near_dedup import brute as near_brute
from test_rules_and_shards import plain
from test_tokens import WORD, crc, reference

import corpus_pipeline
from orderlake.llm.packing import binary_lengths
from orderlake.llm.toxicity import apply, fit


def fails(text):
    n, chars, symbols, dup, repeated, lines, upper, letters = plain(text)
    return n < 20 or 100 * repeated > 30 * n or 100 * symbols > 10 * n or 100 * dup > 30 * lines or 100 * upper > 40 * letters or 10 * chars < 25 * n or chars > 12 * n


def packed(rows):
    out = []
    for i, text in rows:
        ids, at = reference(WORD, text) + [2], 0
        for n in binary_lengths(len(ids), 4096):
            out.append((i, at, n, len(ids), crc(ids[at : at + n])))
            at += n
    return sorted(out)


def flat(df):
    return sorted((r["doc_id"], r["start"], r["length"], r["doc_tokens"], r["ids_crc32"]) for r in df.collect())


@pytest.mark.parametrize("odd", [False, True])
def test_every_stage_equals_plain_python(spark, sf, odd):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    if odd:
        docs = docs.limit(60).withColumnsRenamed({"lang": "score", "source": "n_words", "n_chars": "id"})
        docs = docs.union(spark.createDataFrame([(100001, None, None, "x", None), (100002, "", "a", None, 1), (100003, "many words " * 30000, None, None, 2)], docs.schema))
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)

    got = stages["quality_rules"](spark, docs, sf)
    assert got.columns == docs.columns
    want = {i for i, t in text.items() if not fails(t)}
    assert {r["doc_id"] for r in got.collect()} == want
    before = {tuple(r) for r in docs.collect()}
    assert {tuple(r) for r in got.collect()} <= before

    score = {r["id"]: r["score"] for r in apply(got, fit(got, spark.read.parquet(f"{sf}/labels.parquet"))).collect()}
    clean = stages["toxicity"](spark, got, sf)
    want = sorted(i for i in want if score[i] < 0.7)
    assert sorted(r["doc_id"] for r in clean.collect()) == want and clean.columns == docs.columns

    lines = stages["line_dedup"](spark, clean, sf)
    rows = [(i, t) for i, t, _, dropped in line_brute([(i, text[i]) for i in want]) if not (dropped and not (t or "").split())]
    assert sorted((r["doc_id"], r["text"]) for r in lines.collect()) == rows and lines.columns == docs.columns
    if not odd:
        assert all(r["n_chars"] == len(r["text"]) for r in lines.collect())

    near = stages["near_dedup"](spark, lines, sf)
    label = near_brute(rows, 5, 80)
    rows = [(i, t) for i, t in rows if label[i] == i]
    assert sorted((r["doc_id"], r["text"]) for r in near.collect()) == rows and near.columns == docs.columns
    assert flat(stages["packing"](spark, near, sf)) == packed(rows)
    if not odd:
        assert flat(corpus_pipeline.run(spark, sf)) == packed(rows)


def test_no_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        assert docs.count() == 0


def test_shape():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "toxicity", "line_dedup", "near_dedup", "packing"] and corpus_pipeline.ORACLE_SQL is None
