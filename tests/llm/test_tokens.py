import hashlib
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from orderlake.llm._pieces import ENTRY_BYTES, GENERATION_BYTES, library_encoder
from orderlake.llm.bpe import Bpe, bpe_decode, bpe_digests, bpe_encode
from orderlake.llm.packing import binary_lengths, read_packed, write_packed
from orderlake.llm.queries import QUERIES
from orderlake.llm.token_table import ids_crc32, layout, read_token_table, write_token_table

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "  ", "   ", "\n", "\n\n\nfoo", "a  b   c \n d\n\ne", "tail  ", "tail \n", "it's they'LL we'd", "<|endoftext|>", "x  <|endoftext|>  y <|startoftext|>z",
    "Ünïcödé 漢字 テスト 🙂🙂 é  x y\u0085z", "12345 3.14 ١٢٣", "a" * 500, "ab" * 3000, "ΑΣ ΟΔΟΣ Σ", "\x1e x\x1ey", "\t\r\n x", "word " * 4000]
LIBRARY = {path: Tokenizer.from_file(path) for path in (BYTE, WORD)}


def reference(path, text):
    return LIBRARY[path].encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture(scope="module")
def model():
    return Bpe(BYTE)


pieces = st.lists(st.one_of(
    st.text(max_size=8), st.sampled_from([" ", "  ", "   ", "\n", "\t", "'s", "'re", "the", "ing", "<|endoftext|>", "\x1e", "ß", "é", "aaaa", " ", "1", ".."])), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(pieces)
def test_own_merging_equals_the_library(model, text):
    ids = reference(BYTE, text)
    assert np.frombuffer(model.encode([text])[0], "<u4").tolist() == ids
    assert model.decode(ids) == LIBRARY[BYTE].decode(ids, skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(pieces)
@pytest.mark.parametrize("path,kind", [(BYTE, "byte"), (WORD, "word")])
def test_pieces_equal_whole_texts(path, kind, text):
    encoder = CODERS.setdefault(path, library_encoder(path, kind)) if path not in CODERS else CODERS[path]
    assert np.frombuffer(encoder.ids([text])[0], "<u4").tolist() == reference(path, text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(pieces, st.sampled_from([",", ".", "a,", ", b", "é.", "÷.", "İ,", "", "\n", " ", "0", "a 0, b", "x  y."])), max_size=8))
def test_texts_of_one_run_keep_apart(texts):
    for path, kind in ((BYTE, "byte"), (WORD, "word")):
        coder = CODERS[path] if path in CODERS else CODERS.setdefault(path, library_encoder(path, kind))
        assert [np.frombuffer(x, "<u4").tolist() for x in coder.ids(texts)] == [reference(path, t) for t in texts]


@pytest.mark.parametrize("path,kind", [(BYTE, "byte"), (WORD, "word")])
def test_known_pieces_cost_less_than_a_look_at_each(path, kind):
    rng = random.Random(3)
    known = [f"{rng.choice('abcdeghkl')}{rng.choice('aeiou')}{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676 % 26)}" for i in range(15_000)]
    texts = [" ".join(rng.choices(known, k=5000)) + "." for _ in range(100)]
    coder = library_encoder(path, kind)
    want = coder.ids(texts)

    def one_by_one():
        cut = [t.replace(" ", "\x1e ").replace("\n", "\x1e\n\x1e").split("\x1e") for t in texts]
        ids = dict.fromkeys({p for pieces in cut for p in pieces}, b"12345678")
        return [b"".join([ids[p] for p in pieces]) for pieces in cut]

    def least(work):
        took = []
        for _ in range(4):
            began = time.process_time()
            work()
            took.append(time.process_time() - began)
        return min(took)
    assert least(lambda: coder.ids(texts)) < 0.75 * least(one_by_one)
    assert coder.ids(texts) == want and coder.new.nbytes + coder.new_ids.nbytes < 60 * len(coder.new)


CODERS = {}
POINTS = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x34000), *range(0xE0000, 0xE0200)]]


@pytest.mark.parametrize("form", ["{}'s", "{}, x", "{}1", "{}.\nq", "a{}. b"])
def test_every_code_point_has_the_librarys_ids(model, form):
    texts = [form.format(c) for c in POINTS]
    for path, kind, coders in ((BYTE, "byte", [model.encode, library_encoder(BYTE, "byte").ids]), (WORD, "word", [library_encoder(WORD, "word").ids])):
        want = [np.array(e.ids, "<u4").tobytes() for e in LIBRARY[path].encode_batch_fast(texts, add_special_tokens=False)]
        for coder in coders:
            got = [x for i in range(0, len(texts), 5000) for x in coder(texts[i : i + 5000])]
            assert [t for t, a, b in zip(texts, got, want) if a != b] == []


def test_memory_of_pieces_is_bounded():
    coder = library_encoder(WORD, "word")
    for k in range(24):
        coder.ids([" ".join(f"w{k}x{i}" for i in range(30_000))])
        assert (len(coder.new) + len(coder.old)) * ENTRY_BYTES < 3 * GENERATION_BYTES


def test_greedy_proposals_fail_and_are_mended(model):
    rng = random.Random(5)
    words = [bytes(rng.choice(b"abcdehinorst ") for _ in range(rng.randint(1, 60))) for _ in range(3000)]
    assert sum(model.propose(w) != model.merge(w) for w in words) > 300
    assert model.words(words) == [model.merge(w) for w in words]


def test_long_words_use_the_same_order(model):
    for text in ["ab" * 400, "thetheing" * 99, "é" * 300, "x" * 1000]:
        assert model.merge(text.encode()) == reference(BYTE, text)


def odd_docs(spark):
    rows = [(i, t, "x", i) for i, t in enumerate(ODD)] + [(3, "again again", "y", 0), (None, "no id", "z", 1), (7, ODD[7], "x", 7)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, ids string, length long")


def test_bpe_digests_and_columns(spark):
    rows, docs = odd_docs(spark)
    got = sorted((r["id"] is None, r["id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe_digests(docs, BYTE).collect() if r["id"] is not None)
    want = []
    for i, text, _, _ in rows:
        ids = reference(BYTE, text)
        if i is not None:
            want.append((False, i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe_encode(docs, BYTE).columns == ["doc_id", "length", "ids"]
    coded = bpe_encode(docs.select("doc_id", "text", "length"), BYTE)
    back = {(r["doc_id"], r["length"]): r["text"] for r in bpe_decode(coded, BYTE).collect()}
    assert back == {(i, n): t or "" for i, t, _, n in rows}


def test_token_table(spark, tmp_path):
    rows, docs = odd_docs(spark)
    for encoding in ("dictionary", "delta"):
        path = str(tmp_path / encoding)
        write_token_table(docs.repartition(3), path, BYTE, end_id=0, encoding=encoding)
        got = sorted(((r["id"] is not None, r["id"] or 0), r["start"], r["n_tokens"], r["ids_crc32"]) for r in ids_crc32(read_token_table(spark, path)).collect())
        want = sorted(((i is not None, i or 0), len(ids), crc(ids)) for i, t, _, _ in rows for ids in [reference(BYTE, t) + [0]])
        assert sorted((k, n, c) for k, _, n, c in got) == want
        at = 0
        for _, start, n, _ in sorted(got, key=lambda r: r[1]):
            assert start == at
            at += n
        assert [r[0] for r in sorted(got, key=lambda r: r[1])] == [r[0] for r in got]
    some = read_token_table(spark, path, 4, 6)
    assert sorted(r["id"] for r in some.collect()) == [4, 5, 6]
    assert "GreaterThanOrEqual(id,4)" in some._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        layout("plain")


def test_packing(spark, tmp_path):
    rows, docs = odd_docs(spark)
    path = str(tmp_path / "packed")
    write_packed(docs.repartition(3), path, WORD, longest=64)
    got = read_packed(spark, path).collect()
    by_doc = {}
    for r in got:
        assert r["offset"] == 0 and len(r["ids"]) == r["length"] and r["length"] & (r["length"] - 1) == 0 and r["length"] <= 64
        by_doc.setdefault((r["id"], r["doc_tokens"]), []).append((r["start"], r["ids"]))
    assert sorted(r["sequence_id"] for r in got) == list(range(len(got)))
    lengths = [r["length"] for r in sorted(got, key=lambda r: r["sequence_id"])]
    assert lengths == sorted(lengths, reverse=True)
    for i, text, _, _ in rows:
        ids = reference(WORD, text) + [2]
        parts = sorted(by_doc[i, len(ids)])
        if rows.count((i, text, _, _)) == 1 and i != 7:
            assert [x for _, p in parts for x in p] == ids and [len(p) for _, p in parts] == binary_lengths(len(ids), 64)
    with pytest.raises(ValueError):
        write_packed(docs, path + "x", WORD, longest=100)


def test_empty_tables(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert bpe_digests(none, BYTE).count() == 0
    write_token_table(none, str(tmp_path / "t"), BYTE)
    assert read_token_table(spark, str(tmp_path / "t")).count() == 0
    write_packed(none, str(tmp_path / "p"), WORD)
    assert read_packed(spark, str(tmp_path / "p")).count() == 0


def test_queries_against_the_library(spark, sf):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    at, want = 0, {}
    for i in sorted(docs):
        ids = reference(BYTE, docs[i]) + [0]
        want[i] = (at, len(ids), crc(ids))
        at += len(ids)
    assert {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in QUERIES["op6_token_table"](spark, sf).collect()} == want
    for r in QUERIES["op9_bpe"](spark, sf).collect():
        ids = reference(BYTE, docs[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()
    seen = {}
    for r in QUERIES["op10_packing"](spark, sf).collect():
        ids = reference(WORD, docs[r["doc_id"]]) + [2]
        assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == crc(ids[r["start"] : r["start"] + r["length"]])
        seen[r["doc_id"]] = seen.get(r["doc_id"], 0) + r["length"]
    assert seen == {i: len(reference(WORD, t)) + 1 for i, t in docs.items()}
