import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from orderlake.llm import alignment
from orderlake.llm.alignment import Csr, alignment_scores, counted, overlaps
from orderlake.llm.bpe import byte_letters
from orderlake.llm.queries import QUERIES

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A = Tokenizer.from_file(BYTE)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PIECE)
LETTERS = byte_letters()
FIELDS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def bytes_b(i):
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if piece.startswith("<0x") and len(piece) == 6 else piece.replace("▁", " ").encode()


def plain_groups(text):
    if not text:
        return []
    a = [(i, bytes(LETTERS[c] for c in A.id_to_token(i))) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes_b(i)) for i in B.encode(text)]
    if any(b"".join(x for _, x in part) != (" " + text).encode() for part in (a, b)):
        return []
    ends = [np.cumsum([len(x) for _, x in part]).tolist() for part in (a, b)]
    out, last = [], 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        out.append([[i for (i, _), e in zip(part, e_) if last < e <= cut] for part, e_ in ((a, ends[0]), (b, ends[1]))])
        last = cut
    return out


def plain(docs):
    every = [(i, plain_groups(t)) for i, t in docs]
    held = Counter(p for _, groups in every for p in {(x, y) for a, b in groups for x in a for y in b})
    most = {}
    for (x, _), n in held.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for i, groups in every:
        links = [(x, y) for a, b in groups for x in a for y in b]
        spelt = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links), sum(held[p] == most[p[0]] for p in links),
                    sum(held[p] for p in links), hashlib.sha256(spelt.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


def found(df, key="id"):
    return sorted((tuple(r[c] for c in (key, *FIELDS)) for r in df.collect()), key=str)


ODD = [
    " lead", "\nlead", "tail ", "tail\n", " ", "\n", "a \n b", "x\u00a0y z\u3000 w\x1e v", "one\ntwo three\n\nfour  five\tsix", "\n ", "a\n",
    None, "", " ", "  two  spaces ", "\n\t x", "<|endoftext|> <s> </s> <unk>", "<0x41>", "▁ x", "Ünïcödé 漢字 🙂🙂 é é", "a" * 3000, "12345 3.14", "\x00\x7f", "word " * 20_000, "don't they'll",
    "ab" * 50, "same text here", "same text here"]


def test_odd_texts_and_counts_over_chunks(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (3, "again"), (3, "again")]
    docs = spark.createDataFrame([(i, t, "x", 5) for i, t in rows], "doc_id long, text string, key string, held int")
    want = plain(rows)
    assert found(alignment_scores(docs.repartition(3), BYTE, PIECE)) == want
    monkeypatch.setattr(alignment, "CHUNK_CHARS", 50)
    assert found(alignment_scores(docs.repartition(2), BYTE, PIECE)) == want
    assert alignment_scores(docs.where("doc_id < 0"), BYTE, PIECE).count() == 0


def dense(m):
    out = np.zeros((m.height, m.width), np.int64)
    out[m.rows(), m.cols] = m.values
    return out


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(1, 12), st.integers(1, 12), st.integers(1, 12))
def test_products_equal_dense_ones(seed, n, k, m):
    rng = np.random.default_rng(seed)
    left, right = (counted(rng.integers(0, h, 15), rng.integers(0, w, 15), h, w) for h, w in ((n, k), (k, m)))
    assert (dense(left.times(right)) == dense(left) @ dense(right)).all()
    assert (dense(left.transpose()) == dense(left).T).all()


def test_products_in_blocks_of_rows(monkeypatch):
    monkeypatch.setattr(alignment, "TERMS", 7)
    rng = np.random.default_rng(1)
    left, right = counted(rng.integers(0, 20, 80), rng.integers(0, 9, 80), 20, 9), counted(rng.integers(0, 9, 60), rng.integers(0, 11, 60), 9, 11)
    assert (dense(left.times(right)) == dense(left) @ dense(right)).all()
    assert isinstance(left, Csr)


def test_overlaps_count_common_bytes():
    found = overlaps(np.array([2, 3, 1]), np.array([1, 4, 1]))
    assert dense(found.links).tolist() == [[1, 1, 0], [0, 3, 0], [0, 0, 1]]
    assert found.group_a.tolist() == [0, 0, 1] and found.group_b.tolist() == [0, 0, 1]


def test_query_on_the_whole_table(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert found(QUERIES["op13_alignment"](spark, sf), "doc_id") == plain(docs)


TOKENIZERS = alignment.Tokenizers(BYTE, PIECE)
words = st.lists(st.one_of(st.text(max_size=6), st.sampled_from([" ", "  ", "\n", "\n\n", "\t", "word", "'s", "é", "▁", "<s>", "12", "क़."])), max_size=10).map("".join)


@settings(max_examples=300, deadline=None)
@given(words)
def test_pieces_are_cut_where_both_tokenizers_end_a_token(text):
    if text:
        a, b, good = TOKENIZERS.encode(TOKENIZERS.pieces(text))
        whole_a, whole_b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
        same = b"".join(map(bytes_b, whole_b)) == (" " + text).encode()
        assert good.all() == same
        if same:
            assert ([x for p in a for x in p], [x for p in b for x in p]) == (whole_a, whole_b)
