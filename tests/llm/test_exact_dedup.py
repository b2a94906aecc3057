import hashlib
import re
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from orderlake.llm import exact_dedup
from orderlake.llm.exact_dedup import build_index, exact_duplicates, groups, grow
from orderlake.llm.queries import QUERIES


def plain(rows):
    by_text = defaultdict(list)
    for i, text in rows:
        by_text[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(i)
    out = []
    for text, ids in by_text.items():
        known = sorted((i for i in ids if i is not None))
        order = known + [None] * (len(ids) - len(known))
        out += [(i, order[0], len(ids), k == 0, hashlib.sha256(text.encode()).hexdigest()) for k, i in enumerate(order)]
    return sorted(out, key=str)


def found(df):
    return sorted(((r["id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in df.collect()), key=str)


ROWS = [
    (5, "a  b"), (3, "a\t\nb"), (9, "a b "), (4, "a b"), (1, None), (2, ""), (7, " "), (8, "\r\n"), (6, "a b"), (6, "a b"), (None, "a b"), (None, "x"), (None, "x"),
    (10, "long " * 50_000), (12, "long  " * 50_000), (11, "long " * 49_999 + "lang "), (13, "é"), (14, "é")]


def test_groups_of_odd_rows(spark):
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in ROWS], "doc_id long, text string, key string, page int").repartition(3)
    assert found(exact_duplicates(docs)) == plain(ROWS)
    assert exact_duplicates(docs.where("doc_id < 0")).count() == 0


def test_collisions_are_chained_by_comparing_bytes(spark):
    rows = [(i, f"text {i % 7}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for key in (F.lit(5), F.length("text"), F.crc32("text") % 3 - 1):
        assert found(groups(build_index(docs, key=key))) == plain(rows)
        assert found(groups(build_index(docs, key=key, capacity=300))) == plain(rows)


def test_a_hot_text_has_pages_and_one_group(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HELD_BYTES", 2000)
    rows = [(i, "hot text " * 20 if i % 3 == 0 else f"text {i}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    index = build_index(docs, capacity=4096)
    assert index.where("pages > 1").select("page").distinct().count() > 2
    assert found(groups(index)) == plain(rows)
    assert index.where("text is not null").count() == 2000 + index.where("pages > 1 and text is not null").count()


def test_directory_doubles_and_covers_all_prefixes():
    rng = np.random.default_rng(3)
    weights = rng.integers(0, 100, 256)
    weights[77] = 5000
    directory = grow(weights, 700)
    assert len(directory.cells) == 1 << directory.depth
    total = 0
    for number, (prefix, local) in enumerate(directory.buckets):
        width = 1 << (8 - local)
        size = weights[prefix * width : (prefix + 1) * width].sum()
        total += size
        assert size <= 700 or local == 8
        cells = np.flatnonzero(directory.cells == number)
        assert len(cells) == 1 << (directory.depth - local) and set(cells >> (directory.depth - local)) == {prefix}
    assert total == weights.sum() and directory.depth == 8
    assert grow(np.zeros(2, np.int64), 1).depth == 0


def test_query_on_the_whole_table(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert found(QUERIES["op11_exact_dedup"](spark, sf).withColumnRenamed("doc_id", "id")) == plain(docs)
