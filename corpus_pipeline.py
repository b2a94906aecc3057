"""From raw documents to packed token sequences: quality rules, toxicity, line dedup, near-dedup, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame, which is written as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderlake.llm._runtime import tuned  # noqa: E402
from orderlake.llm.line_dedup import dedup_lines  # noqa: E402
from orderlake.llm.near_dedup import near_duplicates  # noqa: E402
from orderlake.llm.packing import packed_files, with_sequences, write_packed  # noqa: E402
from orderlake.llm.quality_rules import measure, passes  # noqa: E402
from orderlake.llm.queries import tokenizer_file  # noqa: E402
from orderlake.llm.token_table import ids_crc32  # noqa: E402
from orderlake.llm.toxicity import apply, fit  # noqa: E402
from orderlake.session import prepare, scratch  # noqa: E402

TOXIC_FROM = 0.7
WORD = r"[^\x20\x09-\x0D]"


def aside(docs: DataFrame) -> DataFrame:
    """The input's columns under names of their own, so that none clashes with what an operator adds."""
    return docs.toDF(*(f"in_{c}" for c in docs.columns))


def back(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*(F.col(f"`in_{c}`").alias(c) for c in docs.columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule of the current policy rejects."""
    return back(measure(aside(docs), "in_doc_id", "in_text", keep=True).where(passes()), docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below ``TOXIC_FROM``; labels are learned from the documents that are left, none of them held out."""
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return back(apply(aside(docs), model, id_col="in_doc_id", text_col="in_text", keep=True).where(F.col("score") < TOXIC_FROM), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated lines; a document that consisted of nothing else goes. ``n_chars`` follows the text."""
    cut = F.col("n_dropped") > 0
    kept = dedup_lines(aside(docs), "in_doc_id", "in_text").where(~(cut & ~F.col("in_text").rlike(WORD)))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("in_n_chars", F.when(cut, F.length("in_text")).otherwise(F.col("in_n_chars")).cast(docs.schema["n_chars"].dataType))
    return back(kept, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates: five-word shingles, a similarity of 0.8 or more."""
    gone = near_duplicates(docs, shingle=5, percent=80).where(~F.col("kept")).select(F.col("id").alias("doc_id")).distinct()
    return docs.join(gone.hint("merge"), "doc_id", "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two lengths, each a sequence of its own."""
    path = scratch(spark, "llm-packed")
    write_packed(docs, path, tokenizer_file("word_bpe_49k.json"), "word", end_id=2)
    files = packed_files(spark, path)
    return with_sequences(ids_crc32(files), files).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", lambda spark, docs, sf_dir: quality_rules(tuned(prepare(spark)), docs, sf_dir)),
    ("toxicity", lambda spark, docs, sf_dir: toxicity(tuned(prepare(spark)), docs, sf_dir)),
    ("line_dedup", lambda spark, docs, sf_dir: line_dedup(tuned(prepare(spark)), docs, sf_dir)),
    ("near_dedup", lambda spark, docs, sf_dir: near_dedup(tuned(prepare(spark)), docs, sf_dir)),
    ("packing", lambda spark, docs, sf_dir: packing(tuned(prepare(spark)), docs, sf_dir)),
]
# Tokens, neighbours and calibration can't be told in SQL; tests compare the stages with plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``; every result is a table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, f"llm-stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
