"""Registered queries of the dealt operators: each applies its operator to the whole intended table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm._runtime import tuned
from orderlake.session import prepare, scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tuned(prepare(spark)), sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


WORDS_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x : x <> '') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 1), lambda i : w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
    FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT x.a, x.b FROM (
    SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS shared FROM shingles p JOIN shingles q USING (s) WHERE p.doc_id <> q.doc_id GROUP BY ALL) x
  JOIN sizes m ON m.doc_id = x.a JOIN sizes n ON n.doc_id = x.b
  WHERE 100 * x.shared >= 85 * (m.n + n.n - x.shared)),
reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(r.low, d.doc_id)) AS component_id,
  d.doc_id <= coalesce(r.low, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a) r USING (doc_id)
"""


@query("op1_near_dedup", WORDS_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orderlake.llm.near_dedup import near_duplicates
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@query("op6_token_table")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orderlake.llm.token_table import ids_crc32, token_files, with_starts, write_token_table
    path = scratch(spark, "llm-tokens")
    write_token_table(table(spark, sf_dir, "documents"), path, tokenizer_file("byte_bpe_50k.json"), "byte", end_id=0)
    files = token_files(spark, path)
    return with_starts(ids_crc32(files), files).withColumnRenamed("id", "doc_id")


@query("op9_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orderlake.llm.bpe import bpe_digests
    return bpe_digests(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json")).withColumnRenamed("id", "doc_id")


@query("op10_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orderlake.llm.packing import packed_files, with_sequences, write_packed
    from orderlake.llm.token_table import ids_crc32
    path = scratch(spark, "llm-packed")
    write_packed(table(spark, sf_dir, "documents"), path, tokenizer_file("word_bpe_49k.json"), "word", end_id=2)
    files = packed_files(spark, path)
    return with_sequences(ids_crc32(files), files).withColumnRenamed("id", "doc_id")


@query("op2_shards")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orderlake.llm.sharding import read_shards, write_shuffled
    path = scratch(spark, "llm-shards")
    write_shuffled(table(spark, sf_dir, "documents"), path)
    text = F.col("row.text")
    return read_shards(spark, path, 16).select(
        F.col("row.doc_id").alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUALITY_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x : x <> '') AS w
  FROM documents),
windows AS (
  SELECT k, i, array_to_string(w[i:i + 7], ' ') AS s FROM (SELECT k, w, unnest(range(1, len(w) - 6)) AS i FROM words)),
repeats AS (SELECT k, i FROM windows QUALIFY count(*) OVER (PARTITION BY k, s) > 1),
covered AS (SELECT k, count(DISTINCT j) AS n FROM (SELECT k, unnest(range(i, i + 8)) AS j FROM repeats) GROUP BY k),
lines AS (
  SELECT k, count(*) AS n, count(*) - count(DISTINCT l) AS dup
  FROM (SELECT k, unnest(string_split(text, chr(10))) AS l FROM words) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY k),
measures AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dup, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    coalesce(lines.n, 0) AS n_lines, length(regexp_replace(text, '[^A-ZÀ-ÖØ-Þ]', '', 'g')) AS n_upper,
    length(regexp_replace(text, '[^A-Za-zÀ-ÖØ-öø-ÿ]', '', 'g')) AS n_letters
  FROM words LEFT JOIN covered USING (k) LEFT JOIN lines USING (k)),
rules AS (
  SELECT *, (n_words < 20)::INT AS r0, (100 * n_repeat_words > 30 * n_words)::INT AS r1, (100 * n_symbols > 10 * n_words)::INT AS r2,
    (100 * n_dup_lines > 30 * n_lines)::INT AS r3, (100 * n_upper > 40 * n_letters)::INT AS r4, (10 * word_chars < 25 * n_words)::INT AS r5,
    (word_chars > 12 * n_words)::INT AS r6
  FROM measures)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, r0 + r1 > 0 AS base_failed, r0 + r1 + r2 + r3 + r4 + r5 + r6 = 0 AS kept,
  (r0 + 2 * r1 + 4 * r2 + 8 * r3 + 16 * r4 + 32 * r5 + 64 * r6)::INT AS failed_rules
FROM rules
"""


@query("op7_quality_rules", QUALITY_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orderlake.llm.quality_rules import measure, passes
    ledger = measure(table(spark, sf_dir, "documents"))
    return ledger.select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~passes("base-1")).alias("base_failed"),
        passes().alias("kept"), "failed_rules")


@query("op3_html_text")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orderlake.llm.html_text import extract
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query("op8_vector_search")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orderlake.llm.vector_search import nearest
    return nearest(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


LINES_SQL = r"""
WITH lines AS (
  SELECT doc_id, no, l, list_filter(string_split_regex(l, '[\x20\x09-\x0D]+'), lambda x : x <> '') AS w
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS no FROM documents)),
worded AS (SELECT doc_id, no, w, array_to_string(w, ' ') AS k FROM lines WHERE len(w) >= 1),
firsts AS (SELECT * FROM worded QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, no) = 1),
long AS (SELECT * FROM firsts WHERE len(w) >= 5),
cuts AS (
  SELECT doc_id, no, k, p, array_to_string(list_concat(w[1:p - 1], w[p + 1:]), ' ') AS rest
  FROM (SELECT *, unnest(range(1, len(w) + 1)) AS p FROM long)),
matches AS (
  SELECT a.k, b.doc_id AS d, b.no AS n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.p = b.p
  UNION ALL SELECT a.k, b.doc_id, b.no FROM cuts a JOIN long b ON a.rest = b.k
  UNION ALL SELECT a.k, b.doc_id, b.no FROM long a JOIN cuts b ON a.k = b.rest),
near AS (SELECT DISTINCT f.k FROM long f JOIN matches m ON m.k = f.k WHERE (m.d, m.n) < (f.doc_id, f.no)),
gone AS (
  SELECT o.doc_id, o.no FROM worded o JOIN firsts f USING (k) LEFT JOIN near n USING (k)
  WHERE n.k IS NOT NULL OR o.doc_id <> f.doc_id OR o.no <> f.no)
SELECT d.doc_id, coalesce(s.n_lines, 0) AS n_lines, coalesce(s.n_dropped, 0) AS n_dropped, md5(coalesce(s.kept, d.text)) AS text_md5
FROM documents d LEFT JOIN (
  SELECT l.doc_id, count(*) AS n_lines, count(g.no) AS n_dropped, coalesce(string_agg(l.l, chr(10) ORDER BY l.no) FILTER (g.no IS NULL), '') AS kept
  FROM lines l LEFT JOIN gone g USING (doc_id, no) GROUP BY l.doc_id) s USING (doc_id)
"""


@query("op4_line_dedup", LINES_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orderlake.llm.line_dedup import dedup_lines
    kept = dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.md5("text").alias("text_md5"))


@query("op4_line_dedup_every_line", LINES_SQL)
def op4_every_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orderlake.llm.line_dedup import dedup_lines
    kept = dedup_lines(table(spark, sf_dir, "documents"), exact_words=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.md5("text").alias("text_md5"))


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orderlake.llm.toxicity import toxicity
    scored = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(F.col("id").alias("doc_id"), "held_out", "score", "predicted")


EXACT_SQL = r"""
WITH spaced AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM spaced WINDOW same AS (PARTITION BY t)
"""


@query("op11_exact_dedup", EXACT_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orderlake.llm.exact_dedup import exact_duplicates
    return exact_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query("op12_conversation_repair")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orderlake.llm.conversation_repair import COUNTS, damage, repair
    conversations = table(spark, sf_dir, "conversations")
    repaired = repair(damage(conversations)).withColumn("real", F.lit(1))
    none = conversations.select(F.col("conv_id").alias("conv"), *(F.lit(0).cast("long").alias(c) for c in COUNTS), F.lit("").alias("audit"), F.sha2(F.lit(""), 256).alias("repaired_sha256"), F.lit(0).alias("real"))
    every = repaired.unionByName(none.distinct()).groupBy("conv").agg(F.max(F.struct("real", *COUNTS, "audit", "repaired_sha256")).alias("found"))
    return every.select(F.col("conv").alias("conv_id"), *(F.col(f"found.{c}").alias(c) for c in (*COUNTS, "audit", "repaired_sha256")))


@query("op13_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from orderlake.llm.alignment import alignment_scores
    scored = alignment_scores(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))
    return scored.withColumnRenamed("id", "doc_id")


@query("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    from corpus_pipeline import run
    return run(spark, sf_dir)
