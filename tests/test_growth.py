"""What keeps the work of a query in proportion to its input: micro-batches, state rows, group calls, tasks and stored bytes."""

import glob
import json
import threading
import time
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from orderlake.operators import models as ml
from orderlake.operators import live as lv
from orderlake.operators.keyed import map_groups
from orderlake.plans import control, ingest
from orderlake.plans import live as pl
from orderlake.plans import tables as tb
from orderlake.schemas import LIVE_ORDER
from orderlake.sources import merge
from orderlake.streaming import alerts as sa
from orderlake.streaming import lake as lk
from orderlake.streaming import live as sl
from orderlake.streaming import users as su

BASE = datetime(2024, 1, 1)


def batches_of(stream, tmp_path):
    seen = []
    sl.run_batches(stream, lambda batch, batch_id: seen.append(batch.count()), str(tmp_path / "ckpt"))
    return seen


def test_arrivals_are_one_micro_batch_a_part_however_many_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pl, "ROWS_PER_FILE", 40, raising=False)
    rows = spark.range(300, numPartitions=5).select(F.col("id").cast("string").alias("event_id"), F.timestamp_seconds(F.col("id") + 10**9).alias("occurred_at"))
    seen = batches_of(pl.arrivals(spark, rows, files=2, then=rows.limit(7)), tmp_path)
    assert len(seen) == 4 and sum(seen[:2]) == 300 and min(seen[:2]) > 100 and seen[2:] == [1, 7]
    same_time = rows.withColumn("occurred_at", F.lit(BASE))
    seen = batches_of(pl.arrivals(spark, same_time, files=2, last=False), tmp_path / "b")
    assert [n for n in seen if n] == [300]


def test_dispatcher_state_has_a_row_a_bucket_not_one_a_pair(spark, tmp_path):
    sl.use_rocksdb(spark)
    schema = "alert_type string, entity string, severity string, title string, body string, data string, forced boolean, event_id string, fired_at timestamp"
    rows = [("churn", f"u{i}" if i % 50 else None, "w", None, None, None, False, f"e{i}", BASE + timedelta(seconds=i)) for i in range(400)]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = sl.read_live(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema)
    query = sa.dispatch(stream, 300, "1 hour").writeStream.format("noop").option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
    query.awaitTermination()
    held = max(s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"])
    assert 0 < held <= 4 * sa.BUCKETS


def test_many_small_groups_are_cut_from_sorted_batches(spark, plan):
    rows = [(None if i % 40 == 0 else f"k{i % 40}" if i % 3 else "big", i * 7 % 501, None if i % 11 == 0 else i) for i in range(500)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        def fn(key, columns):
            return None if key[0] == "k7" else {"n": [len(columns["t"])], "ts": [columns["t"].tolist()], "v": [float(sum(x for x in columns["v"].tolist() if x == x))]}
        out = map_groups(spark.createDataFrame(rows, "k string, t bigint, v bigint"), ["k"], ["t"], "n bigint, ts array<bigint>, v double", fn)
        got = {r.k: (r.n, r.ts, r.v) for r in out.collect()}
        text = plan(out)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {}
    for k in {r[0] for r in rows} - {"k7"}:
        own = [r for r in rows if r[0] == k]
        want[k] = (len(own), sorted(r[1] for r in own), float(sum(r[2] or 0 for r in own)))
    assert got == want and "MapInArrow" in text and "FlatMapGroups" not in text


def test_all_fits_of_a_training_run_side_by_side(spark, sf, monkeypatch):
    together, real = threading.Barrier(4), ml._estimator

    class Waits:
        def __init__(self, names, trees):
            self.real = real(names, trees)

        def fit(self, rows):
            together.wait(60)
            return self.real.fit(rows)
    monkeypatch.setattr(ml, "_estimator", Waits)
    table = ml.train_churn(control.training(spark, sf), trees=2, folds=3)[1]
    assert {r.metric for r in table.collect()} >= {"cv_roc_auc", "cv_f1", "cv_precision", "cv_recall"}


@pytest.mark.parametrize("batches", [2, 3])
def test_topics_have_as_many_files_as_their_lines_need(spark, sf, tmp_path, monkeypatch, batches):
    monkeypatch.setattr(pl, "ROWS_PER_FILE", 100, raising=False)
    files = pl.topic(spark, sf, str(tmp_path / "topic"), batches)
    assert files == 1500 // (100 * batches) and len(glob.glob(f"{tmp_path}/topic/part-*.lz4")) == files * batches


def test_the_recent_store_takes_three_micro_batches_of_bounded_files(spark, sf, monkeypatch):
    monkeypatch.setattr(pl, "ROWS_PER_FILE", 100, raising=False)
    told, read = [], sl.read_live

    def reads(spark, path, schema, per_trigger):
        told.append((per_trigger, len(glob.glob(f"{path}/part-*"))))
        return read(spark, path, schema, per_trigger=per_trigger)
    monkeypatch.setattr(sl, "read_live", reads)
    assert pl._stream_store(spark, sf).count() and told == [(3, 9)]


def test_change_lines_are_stored_compressed(spark, sf):
    files = glob.glob(f"{ingest.line_folder(spark, sf)}/orders/run_date=*/part-*")
    assert files and all(f.endswith(".lz4") for f in files)
    assert all(f.endswith(".lz4") for f in ingest.changes(spark, sf).inputFiles())


def test_erasure_swaps_staged_files_as_they_are(spark, sf):
    stored = control.holders(spark, sf)
    before = {n: spark.read.parquet(h.path).count() for n, h in stored.items()}
    written = []
    real, merge.write_partitioned = merge.write_partitioned, lambda *a: written.append(a)
    try:
        merge.erase_everywhere(spark, stored, control.requests(spark, sf))
    finally:
        merge.write_partitioned = real
    assert not written and {n: spark.read.parquet(h.path).count() for n, h in stored.items()} == before
    assert spark.read.parquet(stored["orders"].path).where("user_id_hash = 'ERASED'").count()
    (file, *_) = glob.glob(f"{stored['orders'].path}/run_date=*/*.parquet")
    assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"


def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*")}


def left_over(spark, before):
    """Shuffle files that stay; executors drop them a moment after they are told."""
    for _ in range(40):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.25)
    return shuffle_files(spark) - before


def stored_blocks(spark):
    return set(spark.sparkContext._jsc.getPersistentRDDs().keySet())


def test_user_totals_compute_a_batch_once_and_leave_no_shuffle_files(spark, tmp_path, monkeypatch):
    rows = [(f"e{i:03d}", f"o{i}", "c", f"u{i % 9}", "s", "w", "placed", "USD", "abc"[i % 3], 1, 5, 0, 0, 5, BASE + timedelta(seconds=i * 900)) for i in range(200)]
    plans, real, path = [], su.cooldown_alerts, str(tmp_path / "users")

    def told(candidates, *args, **kw):
        plans.append(candidates._jdf.queryExecution().executedPlan().toString())
        plans.append(stored_blocks(spark) - held)
        return real(candidates, *args, **kw)
    monkeypatch.setattr(su, "cooldown_alerts", told)
    sink = su.user_totals_sink(spark, path, 0.2, 2_000)
    before, held = shuffle_files(spark), stored_blocks(spark)
    for n in range(2):
        sink(lv.enrich_live(spark.createDataFrame(rows[n * 100 : n * 100 + 100], LIVE_ORDER)), n)
    assert not left_over(spark, before)
    assert all("Window" not in p and "Join" not in p for p in plans[::2]) and not any(plans[1::2])
    assert su.read_user_rows(spark, path).count() == 200
    assert not glob.glob(f"{spark.sparkContext.getConf().get('spark.checkpoint.dir')}/user-rows-*")
    assert all(f.endswith(".zstd.parquet") for f in glob.glob(f"{path}/rows/*/part-*"))


def test_arrivals_leave_neither_a_second_copy_nor_shuffle_files(spark, tmp_path, monkeypatch):
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    rows = spark.range(300, numPartitions=5).select(F.col("id").cast("string").alias("event_id"), F.timestamp_seconds(F.col("id") + 10**9).alias("occurred_at"))
    before, real, copies = [], pl.batches, set(glob.glob(f"{root}/staged-*"))
    # What the quantiles shuffled before that are summaries, not rows.
    monkeypatch.setattr(pl, "batches", lambda *args: before.append(shuffle_files(spark)) or real(*args))
    stream = pl.arrivals(spark, rows, files=2)
    assert not left_over(spark, before[0])
    assert set(glob.glob(f"{root}/staged-*")) <= copies and sum(batches_of(stream, tmp_path)) == 301


def test_the_silver_lake_holds_nothing_in_memory_and_leaves_no_shuffle_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lk, "TURN", 1, raising=False)

    def lines(ts, orders):
        texts = [json.dumps({"op": "c", "ts_ms": ts, "after": {"order_id": f"o{i}", "user_id": "u", "status": "placed", "total_cents": ts}}) for i in orders]
        return spark.createDataFrame([(x,) for x in [*texts, "{bad"]], "value string")
    split, seen = lk.dedup_latest, []

    def watched(orders, *args):
        seen.append(stored_blocks(spark) - held)
        return split(orders, *args)
    monkeypatch.setattr(lk, "dedup_latest", watched)
    lake = lk.SilverLake(spark, str(tmp_path / "lake"), "salt", buckets=3)
    before, held = shuffle_files(spark), stored_blocks(spark)
    for n, batch in enumerate((lines(1, range(30)), lines(5, range(20, 40)), lines(3, range(25)))):
        batch = batch.unionByName(batch)
        lake.sink()(batch, n)
        if n == 1:
            lake.sink()(batch, n)
    assert seen == [set()] * 4 and not left_over(spark, before)
    got = sorted((r.order_id, r.total_cents) for r in lake.read(spark).collect())
    assert got == sorted((f"o{i}", 5 if i >= 20 else 3) for i in range(40))
    assert not glob.glob(f"{spark.sparkContext.getConf().get('spark.checkpoint.dir')}/lake-batch-*")


def test_topics_are_dealt_out_before_they_are_text(spark, sf, plan):
    text = plan(tb.order_lines(spark, sf, 5))
    below = text[text.index("RoundRobinPartitioning(5)"):]
    assert "StructsToJson" in text and "StructsToJson" not in below
    assert sorted(tb.order_lines(spark, sf, 5).collect()) == sorted(tb.order_lines(spark, sf).collect())


def test_an_early_topic_has_the_same_lines_and_files(spark, sf, tmp_path, monkeypatch):
    monkeypatch.setattr(pl, "ROWS_PER_FILE", 100, raising=False)
    plain, early = str(tmp_path / "plain"), str(tmp_path / "early")
    assert pl.topic(spark, sf, plain, 3) == pl.topic(spark, sf, early, 3, early=True)
    assert len(glob.glob(f"{early}/part-*.lz4")) == len(glob.glob(f"{plain}/part-*.lz4"))
    assert sorted(spark.read.text(early).collect()) == sorted(spark.read.text(plain).collect())
