"""What the operators share with Spark: batch sizes, scratch tables, state that a Python worker keeps between tasks."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from orderlake.session import scratch

BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "8388608"}


def tuned(spark: SparkSession) -> SparkSession:
    """Small Arrow batches, so that what a Python worker holds is bounded in bytes whatever the length of the texts."""
    for key, value in BATCH.items():
        spark.conf.set(key, value)
    return spark


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back: cuts the lineage, and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, f"llm-{name}")
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def worker_state(name: str, make: Callable[[], Any], large: bool = False) -> Any:
    """One object per Python worker process, kept between its tasks (functions travel by value, their globals do not stay). A worker keeps one
    ``large`` object: the next one takes its place, and ``free_worker_state`` drops it."""
    home = sys.modules.setdefault("orderlake_worker_state", types.ModuleType("orderlake_worker_state"))
    if not hasattr(home, name):
        if large:
            free_worker_state()
            setattr(home, "large objects", (name,))
        setattr(home, name, make())
    return getattr(home, name)


def free_worker_state() -> None:
    """Drop the large object that an operator before has left in this worker; operators without one call it when a task starts."""
    home = sys.modules.get("orderlake_worker_state")
    for name in getattr(home, "large objects", ()):
        delattr(home, name)
        pa.default_memory_pool().release_unused()
    if home is not None:
        setattr(home, "large objects", ())
