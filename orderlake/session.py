"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # The default type has no minima and maxima in the files, so no filter on a time could skip any of them.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

# The salt is a literal inside plans, so plan text shown in event logs and the UI is redacted.
STATIC_SETTINGS = {
    "spark.redaction.string.regex": r"(?i)salt[^|]*\|",
    "spark.sql.redaction.string.regex": r"(?i)salt[^|]*\|",
    "spark.ui.enabled": "false",
}

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(master: str | None = None, app: str = "orderlake", **conf: str) -> SparkSession:
    """Create a session; cluster sizing (shuffle partitions, memory) comes from ``conf`` or the cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **STATIC_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Inside, a query's shuffle files go when the query ends; otherwise they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings every operator relies on to a session somebody else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if is_local(spark) and spark.conf.get("spark.sql.shuffle.partitions") == "200":
        spark.conf.set("spark.sql.shuffle.partitions", str(max(8, spark.sparkContext.defaultParallelism)))
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder named by the cluster in ``spark.checkpoint.dir``.

    Only a local master, where driver and executors share one machine, may fall back to a temporary folder.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="orderlake-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, never reused between runs."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex}"
