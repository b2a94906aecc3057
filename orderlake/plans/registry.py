"""Registry of runnable queries: name, Spark function, and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.plans.tables import with_ctes
from orderlake.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Times without zone (all are UTC), as the SQL side has them."""
    return df.select(*[F.col(f"`{c}`").cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(f"`{c}`") for c, t in df.dtypes])


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return comparable(fn(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_ctes(sql.strip())
        return fn
    return register
