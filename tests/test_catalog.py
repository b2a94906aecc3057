"""Every registered query against its SQL on the smallest supplied tables."""

import os

import duckdb
import pytest

from orderlake.plans import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
SLOW = {"train_churn", "score_churn", "forecast_product_demand", "forecast_demand", "write_forecast"}


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


def text(value):
    if value is None or value != value:
        return "null"
    return f"{value:.9g}" if isinstance(value, float) else str(value)


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(text(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, SF)
    rel = db.sql(ORACLES[name])
    assert table(df.columns, df.collect()) == table(rel.columns, rel.fetchall())


def test_only_iterative_queries_lack_sql():
    assert set(QUERIES) - set(ORACLES) == SLOW


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries
    assert entry(spark).count() > 0
    assert set(oracle_sql()) <= set(queries())
