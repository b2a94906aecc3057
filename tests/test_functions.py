import hashlib

import pytest
from pyspark.sql import functions as F

from orderlake import functions as fn


def one(spark, expr, **values):
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) else 'double' if isinstance(v, float) else 'bigint'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(expr.alias("x")).first()["x"]


def test_hash_is_salted_sha256_and_null_stays_null(spark):
    df = spark.createDataFrame([("u1",), (None,)], "u string").select(fn.hash_pii("u", "s").alias("h")).collect()
    assert df[0]["h"] == hashlib.sha256(b"s|u1").hexdigest()
    assert len(df[0]["h"]) == 64
    assert df[1]["h"] is None


def test_salts_give_different_hashes(spark):
    assert one(spark, fn.hash_pii("u", "a"), u="x") != one(spark, fn.hash_pii("u", "b"), u="x")


def test_salt_is_required():
    with pytest.raises(ValueError):
        fn.hash_pii(F.lit("u"), "")


@pytest.mark.parametrize("cents,tier", [(0, "low"), (2999, "low"), (3000, "mid"), (9999, "mid"), (10000, "high")])
def test_value_tier(spark, cents, tier):
    assert one(spark, fn.value_tier("c"), c=cents) == tier


@pytest.mark.parametrize("cents,tier", [(9999, "low"), (10000, "mid"), (49999, "mid"), (50000, "high")])
def test_ltv(spark, cents, tier):
    assert one(spark, fn.ltv_segment("c"), c=cents) == tier


def expected_score(days, orders, aov):
    r = 1.0 if days > 90 else 0.7 if days > 60 else 0.4 if days > 30 else 0.1
    m = 0.6 if aov < 1000 else 0.3 if aov < 5000 else 0.1
    return min(1.0, 0.5 * r + 0.3 * max(0.0, 1.0 - orders * 0.1) + 0.2 * m)


@pytest.mark.parametrize("days", [0, 30, 31, 60, 61, 90, 91])
@pytest.mark.parametrize("orders,aov", [(0, 999), (1, 1000), (10, 4999), (11, 5000)])
def test_churn_score_boundaries(spark, days, orders, aov):
    got = one(spark, fn.churn_score(F.col("d"), F.col("o"), F.col("a")), d=days, o=orders, a=aov)
    assert got == pytest.approx(expected_score(days, orders, aov), abs=1e-12)


def test_churn_tier_and_text(spark):
    assert one(spark, fn.churn_tier("s"), s=0.7) == "high"
    assert one(spark, fn.churn_tier("s"), s=0.4) == "medium"
    assert one(spark, fn.churn_tier("s"), s=0.39) == "low"
    assert "20% discount" in one(spark, fn.churn_recommendation("t"), t="high")


def test_arithmetic_helpers(spark):
    assert one(spark, fn.safe_divide("a", "b"), a=1, b=0) is None
    assert one(spark, fn.safe_divide("a", "b"), a=1, b=4) == 0.25
    assert one(spark, fn.cents_to_dollars("a"), a=1999) == 19.99
    assert one(spark, fn.assert_not_negative("a"), a=-1) is None
    assert one(spark, fn.assert_not_negative("a"), a=0) == 0


def test_sql_functions(spark):
    fn.register_sql_functions(spark)
    row = spark.sql("SELECT safe_divide(1, 0) a, cents_to_dollars(150) b, assert_not_negative(-3) c").first()
    assert (row.a, row.b, row.c) == (None, 1.5, None)


def test_month_offset_counts_boundaries(spark):
    got = spark.sql("SELECT timestamp'2024-01-31' a, timestamp'2024-02-01' b, timestamp'2025-01-01' c").select(
        fn.month_offset("a", "b").alias("x"), fn.month_offset("a", "c").alias("y")).first()
    assert (got.x, got.y) == (1, 12)


def test_day_names(spark):
    got = spark.sql("SELECT timestamp'2024-04-28' t").select(fn.day_name(F.dayofweek("t") - 1).alias("n")).first()["n"]
    assert got == "Sunday"
