"""Column functions shared by the batch and streaming operators. All stay JVM-side."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# These must equal the source system's enums, word lists and thresholds.
ORDER_STATUSES = ["placed", "processing", "shipped", "delivered", "refunded", "cancelled"]
LIVE_STATUSES = ["placed", "processing", "shipped", "delivered", "refunded"]
CHANNELS = ["organic", "paid_search", "paid_social", "email", "referral"]
CURRENCIES = ["USD", "CAD", "GBP", "EUR"]
PII_COLUMNS = ["email", "user_id", "ip_address", "phone", "first_name", "last_name", "ssn"]
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
ERASED = "ERASED"
RECOMMENDATIONS = {
    "serving": {
        "high": "Send win-back offer with 20% discount immediately.",
        "medium": "Enrol in re-engagement email sequence.",
        "low": "No action needed — monitor at next 30-day review.",
    },
    "app": {
        "high": "Send win-back offer with 20% discount immediately.",
        "medium": "Enrol in 3-touch re-engagement email sequence.",
        "low": "No action needed — review at next 30-day cycle.",
    },
    "live": {
        "high": "Send win-back offer — 20% discount immediately.",
        "medium": "Enrol in 3-touch re-engagement email sequence.",
        "low": "No action needed — review at next 30-day cycle.",
    },
}
FEATURE_COLUMNS = [
    "total_orders", "avg_order_value_cents", "lifetime_value_cents", "refund_count", "active_months",
    "customer_age_days", "days_since_last_order", "refund_rate", "avg_monthly_spend",
]
# End of fixed values.


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def hash_pii(value: Column | str, salt: str) -> Column:
    """Salted SHA-256 hex digest; NULL stays NULL. There is deliberately no default salt."""
    if not salt:
        raise ValueError("a salt is required to hash personal identifiers")
    value = as_col(value)
    return F.when(value.isNotNull(), F.sha2(F.concat(F.lit(f"{salt}|"), value.cast("string")), 256))


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """Double division, NULL when the denominator is zero or NULL."""
    return F.try_divide(as_col(numerator).cast("double"), as_col(denominator).cast("double"))


def cents_to_dollars(cents: Column | str) -> Column:
    return F.round(as_col(cents) / F.lit(100.0), 2)


def assert_not_negative(value: Column | str) -> Column:
    """Negative becomes NULL; the quality suite reports it separately."""
    value = as_col(value)
    return F.when(value >= 0, value)


def _bands(value: Column, bands: list[tuple[float, object]], otherwise: object, strict: bool = False) -> Column:
    expr = None
    for bound, label in bands:
        test = value > F.lit(bound) if strict else value >= F.lit(bound)
        expr = F.when(test, F.lit(label)) if expr is None else expr.when(test, F.lit(label))
    return expr.otherwise(F.lit(otherwise))


def value_tier(total_cents: Column | str) -> Column:
    return _bands(as_col(total_cents), [(10000, "high"), (3000, "mid")], "low")


def ltv_segment(lifetime_cents: Column | str) -> Column:
    return _bands(as_col(lifetime_cents), [(50000, "high"), (10000, "mid")], "low")


def day_name(day_of_week: Column | str) -> Column:
    """Name of a 0 = Sunday based weekday number."""
    return F.get(F.array(*[F.lit(d) for d in DAY_NAMES]), as_col(day_of_week))


def churn_score(days_inactive: Column, orders: Column, avg_order_cents: Column) -> Column:
    """Recency / frequency / monetary score in [0, 1], unrounded, in double arithmetic."""
    recency = _bands(days_inactive, [(90, 1.0), (60, 0.7), (30, 0.4)], 0.1, strict=True)
    frequency = F.greatest(F.lit(0.0), F.lit(1.0) - orders.cast("double") * F.lit(0.1))
    monetary = F.when(avg_order_cents < 1000, F.lit(0.6)).when(avg_order_cents < 5000, F.lit(0.3)).otherwise(F.lit(0.1))
    return F.least(F.lit(1.0), F.lit(0.5) * recency + F.lit(0.3) * frequency + F.lit(0.2) * monetary)


def churn_tier(score: Column | str) -> Column:
    return _bands(as_col(score), [(0.7, "high"), (0.4, "medium")], "low")


def churn_recommendation(tier: Column | str, wording: str = "serving") -> Column:
    texts = RECOMMENDATIONS[wording]
    tier = as_col(tier)
    return F.when(tier == "high", texts["high"]).when(tier == "medium", texts["medium"]).otherwise(texts["low"])


def month_offset(start: Column | str, end: Column | str) -> Column:
    """Calendar months between two timestamps (month boundaries crossed)."""
    start, end = as_col(start), as_col(end)
    return ((F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start))).cast("bigint")


def dollars_text(cents: Column | str) -> Column:
    return F.format_string("$%.2f", as_col(cents) / F.lit(100.0))


def register_sql_functions(spark: SparkSession) -> None:
    """Make the three arithmetic helpers available to SQL users."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION safe_divide(n DOUBLE, d DOUBLE) RETURNS DOUBLE RETURN try_divide(n, d)")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION cents_to_dollars(c BIGINT) RETURNS DOUBLE RETURN round(c / 100.0D, 2)")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION assert_not_negative(v BIGINT) RETURNS BIGINT RETURN CASE WHEN v >= 0 THEN v END")
