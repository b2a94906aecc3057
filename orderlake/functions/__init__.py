from orderlake.functions.columns import (
    assert_not_negative,
    FEATURE_COLUMNS,
    CHANNELS,
    CURRENCIES,
    ERASED,
    LIVE_STATUSES,
    ORDER_STATUSES,
    PII_COLUMNS,
    churn_recommendation,
    churn_score,
    churn_tier,
    cents_to_dollars,
    day_name,
    hash_pii,
    ltv_segment,
    month_offset,
    register_sql_functions,
    safe_divide,
    value_tier,
)

__all__ = [
    "CHANNELS", "CURRENCIES", "ERASED", "LIVE_STATUSES", "ORDER_STATUSES", "PII_COLUMNS", "cents_to_dollars",
    "churn_recommendation", "churn_score", "churn_tier", "day_name", "hash_pii", "ltv_segment", "month_offset",
    "assert_not_negative", "FEATURE_COLUMNS", "register_sql_functions", "safe_divide", "value_tier",
]
