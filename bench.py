"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then three times (once if slow) into a no-op sink; the median is reported. Streaming queries run once (a
run always processes its whole source) and are also given as events per second.
"""

from __future__ import annotations

import contextlib
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderlake.plans import QUERIES  # noqa: E402
from orderlake.session import build_session  # noqa: E402

BATCH = [
    "stg_orders", "fact_orders", "orders_enriched", "daily_revenue", "user_cohorts", "user_features", "churn_training_features", "materialize_features",
    "product_daily_demand", "revenue_by_channel", "kpi_summary", "recent_orders", "order_dimensions", "parse_cdc_orders", "silver_orders", "transform_metrics",
    "sessionize", "scd2_users", "scd2_point_in_time", "asof_features", "incremental_append_dedup", "running_user_state", "live_churn_score",
    "trailing_revenue", "cooldown_alerts", "latency_ewma", "dq_orders_suite", "agg_reconciles", "volume_anomaly", "erase_match",
]
STREAMS = ["stream_validate_enrich", "stream_user_state", "stream_kpis", "stream_dedup", "stream_sessionize"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", "bench", **{
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8", "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    rates: dict[str, float] = {}

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    with contextlib.redirect_stdout(sys.stderr):
        events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
        for name in BATCH:
            runs = 3 if once(name) < 5 else 1
            times[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        for name in STREAMS:
            times[name] = round(once(name), 3)
            rates[name] = round(events / times[name])
    print(json.dumps({
        "metric": "total seconds of headline queries", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "events_per_second": rates, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": cpus, "spark": spark.version}))


if __name__ == "__main__":
    main()
