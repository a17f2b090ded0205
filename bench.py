"""Benchmark: the end-to-end medallion pipeline plus the headline queries.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) and prints ONE JSON line:
{"metric": "pipeline_total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Stages mirror the reference's pipeline (Bronze->Silver, Gold, KPIs, marts,
ML, quality checks); each query result is fully materialised (collected when
small, written to the ``noop`` sink when row-level).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# row-level outputs are drained through the noop sink instead of collected
ROW_LEVEL = {"star_join_all_dims", "fact_sales", "silver_sales", "surrogate_key", "monthly_demand",
             "forecast_features", "stream_orders_bronze", "ml_customer_clusters", "ml_demand_forecast",
             "mart_product_performance", "mart_sales_rep_performance", "mart_geographic_analysis", "mart_forecast_analysis"}

HEADLINE = [
    "kpi_sales_by_channel", "kpi_sales_by_country", "kpi_top_products", "kpi_sales_by_class",
    "kpi_top_reps", "kpi_team_performance", "kpi_quarterly", "kpi_top_customers",
    "kpi_orders_summary", "kpi_hist_vs_stream", "kpi_executive_summary", "star_join_all_dims",
    "mart_product_performance", "mart_sales_rep_performance", "mart_geographic_analysis",
    "surrogate_key", "monthly_demand", "forecast_features", "mart_forecast_analysis",
    "mart_cluster_analysis", "dq_not_null", "dq_relationships", "shipment_quality_metrics",
    "stream_orders_bronze", "ml_customer_clusters", "ml_demand_forecast", "table_volumes",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from strata.session import local_session
    from strata.plans.lakehouse import Lakehouse
    from strata.plans.registry import QUERIES

    n = int(cpus) if cpus.isdigit() else 8
    # optional: BENCH_EVENT_LOG=<folder> records stage/task times for offline reading
    spark = local_session(cpus, app="strata-bench", shuffle_partitions=max(8, 2 * n),
                          event_log_dir=os.environ.get("BENCH_EVENT_LOG"))
    times: dict[str, float | None] = {}
    errors: dict[str, str] = {}

    def timed(name, fn):
        # one failing query is recorded, not fatal: the JSON line is always printed
        t0 = time.perf_counter()
        try:
            fn()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # noqa: BLE001
            times[name] = None
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"

    t_all = time.perf_counter()
    lh = Lakehouse.get(spark, sf_dir)
    timed("build_silver", lambda: (lh.silver_sales(), lh.silver_orders(), lh.silver_shipments()))
    timed("build_gold", lh.build_gold)
    for name in HEADLINE:
        df_fn = QUERIES[name]

        def run(name=name, df_fn=df_fn):
            df = df_fn(spark, sf_dir)
            if name in ROW_LEVEL:
                df.write.format("noop").mode("overwrite").save()
            else:
                df.collect()
        timed(name, run)
    total = round(time.perf_counter() - t_all, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "pipeline_total_sec", "value": total, "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
