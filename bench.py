"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (timed runs
per query after one warm-up, default 2; the median counts), BENCH_ALL=1 for every registered query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from seriesmill.plans import all_queries
from seriesmill.session import build_session

HEADLINE = [
    "s1_csv_scan",
    "p19_time_features",
    "j1_sales_with_product",
    "j3_sales_with_promotion",
    "g1_monthly_sales",
    "g1_monthly_sales_by_product",
    "g2_weekly_sales",
    "w1_lags_of_gappy_products",
    "w5_percent_changes_over_missing",
    "w6_lags_of_rows",
    "w6_lags_of_rows_in_blocks",
    "w11_ewm_of_rows",
    "w11_ewm_in_blocks",
    "w13_prepare_features",
    "w13_prepare_features_by_product",
    "w14_time_series_features",
    "w14_time_series_features_in_blocks",
    "g15_evaluate_regressor",
    "t2_folds_of_all_orders",
    "t3_fold_report",
    "t4_cv_training_mean",
    "t4_cv_linear_regression",
    "f2_ar1_parameters",
    "f2_arima_of_products",
    "f3_sarima_forecast",
    "f5_ar1_forecast",
    "f11_incremental_update",
    "f13_scored_seasonal_naive",
    "m2_subsequences",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = all_queries()
    names = sys.argv[1:] or (list(known) if os.environ.get("BENCH_ALL") else HEADLINE)
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            known[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {"metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": sf}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
