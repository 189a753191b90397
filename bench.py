"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillage.plans import load  # noqa: E402
from tillage.session import local_session  # noqa: E402

HEADLINE = [
    "m11_yield_by_crop",
    "m21_yield_by_crop_region",
    "m32_by_sowing_month",
    "m103_country_crop_dashboard",
    "a05_profile",
    "a06_crop_stats",
    "a09_statistical_summary",
    "a12_region_eda",
    "a22_heatmap_median",
    "p01_dashboard_filter",
    "t05_median_fill",
    "t31_recommendations",
    "v10_validation",
    "x01_correlation_matrix",
    "x07_water_response",
    "x09_histogram",
    "x12_anova",
    "j01_star_join",
    "e05_production_fact",
    "a33_season_yield",
    "o05_many_scenarios",
    "r02_frequent_itemsets",
    "l05_linear_regression",
    "l21_similar_farms",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores=cpus, memory="16g", app="tillage-bench")
    spark.sparkContext.setLogLevel("ERROR")
    jobs = load()
    jobs["m11_yield_by_crop"](spark, folder).write.format("noop").mode("overwrite").save()  # warm-up
    seconds = {}
    for key in HEADLINE:
        runs = []
        for _ in range(int(os.environ.get("BENCH_RUNS", "1"))):
            start = time.perf_counter()
            # every row and column of the result is computed, none is brought to the driver
            jobs[key](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[key] = round(sorted(runs)[len(runs) // 2], 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
