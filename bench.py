"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is built and fully executed into Spark's ``noop`` sink (every row
computed, nothing shipped to the driver).  One warm-up pass of the flagship
first; then every query three times, the median wall time per query (plan
building, stage checkpoints and execution included).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))  # warm, median of 3 per query

HEADLINE = [
    "M13_next_event_target",
    "F1_recent_years",
    "A8_describe",
    "M5_rare_merge_per_entity",
    "M15_group_median_impute",
    "W3_rolling_mean",
    "W3b_rolling_mean_global",
    "W4_fill_backward",
    "Q2_windows_per_game",
    "Q3_multichannel_windows",
    "Q5_chronological_split",
    "L4_scored_table",
    "E4_classification_report",
    "E7_entity_metrics",
    "S6_metrics_json",
    "L2_logistic_regression",
    "L7_grid_search",
    "M12_standard_scale",
    "U2_union_distinct_labels",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from evseq.plans.catalog import QUERIES
    from evseq.session import local_session

    spark = local_session(cpus=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    names = [n for n in HEADLINE if n in QUERIES]
    QUERIES[names[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    for name in names:
        runs = []
        for _ in range(REPEATS):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir).replace("sf", "")
    out = {
        "metric": "headline_queries_total_wall",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
