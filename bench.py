"""Time the headline queries: one warm-up, then the median of three runs, results
forced with the noop sink. Prints one JSON line.

Environment: BENCH_SF_DIR (data folder), BENCH_CPUS (local cores).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HEADLINE = [
    "mart_bureau_features",
    "mart_credit_card_balance",
    "mart_pos_cash_balance",
    "mart_previous_application",
    "pos_loan_level",
    "bureau_balance_agg",
    "cc_dynamic_avg",
    "customer_segments",
    "payment_discipline",
    "months_distribution",
    "status_patterns",
    "key_overlap",
    "card_profile",
    "training_set_join",
    "cdc_flatten",
    "current_status",
    "feature_ready",
    "online_features",
    "target_correlation",
    "categorical_deviation",
    "clip_quantiles",
    "metric_auc",
    "threshold_sweep",
    "ensemble_rank",
]
RUNS = 3


def main() -> None:
    from riskloom.plans import catalog
    from riskloom.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, shuffle_partitions=cores)
    queries, seconds = catalog.queries(), {}
    for name in sys.argv[1:] or HEADLINE:
        taken = []
        for _ in range(1 + RUNS):
            began = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
