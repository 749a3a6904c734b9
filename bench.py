"""Time the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import time

from riskmart.session import build_session, with_shared_folder

HEADLINE = [
    "default_rate", "label_store", "silver_loan_daily", "silver_financials", "silver_clickstream", "days_past_due", "dq_shared_ids",
    "feature_base_join", "feature_store", "pit_clickstream", "run_summary", "labelled_as_of", "time_split", "roc_auc", "roc_curve",
    "cutoff_summary", "exact_quantiles", "feature_csi", "score_psi", "promotion_gate", "production_routing", "stability_slot",
    "performance_metrics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = with_shared_folder(build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g", spark__log__level="ERROR",
    ))
    from riskmart.plans import catalog

    queries = catalog.all_queries()
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    seconds = {}
    for name in names:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline queries, total of best runs", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(found.group(1).rstrip(".")) if found else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
