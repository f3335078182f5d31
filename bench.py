"""Benchmark the headline queries; prints ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_QUERIES (comma list, default all headline queries)."""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["split_counts", "describe", "correlation_matrix", "roc_auc", "knn_join", "lof_scores",
            "smote_counts", "lof_catalog", "process_incremental", "train_rf", "train_kernel_svm", "train_gbt", "score_batch"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    from orrery.plans.registry import QUERIES
    from orrery.session import get_session
    spark = get_session(f"local[{cpus}]", app="orrery-bench", shuffle_partitions=max(8, 2 * cpus))
    # warm the JVM (class loading, codegen caches) outside the timed region
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
