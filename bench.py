"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf"}.
Every query is executed in full with the ``noop`` sink (the whole plan runs,
nothing is collected), after one warm-up query for JVM start-up.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

# headline set: the retail feature job (G3, no model fitting besides the
# 3-means segmentation), its heavy pieces, and the ingestion / pricing jobs
HEADLINE = [
    "retail_features",
    "demand_features_joined",
    "rfm_table",
    "corr_with_target",
    "regression_metrics",
    "segment_lift",
    "sessions_clean",
    "hits_clean_keep_best",
    "key_guard",
    "iqr_cap",
    "impute_mode",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from martlake.session import get_session

    spark = get_session(f"local[{cpus}]", app="martlake-bench", shuffle_partitions=cpus * 2,
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    from martlake.plans import catalog as C
    from martlake.plans import retail as P
    from martlake.sources.tables import retail

    def retail_features(spark, sf):
        return P.indexed_feature_table(retail(spark, sf), segments="kmeans")

    queries = dict(C.REGISTRY)
    queries["retail_features"] = retail_features

    def run(name):
        spark.catalog.clearCache()   # every query starts cold
        t0 = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("rfm_table")  # warm-up (JVM, code paths); not counted
    times = {name: round(run(name), 3) for name in HEADLINE}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
