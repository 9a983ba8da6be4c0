"""Benchmark: time every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each SQL query is executed to completion with the ``noop`` sink (the whole
plan runs, nothing is collected). The model block is one 5-fold
cross-validation of the three classifiers plus the best-model refit
(full settings), timed once and shared by the model
queries, as in the driver's check. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from loanlens.plans.model_queries import MODEL_QUERIES, model_report
    from loanlens.plans.queries import SQL_QUERIES
    from loanlens.session import build_session

    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                          app_name="loanlens-bench")
    # warm-up of the JVM only (not timed)
    spark.read.parquet(f"{sf_dir}/nation.parquet").write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name, fn in SQL_QUERIES.items():
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    t0 = time.perf_counter()
    model_report(spark, sf_dir)
    times["model_cv_refit"] = round(time.perf_counter() - t0, 3)
    for name, fn in MODEL_QUERIES.items():
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    sql_total = sum(times[n] for n in SQL_QUERIES)
    total = sum(times.values())
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(total, 3),
        "unit": "sec",
        "queries": times,
        "sql_queries_sec": round(sql_total, 3),
        "sf": os.path.basename(sf_dir).replace("sf", ""),
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
