"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query's plan is executed in full with the ``noop`` sink (every row is
produced, nothing is collected). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "binding_opportunities", "c10_snapshots", "c3_clean_snapshots", "a1_agent_performance",
    "a12_value_quantiles", "j4_row_features", "f22_f25_feature_table", "m1_monthly_features",
    "a8_probability_bands", "t2_top_opportunities", "w3_temporal_split", "v9_validation_score",
    "v16_quality_suite", "d15_monitoring_summary", "d19_daily_metrics", "m2_training_matrix",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from dealcast.session import local_session
    from dealcast.queries import REGISTRY
    spark = local_session(cpus, shuffle_partitions=max(8, int(cpus) if cpus.isdigit() else 8),
                          app="dealcast-bench")
    # untimed warm-up on the smallest tables: JVM class loading and JIT are
    # not query time
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        for name in ("c10_snapshots", "a1_agent_performance"):
            REGISTRY[name][0](spark, warm).write.format("noop").mode("overwrite").save()
    times: dict[str, float | None] = {}
    for name in (only or HEADLINE):
        fn = REGISTRY[name][0]
        t0 = time.perf_counter()
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001 - report and continue
            print(f"{name} failed: {e!s:.300}", file=sys.stderr)
            times[name] = None
    done = [v for v in times.values() if v is not None]
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(done), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "failed": [k for k, v in times.items() if v is None]}))
    spark.stop()


if __name__ == "__main__":
    main()
