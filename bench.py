"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR: data folder (default /root/testdata/sf0.1); BENCH_CPUS: local cores.
Each query is computed to the last row (noop sink). BENCH_RUNS (default 2) runs of each, the
best counts, so that start-up and code generation of a fresh JVM do not.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bazaarflow.session import build_session  # noqa: E402
from registry import QUERIES  # noqa: E402

HEADLINE = [
    "m1_daily_revenue",
    "m2_cohort_retention",
    "m3_seller_performance",
    "m4_fraud_patterns",
    "m4b_collusion_pairs",
    "m5_category_trends",
    "m6_live_dashboard",
    "m7_run_daily",
    "q5_suite",
    "a2_distinct_counts",
    "a6_counters",
    "a14_first_order_date",
    "w1_percent_rank",
    "w2_dense_rank",
    "w6_trailing_count",
    "k3_top_sellers",
    "k7_top_per_group",
    "u1_merge_sorted",
    "t1_velocity_alerts",
    "t2_amount_anomaly",
    "t3_allocate_stock",
    "t12_sessions",
    "v2_semantic_search",
    "v4_enriched_reviews",
    "s13_upsert_by_key",
    "g1_topo_levels",
    "g6_pair_sum",
    "t1_stream_velocity",
    "t3_stream_allocation",
]


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{root}/lineitem.parquet").selectExpr("sum(l_quantity)").collect()
    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, root).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(min(taken), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(root.rstrip("/")),
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
