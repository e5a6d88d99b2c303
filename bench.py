"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data directory, ``BENCH_CPUS`` the number of local threads,
``BENCH_QUERIES`` optionally a comma-separated choice of registered queries. Each query is
run whole into a sink that drops its rows, after one warm-up run of the same query.
"""

from __future__ import annotations

import json
import os
import time

from sediment.plans.queries import runners
from sediment.session import build_session, release_scratch

HEADLINE = (
    "gold_customer_metrics",
    "gold_customer_segments",
    "gold_sum_having",
    "gold_rule_chain",
    "gold_time_window_metrics",
    "join_chain",
    "join_orphan_counts",
    "effective_lookup",
    "merge_upsert",
    "field_mapping",
    "text_clean_documents",
    "keep_latest",
    "dedup_exact",
    "agg_conditional_sum",
    "metrics_periods",
    "dq_engine_all",
    "dq_uniqueness",
    "dq_referential",
    "an_volume",
    "an_failure_rate",
    "an_region_iqr",
    "an_group_zscore",
    "an_zscore_lineitem",
    "an_summary",
    "an_isolation_forest",
    "audit_lineage_closure",
    "layers_end_to_end",
    "stream_alerts",
)


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = runners()

    def run(name: str) -> float:
        started = time.perf_counter()
        known[name](spark, directory).write.format("noop").mode("overwrite").save()
        took = round(time.perf_counter() - started, 3)
        release_scratch(spark)
        return took

    timings = {}
    for name in names:
        run(name)
        timings[name] = run(name)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": directory.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
