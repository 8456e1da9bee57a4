"""Times the headline queries; prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores. Every query is run in full
into a sink that keeps nothing, once to warm up and then ``BENCH_RUNS`` times; the
best time counts. ``compared`` holds the plans the engine replaces: one scan per
column, a window over all history, one query per subscriber and agreement.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from contractcheck.functions.numbers import pct2  # noqa: E402
from contractcheck.operators import readiness  # noqa: E402
from contractcheck.operators.lookups import union_all  # noqa: E402
from contractcheck.session import local_session  # noqa: E402
from contractcheck.workload import QUERIES, logs  # noqa: E402
from contractcheck.workload.columns import LINE_COLUMNS, lines_with_gaps  # noqa: E402

HEADLINE = [
    "orders_readiness",
    "null_profile", "not_null_counts", "null_spike", "completeness_slo", "row_checks", "orders_contract_results",
    "unique_key", "unique_composite", "relationships", "relationships_lineitem", "accepted_values", "join_report",
    "cardinality_equality", "group_quantiles", "outlier_iqr", "outlier_z", "mutually_exclusive_ranges",
    "sequential_values", "schema_drift", "freshness_slo", "accuracy_recon", "latest_result", "latest_result_by_max",
    "contract_health", "ready_flag", "subscriber_readiness", "retention_keep", "run_summary", "content_changes",
    "content_hash", "upsert_contracts", "breaking_changes", "extract_contracts", "contract_columns", "contract_lint",
    "log_test_results", "enrich_contract", "staging_clean", "fx_convert", "dormant_flag",
]


def null_profile_one_scan_per_column(spark, d):
    lines = lines_with_gaps(spark, d)
    return union_all(
        [
            lines.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(c).isNull()).alias("k")).select(
                F.lit(c).alias("column_name"), pct2(F.col("k"), F.col("n")).alias("null_pct")
            )
            for c in LINE_COLUMNS
        ]
    )


def readiness_one_query_per_contract(spark, d, n=20):
    """Three logs filtered per agreement, for the first ``n`` agreements only."""
    results, slos, issues, models = logs.day_logs(spark, d)
    frames = []
    for i in range(n):
        one = F.col("contract_id") == f"c{i}"
        frames.append(
            readiness.contract_status(results.filter(one), slos.filter(one), issues, models.filter(one), logs.DAY)
        )
    return union_all(frames)


COMPARED = {
    "null_profile": null_profile_one_scan_per_column,
    "ready_flag_20_contracts": readiness_one_query_per_contract,
}


def run_once(fn, spark, d) -> float:
    start = time.perf_counter()
    fn(spark, d).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def best(fn, spark, d, runs: int) -> float:
    run_once(fn, spark, d)
    return round(min(run_once(fn, spark, d) for _ in range(runs)), 3)


def main() -> None:
    d = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    times = {n: best(QUERIES[n], spark, d, runs) for n in names}
    compared = {} if sys.argv[1:] else {n: best(fn, spark, d, 1) for n, fn in COMPARED.items()}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "compared": compared,
                "sf": os.path.basename(os.path.normpath(d)).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
