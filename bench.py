"""Time the headline queries: each is written out in full, the median of three runs counts.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8),
``BENCH_RUNS`` (default 3). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from truegrain.plans.catalog import QUERIES
from truegrain.session import build_session

HEADLINE = (
    "completeness",
    "missing_by_column",
    "validity_by_column",
    "accuracy_by_column",
    "accuracy_reference_antijoin",
    "rule_violations",
    "consistency_ship_order",
    "uniqueness",
    "timeliness",
    "duplicate_rows_first",
    "scorecard_transactions",
    "scorecard_orders",
    "scorecard_by_group",
    "zscore_flags",
    "iqr_flags",
    "iqr_bounds",
    "quarantine_clean",
    "clean_strings",
    "dedup_orders",
    "transform_counts",
    "expectation_summary",
    "contract_check",
    "gate_results",
    "medallion_gold",
    "rolling_avg_score",
    "trend_summary",
    "dimension_trend",
    "freshness_check",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "truegrain-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="truegrain-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
