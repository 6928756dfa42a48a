"""Headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs to completion (all result rows are produced and discarded),
planning and, for storage queries, writing included.  One untimed query warms the
session up; each time is the better of $BENCH_RUNS runs.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from daybook.session import with_settings  # noqa: E402
from daybook.suite import queries  # noqa: E402

HEADLINE = [
    "monthly_trend",
    "party_outstanding",
    "party_billed",
    "cash_flow",
    "top_customers",
    "net_position",
    "ledger_statement",
    "analysis",
    "nature_mismatch",
    "validate_sales",
    "invalid_sales",
    "validate_purchases",
    "invalid_purchases",
    "validate_bank",
    "invalid_bank",
    "semi_contains",
    "match_bank_raw",
    "clean",
    "rejects",
    "check_primary_key",
    "check_foreign_key",
    "scan_csv",
    "etl_job",
    "table_group_having",
    "table_update_topn",
    "doc_upsert",
    "doc_patch",
    "doc_modify_topn",
    "doc_validate",
    "expr_arith",
    "expr_interval",
    "check_batch",
    "analysis_batches",
    "table_deep_page",
    "variant_patch",
    "variant_validate",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = (
        with_settings(SparkSession.builder.master(f"local[{cpus}]"))
        .appName("daybook-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.checkpoint.dir", os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="daybook-bench-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()

    def once(name: str) -> float:
        start = time.perf_counter()
        registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    once("monthly_trend")
    times = {name: round(min(once(name) for _ in range(runs)), 3) for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
