"""Times the headline queries on a local session and prints one JSON line.

``BENCH_SF_DIR`` names the folder of the tables and ``BENCH_CPUS`` the number of local cores.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from checks import all_queries
from millrace.session import local_session

HEADLINE = [
    "cdc_ts_window",
    "cdc_ts_window_where",
    "cdc_append_key",
    "extract_fields_where",
    "numeric_scale_profile",
    "schema_map",
    "sanitize_names",
    "safe_select_list",
    "classify_errors",
    "scrub_messages",
    "land_append",
    "land_truncate",
    "land_partitioned",
    "load_metrics",
    "load_incremental",
    "ledger_consolidate",
    "rerun_latest",
    "batch_summary",
    "job_report",
    "run_batch",
    "ledger_write",
    "land_evolve",
    "land_widen",
    "land_partition_overwrite",
    "log_sink",
    "select_list_text",
    "classify_errors_table",
]
REPEATS = 3


def timed(spark, query, sf_dir: str) -> float:
    """Seconds to compute every row; landings write while the query is built."""
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("OFF")
    queries = all_queries()
    seconds = {}
    for name in HEADLINE:
        timed(spark, queries[name], sf_dir)
        seconds[name] = round(statistics.median(timed(spark, queries[name], sf_dir) for _ in range(REPEATS)), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, median of warm runs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
