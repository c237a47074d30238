"""Time the headline queries: prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (names, default
headline list, "all" for every registered query), BENCH_RUNS (default 3; the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.session import build_session  # noqa: E402
from millrace.workload import load  # noqa: E402

HEADLINE = [
    "daily_transform", "newest_line_per_key", "event_history_features", "size_checked_join", "salted_supplier_join",
    "hot_key_salted_join", "preaggregated_event_join", "daily_summary", "daily_failure_rate", "null_rates_one_pass",
    "quality_suite", "nearest_to_label_centroids", "passages_in_documents", "adherence", "adherence_timeline",
    "drug_interactions", "supplier_settlement", "loyalty_spend", "basket_pairs", "message_errors", "dispenses",
    "till_sales", "audited_statements", "reused_answers", "repeated_actions", "five_minute_windows",
]


def run(query, spark, root: str) -> float:
    started = time.perf_counter()
    query(spark, root).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    queries = load()
    wanted = os.environ.get("BENCH_QUERIES", "").replace(",", " ").split() or HEADLINE
    names = list(queries) if wanted == ["all"] else wanted
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(queries["row_count"].run, spark, root)
    seconds = {}
    for name in names:
        times = [run(queries[name].run, spark, root) for _ in range(runs)]
        seconds[name] = round(statistics.median(times), 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(root.rstrip("/")).removeprefix("sf"), "cpus": int(cpus), "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
