"""Time the headline queries and print one JSON line.

Every query runs to the end over whole tables: results go to Spark's no-op sink, so all columns
of all rows are computed. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the cores,
``BENCH_QUERIES`` (comma-separated, or ``all``) the queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidemark.plans.queries import QUERIES
from tidemark.session import build_session

HEADLINE = [
    "sales_metrics_tumbling", "sales_metrics_by_minute", "return_metrics_tumbling", "return_alerts",
    "item_trends_hopping", "top_item_per_window", "true_return_rate", "sales_metrics_stream",
    "item_trends_stream", "envelope_changes", "cdc_latest_state", "cdc_upsert_stream", "row_operations",
    "fanout_reconcile", "daily_store_view", "daily_store_view_ivm", "view_from_row_images", "view_rebuild",
    "source_target_diff", "surrogate_key", "sync_profile", "key_uniqueness", "sale_amounts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false", spark__log__level="ERROR")
    QUERIES["table_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    spark.stop()
    print(json.dumps({"metric": "total_query_time", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
