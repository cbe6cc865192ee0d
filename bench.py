"""Time the headline queries: one JSON line on stdout.

Tables come from ``$BENCH_SF_DIR``, cores from ``$BENCH_CPUS``. Every query computes all its rows
into a sink that stores nothing. ``BENCH_QUERIES`` (comma-separated) picks others.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from folioflow.catalog import QUERIES
from folioflow.session import local_session

HEADLINE = [
    "reconcile_guides", "reconcile_guides_all", "reconcile_counters", "reconcile_invoices", "work_list", "guide_keys",
    "oldest_files", "distinct_arrivals", "record_attributes", "record_lookup", "record_labels", "guide_outcomes",
    "guide_rows", "records_arrived", "registered_check", "registry_after_batch", "invoice_headers", "invoice_lines",
    "invoices_to_register", "failed_attempts", "quarantine", "error_log", "alert_buffer", "alert_batches",
    "alert_categories", "source_status", "heartbeats", "stream_failed_attempts", "stream_alert_batches",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session(cores, "folioflow-bench")
    QUERIES["guide_keys"](spark, folder).write.format("noop").mode("overwrite").save()  # start-up is not measured
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    scale = re.search(r"sf([\d.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "total seconds of all headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else folder,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
