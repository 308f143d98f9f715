"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every result is computed whole and discarded (the noop sink). A query is run twice and the
better time counts; `rows_per_sec` relates source rows to it.
"""

from __future__ import annotations

import json
import os
import time

from tidemark.plans import catalog
from tidemark.session import local_session

# Query and the table whose rows it processes.
HEADLINE = {
    "batch_totals_after_watermark": "orders",
    "scan_where": "orders",
    "coerce_auto": "lineitem",
    "coercion_audit": "lineitem",
    "assign_surrogate_key": "orders",
    "load_append": "orders",
    "load_merge_orders": "orders",
    "load_merge_partitioned": "events",
    "load_merge_delta": "customer",
    "load_reporting_wide": "orders",
    "load_selected_tables": "lineitem",
    "merge_dedup_batch": "orders",
    "incr_append_run": "events",
    "incr_merge_run": "events",
    "stream_incremental_append": "events",
    "scd2_build": "events",
    "scd2_build_sliced": "events",
    "scd2_apply": "events",
    "scd2_check_overlap": "events",
    "scd2_overlap_pairs": "events",
    "fact_join_as_of": "events",
    "fact_join_as_of_lookup": "events",
    "fact_join_current": "events",
    "compare_values": "orders",
    "compare_by_checksum": "orders",
    "compare_sample": "orders",
    "verify_primary_key": "lineitem",
    "verify_summary": "orders",
    "reconcile_batches": "orders",
    "column_profile": "orders",
    "load_outcomes": "events",
    "generate_batch": "orders",
}
RUNS = 2


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, "tidemark-bench")
    runs = catalog.queries()
    rows = {
        table: spark.read.parquet(f"{folder}/{table}.parquet").count() for table in sorted(set(HEADLINE.values()))
    }
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        times = []
        for _ in range(RUNS):
            begun = time.monotonic()
            runs[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.monotonic() - begun)
        seconds[name] = round(min(times), 3)
    rates = {name: round(rows[table] / seconds[name]) for name, table in HEADLINE.items()}
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cores": int(cores),
                "runs": RUNS,
                "rows_per_sec": rates,
            }
        )
    )


if __name__ == "__main__":
    main()
