"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from tidemark import build_session
from tidemark.plans import QUERIES
from tidemark.sources.tables import SCAN_PARTITIONS

HEADLINE = [
    "upsert_lineitem",
    "upsert_latest_lineitem",
    "insert_ignore_queue",
    "cascade_delete",
    "skip_existing",
    "fk_suite",
    "required_suite",
    "inventory_customer_orders",
    "density_by_segment",
    "hotspots_by_segment",
    "snapshot_diff_full",
    "queue_status_matrix",
    "apply_results",
    "completeness",
    "map_vs_extracted",
    "cost_by_type",
    "cost_stats",
    "cost_last100",
    "ema_latency",
    "running_throughput",
    "content_dedup",
    "map_clients",
    "map_jobs",
    "map_visits",
    "inline_notes",
    "extract_pass",
    "stream_upsert",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    # The tables are one row group each: without dealing, mapping them would use one core.
    conf = {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", SCAN_PARTITIONS: cpus}
    spark = build_session(f"local[{cpus}]", "bench", conf)
    spark.sparkContext.setLogLevel("OFF")
    # One untimed query, so that the first timed one does not pay for starting up.
    QUERIES["status_histogram"](spark, folder).collect()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "total wall time of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(result), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
