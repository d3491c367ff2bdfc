"""Wall time of the headline queries: prints one JSON line.

Warm, median of the runs (``BENCH_RUNS``, two by default) into a ``noop`` sink; plan building is part of
the time. The stream and the stored passes are timed once.
"""

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from stowage.queries import QUERIES  # noqa: E402
from stowage.session import local_session  # noqa: E402

HEADLINE = [
    "path_identity", "snapshot_diff", "diff_properties", "batch_rollup", "sample_rollup", "rollup_delta",
    "version_chain", "upsert_files", "report_for_batch", "candidates", "admission", "reconcile_tasks",
    "child_jobs", "expected_outputs", "debounced_events", "event_sessions", "sample_ready", "directory_rollup",
]
ONCE = ["indexed_batches", "stream_debounce"]


def seconds(spark, name, sf_dir):
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, cores, "stowage-bench")
    spark.sparkContext.setLogLevel("ERROR")
    runs, times = int(os.environ.get("BENCH_RUNS", "2")), {}
    for name in HEADLINE:
        seconds(spark, name, sf_dir)
        times[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(runs)), 3)
    for name in ONCE:
        times[name] = round(seconds(spark, name, sf_dir), 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
