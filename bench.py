"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and three times timed; its figure is the median. The shuffle bytes are those
of one timed run, from Spark's event log.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from collections import defaultdict
from pathlib import Path

from metframe.plans.catalog import QUERIES
from metframe.session import local_session

REPEATS = 3

HEADLINE = [
    "blend_join", "blend_observations", "bin_counts", "histogram30", "source_compare", "mean_two",
    "wide_to_long", "long_to_wide", "latest_per_key", "top_n_latest", "ffill", "chrono_split",
    "differences", "arima_fit", "arima_score", "arima_css", "predict_next", "forecast_errors", "sarima_models",
    "train_models", "nearest_station_cells", "batch_run", "upsert_lww", "stream_blend", "stream_upsert",
]


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    spark.sparkContext.setJobGroup(name, name)
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def shuffled(log: str) -> dict[str, int]:
    """Shuffle bytes that the jobs of each group wrote; jobs of other threads (streams) carry no group."""
    group, written = {}, defaultdict(int)
    for file in Path(log).rglob("*"):
        for line in file.open() if file.is_file() and not file.name.endswith(".crc") else ():
            event = json.loads(line) if line.startswith('{"Event":"SparkListener') else {}
            if event.get("Event") == "SparkListenerJobStart":
                name = event.get("Properties", {}).get("spark.jobGroup.id")
                group |= {stage: name for stage in event["Stage IDs"]}
            elif event.get("Event") == "SparkListenerTaskEnd" and group.get(event["Stage ID"]):
                metrics = (event.get("Task Metrics") or {}).get("Shuffle Write Metrics", {})
                written[group[event["Stage ID"]]] += metrics.get("Shuffle Bytes Written", 0)
    return written


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    with tempfile.TemporaryDirectory(prefix="metframe-bench-") as log:
        spark = local_session("bench", cpus, settings={
            "spark.eventLog.enabled": "true", "spark.eventLog.compress": "false", "spark.eventLog.dir": f"file://{log}",
        })
        times = {}
        for name in HEADLINE:
            run(spark, name, folder)
            times[name] = round(statistics.median(run(spark, name, folder) for _ in range(REPEATS)), 3)
        spark.stop()
        written = shuffled(log)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "shuffle_bytes": {n: written[n] // (REPEATS + 1) for n in HEADLINE},
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
