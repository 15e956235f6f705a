"""Time the headline queries: median of three runs after one warm-up, results discarded.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Prints one JSON line; the value is the sum of the medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from registry import all_queries  # noqa: E402
from trackspark import build_session  # noqa: E402

HEADLINE = (
    "flag_single_detections",
    "remove_single_detections",
    "removal_stats",
    "detections_after_tagging_24h",
    "interval_join_deployments",
    "compile_detections",
    "clean_compiled_detections",
    "asof_detection_deployment",
    "combine_detections",
    "most_precise_coordinate",
    "distinct_keep_first",
    "foreign_detections_matched",
    "import_detection_files",
    "mixed_date_conversion",
    "assign_period",
    "individual_summary",
    "detection_counts_long",
    "detection_matrix_by_location",
    "receiver_activity_offset",
    "time_bins",
    "binned_timeline",
    "monthly_residency",
    "diff_by_variable",
    "anti_new_vs_old",
)
RUNS = 3


def timed(spark, run, folder) -> float:
    started = time.perf_counter()
    run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = all_queries()
    seconds = {}
    for name in HEADLINE:
        timed(spark, registered[name], folder)
        seconds[name] = round(statistics.median(timed(spark, registered[name], folder) for _ in range(RUNS)), 4)
    spark.stop()
    sf = Path(folder).name.removeprefix("sf")
    total = round(sum(seconds.values()), 4)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
