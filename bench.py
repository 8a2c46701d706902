"""Time the headline queries: one warm-up, then the median of the repeats, as one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tidewatch.session import build_session  # noqa: E402
from workload import QUERIES  # noqa: E402

HEADLINE = [
    "drift_report",
    "psi_numeric",
    "ks_two_sample",
    "windowed_drift",
    "validate_contract",
    "quarantine_rows",
    "stratified_split",
    "classification_metrics",
    "champion_vs_challenger",
    "attach_feedback",
    "live_performance",
    "recent_window",
    "time_holdout",
    "registry_list",
    "promotion_gate",
    "debounce",
    "histogram_quantile",
    "alert_states",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(repeats + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total_headline_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
