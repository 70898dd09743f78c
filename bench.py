"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores. Each query runs
once to warm up and then three times; its time is the median from building the plan to the
last row produced (results go to a sink that discards them).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallybook.plans.registry import QUERIES  # noqa: E402
from tallybook.session import build_session  # noqa: E402

HEADLINE = [
    "q1", "q2", "q3", "q4", "q5", "tx_running_revenue", "asof_fx", "normalize_clean", "industry_daily",
    "quarantine_log", "kpis", "tx_detail", "promote_transactions",
]
#: Timed once each: they write a store, so most of their time is files and jobs.
STORED = ["append_expenses", "run_transform_industry", "stream_normalize", "normalization_stats", "ml_kmeans_crosstab", "kpis_stored"]
RUNS = 3


def main() -> None:
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            # Plan building records no Python call sites.
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in HEADLINE:
        runs = []
        for _ in range(RUNS + 1):
            begin = time.perf_counter()
            QUERIES[name].run(spark, path).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - begin)
        times[name] = round(statistics.median(runs[1:]), 3)
    stored: dict[str, float] = {}
    for name in STORED:
        begin = time.perf_counter()
        QUERIES[name].run(spark, path).write.format("noop").mode("overwrite").save()
        stored[name] = round(time.perf_counter() - begin, 3)
    line = {
        "metric": "total of median query times",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "stored": stored,
        "sf": Path(path).name.removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
