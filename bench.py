"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data (default sf0.1), ``BENCH_CPUS`` the local threads,
``BENCH_RUNS`` the timed runs after one warm-up (their median counts), and
``BENCH_QUERIES`` a comma list or ``all``.  Results are written to the ``noop``
sink: every row is computed, none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from opslog.catalog import load
from opslog.session import build_session

HEADLINE = [
    "uvpv_hour_levels",
    "uvpv_month_parts",
    "pair_rate_user",
    "session_gauge",
    "bandwidth",
    "category_pivot",
    "concurrency_hour",
    "concurrency_overlap",
    "concurrency_minute_vector",
    "usetime_hist",
    "usetime_hist18_share",
    "probe_outcome",
    "web_outcome",
    "rate_two_level",
    "last_sample",
    "port_traffic",
    "rollup_sum_rate",
    "rollup_avg_min_max",
    "dashboard_union",
    "parse_route",
    "parse_session",
    "neighbours",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    load()[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(load()) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = build_session(
        "opslog-bench",
        f"local[{cpus}]",
        conf={
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in names:
        run_once(spark, name, sf_dir)
        timings[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(runs)), 4)
        print(f"{name}: {timings[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(timings.values()), 4),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
