"""Time the build at one scale factor and print one JSON line.

The raw tables are first landed as Bronze (not timed). Then each Silver table
(classification, contract, three writes), each Gold table and the whole build from CSV
are run once to warm up and `BENCH_RUNS` times (5) for the median. Job counts and shuffled
bytes come from Spark's event log of the last run.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time
from collections.abc import Callable
from datetime import datetime

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.fixtures import bronze_table  # noqa: E402
from checks.queries import Tables, write_raw_csv  # noqa: E402
from sluice.config import BRONZE, GOLD, TABLES, table_path  # noqa: E402
from sluice.plans import gold  # noqa: E402
from sluice.plans.build import run  # noqa: E402
from sluice.plans.silver import build_silver  # noqa: E402
from sluice.session import build_session  # noqa: E402
from sluice.sources.staging import Staging  # noqa: E402
from sluice.sources.store import load_silver, write_parquet  # noqa: E402
from sluice.sources.warehouse import unpublish  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
NOW = datetime(2024, 1, 1)


windows: dict[str, tuple[float, float]] = {}


def median_seconds(name: str, job: Callable[[], object]) -> float:
    times = []
    for _ in range(RUNS + 1):  # the first run warms up
        start, clock = time.perf_counter(), time.time()
        job()
        times.append(time.perf_counter() - start)
        windows[name] = (clock * 1000, time.time() * 1000)
    return round(statistics.median(times[1:]), 3)


def work_done(log_dir: str) -> dict[str, dict[str, float]]:
    """Jobs and shuffled megabytes by name, from the events within its last run."""
    jobs, shuffled = [], []
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if os.path.isdir(path) or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as file:
            for line in file:
                event = json.loads(line)
                if event["Event"] == "SparkListenerJobStart":
                    jobs.append(event["Submission Time"])
                elif event["Event"] == "SparkListenerTaskEnd" and event.get("Task Metrics"):
                    written = event["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"]
                    shuffled.append((event["Task Info"]["Finish Time"], written))
    return {
        name: {
            "jobs": sum(start <= at <= end for at in jobs),
            "shuffle_mb": round(sum(n for at, n in shuffled if start <= at <= end) / 2**20, 2),
        }
        for name, (start, end) in windows.items()
    }


def main() -> None:
    log_dir = tempfile.mkdtemp(prefix="sluice-bench-")
    spark = build_session(
        "sluice-bench",
        spark__eventLog__enabled="true",
        spark__eventLog__dir=f"file://{log_dir}",
        spark__eventLog__compress="false",
        master=f"local[{CPUS}]",
        spark__driver__memory="16g",
        spark__sql__shuffle__partitions=CPUS,
    )
    spark.sparkContext.setLogLevel("ERROR")
    results: dict[str, float] = {}
    with Staging(spark) as staging:
        root = staging.new_path("root")
        for name in TABLES:
            bronze = bronze_table(spark, SF_DIR, name).repartition(int(CPUS))
            write_parquet(bronze, table_path(root, BRONZE, name))
        for name in TABLES:
            results[f"silver_{name}"] = median_seconds(
                f"silver_{name}", lambda name=name: build_silver(spark, root, name, staging, NOW)
            )
        s = load_silver(spark, root)
        orders, items = s["orders"], s["order_items"]
        builders = {
            "gold_sales_by_state": lambda: gold.build_sales_by_state(orders, items, s["customers"]),
            "gold_product_performance": lambda: gold.build_product_performance(
                orders, items, s["products"], s["reviews"]
            ),
            "gold_customer_segments": lambda: gold.build_customer_segments(
                orders, items, s["customers"], staging
            ),
            "gold_monthly_kpis": lambda: gold.build_monthly_kpis(orders, items, s["reviews"]),
        }
        for name, build in builders.items():
            path = table_path(root, GOLD, name)
            results[name] = median_seconds(name, lambda build=build, path=path: write_parquet(build(), path))

        tables = Tables(spark, SF_DIR)
        csv_root = staging.new_path("root")
        for name in TABLES:
            write_raw_csv(tables, csv_root, name)
        results["full_build"] = median_seconds(
            "full_build", lambda: run(spark, csv_root, NOW, "sluice_bench_")
        )
        unpublish(spark, "sluice_bench_")
    spark.stop()  # closes the event log
    print(
        json.dumps(
            {
                "metric": "median seconds of the full build",
                "value": results["full_build"],
                "unit": "sec",
                "queries": results,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "work": work_done(log_dir),
            }
        )
    )


if __name__ == "__main__":
    main()
