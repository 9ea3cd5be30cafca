"""Time the warehouse build and the reports; print one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the local cores. The JVM is
warmed up with a build of the smallest tables beside that folder, if there are
any; then the build is timed once, step by step. Each report is run once to warm
up and then BENCH_RUNS times; its median is reported. Results go to Spark's noop
sink, so every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from casemart.plans import catalogue, warehouse  # noqa: E402
from casemart.sources.derived import ARRIVAL  # noqa: E402

REPORTS = [
    "kpi_operational_overview",
    "kpi_department_performance",
    "kpi_monthly_trends",
    "kpi_geographic_distribution",
    "kpi_category_breakdown",
    "kpi_backlog_aging",
    "dq_audit_log",
    "drilldown_overview",
    "dash_filter_options",
    "kpi_payload_json",
    "constraint_unique",
    "constraint_fk_orphans",
    "constraint_lost_tickets",
    "clean_tickets",
    "fact_left_join",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("casemart-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    smallest = Path(folder).parent / "sf0.001"
    if smallest.exists():
        catalogue.prepare(spark, str(smallest))
    seconds: dict[str, float] = {}

    def timed(name: str, job):
        start = time.perf_counter()
        result = job()
        seconds[name] = round(time.perf_counter() - start, 3)
        return result

    raw = timed("build_land_raw", lambda: catalogue.land_tickets(spark, folder))
    scratch = catalogue.scratch_folder(spark, folder)
    house = warehouse.new_version(spark, f"{scratch}/warehouse")
    timed("build_stage", lambda: warehouse.stage(house, raw, ARRIVAL))
    timed("build_dimensions", lambda: warehouse.build_dimensions(house))
    timed("build_fact", lambda: warehouse.write_fact(house))
    catalogue.use(spark, folder, catalogue.Prepared(scratch, raw, house))

    reports = catalogue.all_queries()
    for name in REPORTS:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            reports[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
