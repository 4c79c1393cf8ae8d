"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import contextlib
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from tripmill.catalog import QUERIES  # noqa: E402
from tripmill.plans import monthly  # noqa: E402
from tripmill.session import build_session  # noqa: E402
from tripmill.sources import adapters, bronze  # noqa: E402
from tripmill.sources.lake import fresh_dir  # noqa: E402

HEADLINE = (
    "stg_trips",
    "silver_trip_events",
    "silver_quarantine",
    "mart_daily_demand",
    "mart_zone_performance",
    "mart_hourly_pattern",
    "daily_summary_local",
    "backfill_range",
    "fact_incremental_merge",
    "gold_month_replace",
    "run_metrics",
    "quality_gate",
    "volume_anomaly",
    "test_not_null",
    "test_unique",
    "test_relationships",
    "year_validation",
    "top_zones",
    "demand_heatmap",
    "kpi_totals",
    "stream_minute_zone",
)


def run(build, spark, sf_dir: str) -> float:
    """Seconds to compute every row and column of the result."""
    start = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


# Months that pass the gate at the benched scale; at others a month may fail it, which is work all the same.
LOADED = ("1997-11", "1997-12")


def loads(spark, sf_dir: str) -> tuple[dict[str, float], dict[str, int]]:
    """Seconds and Spark jobs of the stored path: a month's load, a two-month backfill, an export."""
    lake, exports = fresh_dir(spark, "bench-lake"), fresh_dir(spark, "bench-exports")
    bronze.write_bronze(
        adapters.trips_raw(spark, sf_dir).where(F.col("file_month").isin(*LOADED)), monthly.trips_path(lake)
    )
    adapters.zones_raw(spark, sf_dir).write.csv(monthly.zones_path(lake), header=True)
    steps = {
        "load_month": lambda: monthly.load_months(spark, lake, LOADED[:1], "bench-load"),
        "backfill_two_months": lambda: monthly.backfill(spark, lake, *LOADED, "bench-fill"),
        "export_month": lambda: monthly.export_month(spark, lake, exports, LOADED[1]),
    }
    seconds, jobs, context = {}, {}, spark.sparkContext
    for name, step in steps.items():
        context.setJobGroup(name, name)
        start = time.perf_counter()
        with contextlib.suppress(monthly.GateError):
            step()
        seconds[name] = round(time.perf_counter() - start, 3)
        jobs[name] = len(context.statusTracker().getJobIdsForGroup(name))
    return seconds, jobs


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    run(QUERIES["mart_daily_demand"], spark, sf_dir)  # start up and warm up
    seconds = {name: round(run(QUERIES[name], spark, sf_dir), 3) for name in names}
    load_seconds, load_jobs = {}, {}
    if "BENCH_QUERIES" not in os.environ:
        load_seconds, load_jobs = loads(spark, sf_dir)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "loads": load_seconds,
                "load_jobs": load_jobs,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
