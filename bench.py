"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data, BENCH_CPUS the local cores. Stored tables are built first and timed
as ``build_*``; every query is then timed on them from planning to the last row.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from pyspark.sql import functions as F

from checks import registered
from pulsegrid.catalogue import FACTS
from pulsegrid.operators import extract
from pulsegrid.plans import refresh
from pulsegrid.plans.workspace import Workspace, workspace
from pulsegrid.schema import RECORD
from pulsegrid.sources import tables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
BUILDS = ("landing", "samples", "population", "user_days", "exceptional", "pop_agg")
HEADLINE = (
    "steps_daily", "samples_long", "extract_measure", "extract_food", "extract_sleep",
    "population_latest", "dated_pop", "hours_pop", "framed_documents",
    "daily_sum", "daily_wide_pivot", "daily_wide_joins", "hourly_zero_fill", "hourly_array",
    "raw_series_array", "hr_hourly_distinct", "sleep_nightly", "sleep_segments",
    "sleep_hour_normalised", "sleep_minute_strip", "energy_daily", "energy_history_10d",
    "energy_history_window", "trend_slice", "kpi_averages", "kpi_nutrition", "calories_long",
    "calorie_balance", "heart_kpis", "heart_points", "sleep_timeline", "meal_calories",
    "latest_sample", "full_refresh", "incremental_refresh", "stream_daily_totals",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("pulsegrid-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def run_out(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def shapes(w: Workspace) -> dict[str, float]:
    """The same work in two plan shapes, side by side."""
    documents = w.documents
    root = tables.new_path(w.spark, "bench")
    last = F.get_json_object(RECORD, "$.loaddate") >= w.events.agg(
        F.date_add(F.max("ts").cast("date"), 1).cast("string")
    ).first()[0]

    def scan_per_fact():
        for m in FACTS:
            run_out(extract.extract_metric(documents, m.fact))

    times = {
        "shape_extract_one_scan": timed(lambda: run_out(extract.samples(documents))),
        "shape_extract_scan_per_fact": timed(scan_per_fact),
        "shape_refresh_first_days": timed(
            lambda: refresh.refresh_batch(w.landing.filter(~last), 0, root, w.calendar)),
        "shape_refresh_one_more_day": timed(
            lambda: refresh.refresh_batch(w.landing.filter(last), 1, root, w.calendar)),
    }
    return times


def main() -> None:
    spark = session()
    tables.local_folder(spark)
    w = workspace(spark, SF_DIR)
    times = {f"build_{name}": timed(lambda: getattr(w, name)) for name in BUILDS}
    queries = registered.queries()
    for name in HEADLINE:
        times[name] = timed(
            lambda: queries[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        )
    times.update(shapes(w))
    print(json.dumps({
        "metric": "total_headline_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
