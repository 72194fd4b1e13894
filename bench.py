"""Timings of the jobs and reports; prints one JSON line.

The jobs run once, from tab-separated files (written beforehand, not timed) to new folders.
Reports follow a fixed protocol: one warm-up count over the table, then the middle of three
runs each.
"""

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from playbill import fixed_values as V
from playbill.operators import marts, quality
from playbill.plans.pipeline import build_lake, load_serving
from playbill.plans.reports import REPORTS, report
from playbill.session import fresh_path
from playbill.sinks import write_by_genre, write_leaderboard
from playbill.sources import read_serving
from testbed.catalog_fixture import AS_OF_YEAR, raw_frames, write_delimited



def timed(action):
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def median_of_three(action):
    return statistics.median(timed(action) for _ in range(3))


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    raw, lake, table_path, rollup, board, genres = (
        fresh_path(spark, f"bench-{name}")
        for name in ("raw", "lake", "serving", "rollup", "leaderboard", "by-genre")
    )
    files = (V.TITLES_FILE, V.RATINGS_FILE, V.EPISODES_FILE)
    for frame, name in zip(raw_frames(spark, sf_dir), files):
        write_delimited(frame.repartition(int(cpus)), f"{raw}/{name}")

    times = {"job_lake": timed(lambda: build_lake(spark, raw, lake, AS_OF_YEAR))}
    times["job_load"] = timed(lambda: load_serving(spark, lake, table_path, rollup))
    table = read_serving(spark, table_path)
    times["job_leaderboard"] = timed(lambda: write_leaderboard(marts.top_rated(table), board))
    times["job_by_genre"] = timed(lambda: write_by_genre(marts.titles_by_genre(table), genres))

    table.count()
    for name in REPORTS:
        times[name] = median_of_three(lambda: report(name, table).collect())
    rules = quality.title_rules(AS_OF_YEAR)
    checks = {
        "prf_summary": lambda: quality.summary(table).collect(),
        "prf_types": lambda: quality.type_summary(table).collect(),
        "dq_served": lambda: quality.quality_report(table, rules).collect(),
    }
    for name, action in checks.items():
        times[name] = median_of_three(action)

    line = {
        "metric": "total wall time of jobs and reports",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {name: round(seconds, 4) for name, seconds in times.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
