"""Time the headline queries: one warm-up round, then the median of five rounds.

Reads $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS] and prints one JSON
line. Results go to Spark's no-op sink, so every row and column is computed. Each round starts
anew: lookups are measured and the fact is stored in it, timed as queries of their own
(measure_lookups, store_fact, store_fact_dirty), and so is the daily job over two load days.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from checks import queries as registered

HEADLINE = [
    "clean_streams",
    "clean_songs",
    "enrich_streams",
    "enrich_streams_sliced",
    "audit_missing_users",
    "fact_streams",
    "dim_users",
    "dim_songs",
    "genre_kpi",
    "daily_genre_kpi",
    "hourly_kpi",
    "track_summary",
    "genre_kpi_dirty",
    "hourly_kpi_dirty",
    "view_hourly_kpi",
    "daily_job_two_days",
    "stored_view_genre_kpi",
    "stored_view_hourly_kpi",
    "stored_daily_genre_kpi",
    "stored_view_track_summary",
]
# What the queries after it find done.
PREPARED = {
    "measure_lookups": lambda i: [
        i.sizes.small(x) for x in (i.users, i.songs, i.clean_users, i.clean_songs)
    ],
    "store_fact": lambda i: i.fact,
    "store_fact_dirty": lambda i: i.fact_dirty,
}
RUNS = 5


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered.all_queries()
    runs: dict[str, list[float]] = {name: [] for name in (*PREPARED, *HEADLINE)}
    for _ in range(RUNS + 1):
        registered.forget()
        inputs = registered.inputs(spark, sf_dir)
        for name, prepare in PREPARED.items():
            start = time.perf_counter()
            prepare(inputs)
            runs[name].append(time.perf_counter() - start)
        for name in HEADLINE:
            start = time.perf_counter()
            if name == "daily_job_two_days":
                registered.stored(inputs)
            else:
                queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs[name].append(time.perf_counter() - start)
    seconds = {name: round(statistics.median(times[1:]), 4) for name, times in runs.items()}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "cpus": int(cpus),
                "driver_memory": "8g",
                "events": spark.read.parquet(f"{sf_dir}/events.parquet").count(),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
