"""Times the headline queries and prints one JSON line.

Each query is run once to warm up and then five times; the median counts.
"""

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

import querybook

HEADLINE = [
    "catalogue_latest",
    "title_search",
    "recent_items",
    "centroid_topk",
    "centroid_values",
    "stop_phrase_filter",
    "text_normalised",
    "sentence_cap",
    "meta_fallback",
    "chunk_table",
    "extractive_summary",
    "centroid_summary",
]
RUNS = 5


def _session(cores: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def _seconds(spark: SparkSession, folder: str, run) -> float:
    start = time.perf_counter()
    run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = _session(cores)
    spark.sparkContext.setLogLevel("ERROR")
    runs = querybook.queries()
    timings = {}
    for name in names:
        _seconds(spark, folder, runs[name])
        timings[name] = round(statistics.median(_seconds(spark, folder, runs[name]) for _ in range(RUNS)), 4)
    version = spark.version
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total of median query times",
                "value": round(sum(timings.values()), 4),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cores": cores,
                "spark": version,
            }
        )
    )


if __name__ == "__main__":
    main()
