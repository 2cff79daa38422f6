"""Time the catalogue on ``$BENCH_SF_DIR`` and print one line of JSON.

Every query runs once to warm up and then ``$BENCH_RUNS`` times; the best time
counts. Batch results go to Spark's ``noop`` sink, so that every row is computed
and none is collected. A stream query is timed from its start to its last
commit, its result read back included.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from tickloom.plans.catalogue import catalogue  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))
# The literal modes and the SQL texts run the plans of queries that are timed anyway, and these two read another
# table of a run that is timed.
SAME_RUNS = ("one_pass_raw", "late_rows")
HEADLINE = [name for name in catalogue() if not name.endswith("_literal") and not name.startswith("sql_") and name not in SAME_RUNS]


def session() -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def run(spark: SparkSession, name: str) -> float:
    start = time.perf_counter()
    catalogue()[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINE
    times = {}
    for name in chosen:
        runs = [run(spark, name) for _ in range(1 + RUNS)]
        times[name] = round(min(runs[1:]), 3)
        print(f"{name}: {[round(seconds, 2) for seconds in runs]}", file=sys.stderr)
    rows = spark.read.parquet(f"{FOLDER}/events.parquet").count()
    report = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": FOLDER.rstrip("/").rsplit("sf", 1)[-1],
        "input_rows": rows,
        "cpus": int(CPUS),
    }
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
