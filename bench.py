"""Times the headline queries and prints one JSON line.

`value` adds up the queries that every round has timed; `with_ingest` adds the ingest, which joined later.

BENCH_SF_DIR: folder of tables (default sf0.1); BENCH_CPUS: local cores (default 8); BENCH_RUNS: timed runs after one
warm-up (default 2, median reported).
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from surveylake.bindings.queries import QUERIES, bronze
from surveylake.contract import SILVER_SCHEMA
from surveylake.fixtures import write_archives
from surveylake.operators.quality import silver_suite
from surveylake.plans import gold
from surveylake.plans.lake import refresh_lake
from surveylake.plans.silver import build_silver
from surveylake.session import build_session, scratch_path
from surveylake.sources.archives import land_archives, list_archives
from surveylake.sources.layers import read_silver, write_silver, write_table

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

# From the raw table to the result: derive, de-duplicate, type, aggregate.
END_TO_END = [f"gold_{name}" for name in gold.GOLD_TABLES] + [
    "silver_build",
    "quality_results",
    "check_duplicates",
    "weighted_total",
    "pct_of_group",
]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action: Callable[[], object]) -> float:
    action()
    seconds = []
    for _ in range(RUNS):
        start = time.perf_counter()
        action()
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def layer_actions(spark: SparkSession) -> dict[str, Callable[[], object]]:
    """The reference's own steps: bronze to a silver layer on disk, then silver to six gold tables."""
    path = scratch_path(spark, "bench-silver")
    write_silver(build_silver(bronze(spark, SF_DIR)), path)
    silver = read_silver(spark, path, SILVER_SCHEMA)

    def six_scans() -> None:
        root = scratch_path(spark, "bench-gold")
        for name in gold.GOLD_TABLES:
            write_table(gold.gold_table(silver, name), f"{root}/{name}")

    return {
        "layer_silver_write": lambda: write_silver(build_silver(bronze(spark, SF_DIR)), path + "-again"),
        "layer_gold_six_scans": six_scans,
        "layer_gold_shared_scan": lambda: gold.write_gold(spark, silver, scratch_path(spark, "bench-gold")),
        "layer_quality_suite": lambda: run(silver_suite(silver)),
    }


def ingest_actions(spark: SparkSession) -> dict[str, Callable[[], object]]:
    """Zipped drops to landed text, files with differing headers, and a lake that grows by two refreshes."""
    drops, rows = scratch_path(spark, "bench-drops"), bronze(spark, SF_DIR)
    write_archives(rows.where("v1013 != '11'"), f"{drops}/first")
    write_archives(rows.where("v1013 = '11'"), f"{drops}/second")

    def two_refreshes() -> None:
        lake = scratch_path(spark, "bench-lake")
        refresh_lake(spark, f"{drops}/first", lake)
        refresh_lake(spark, f"{drops}/*", lake)

    return {
        "ingest_landing": lambda: land_archives(list_archives(spark, f"{drops}/*"), scratch_path(spark, "bench-landed")),
        "ingest_drift_scan": lambda: run(QUERIES["scan_csv"](spark, SF_DIR)),
        "ingest_lake_two_refreshes": two_refreshes,
    }


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    actions = {name: (lambda name=name: run(QUERIES[name](spark, SF_DIR))) for name in END_TO_END}
    seconds = {name: timed(action) for name, action in (actions | layer_actions(spark)).items()}
    ingest = {name: timed(action) for name, action in ingest_actions(spark).items()}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "with_ingest": round(sum(seconds.values()) + sum(ingest.values()), 3),
                "unit": "sec",
                "queries": seconds | ingest,
                "sf": SF_DIR.rsplit("/sf", 1)[-1],
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
