"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` is the data directory and ``BENCH_CPUS`` the number of local cores.
Every query is written to the no-op sink, so all rows and columns are computed and
none pass through the driver.  All are run once to warm the JVM, then once for the
clock.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from workload import QUERIES

HEADLINES = (
    "incremental_append_a1",
    "exclude_logged_a2",
    "history_backfill_a7",
    "attach_time_b1",
    "select_new_b3",
    "enrich_card_b5",
    "subscription_flag_b6",
    "card_feed_b7",
    "card_feed_detailed_b7",
    "customer_feed_c6",
    "tuple_hash_d4",
    "merchant_upsert_d5",
    "hold_debit_e1",
    "quarantine_feed_e5",
    "change_upsert_f5",
    "match_unambiguous_g3",
    "address_history_i5",
    "proxy_mapping_h8",
    "dd_eligible_h10",
    "dd_feed_h15",
    "flag_error_runs_j3",
    "error_summary_j4",
)


def session(cpus: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cardloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )


def seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINES
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        seconds(spark, name, sf_dir)
    times = {name: round(seconds(spark, name, sf_dir), 3) for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total warm seconds of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
