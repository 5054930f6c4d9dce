"""Time the headline queries, or those named, with their output fully consumed, after one warm-up run.

Prints one JSON line; ``all`` times every registered query.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from batchloom.plans.queries import QUERIES

# The queries whose times are added up.
HEADLINE = [
    "daily_customer_summary",
    "daily_product_summary",
    "monthly_customer_summary",
    "monthly_product_summary",
    "orderdetails_load",
    "dw_orders",
    "customer_history_scd2",
    "merge_upsert",
    "first_payment_rank",
    "star_join_order_value",
]


# Timed as well, but not added up: whole batches, bound by the number of small jobs at this size.
BATCHES = ["run_two_batches"]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("batchloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


def timed(spark: SparkSession, sf_dir: str, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = list(QUERIES) if sys.argv[1:] == ["all"] else sys.argv[1:] or [*HEADLINE, *BATCHES]
    spark = session(cpus)
    seconds = {}
    timed(spark, sf_dir, names[0])
    for name in names:
        seconds[name] = round(timed(spark, sf_dir, name), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    total = sum(seconds[n] for n in HEADLINE if n in seconds)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(total, 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
