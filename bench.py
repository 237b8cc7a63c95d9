"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` is the data folder, ``BENCH_CPUS`` the number of local threads.
Each query is built and written to the no-op sink twice after one warm-up; the
mean counts. ``task_*`` are the three published tasks on cached copies of
the data, as their published times were taken; the other names are registered
queries that start from the Parquet files.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderlens.operators import rfm, segments  # noqa: E402
from orderlens.plans.queries import QUERIES, STAR  # noqa: E402
from orderlens.sources.replicate import replicate  # noqa: E402
from orderlens.sources.star import star_tables  # noqa: E402

HEADLINE = ("order_facts", "rfm_task", "ntile_task", "kmeans_segments", "customer_table",
            "segment_value", "pareto", "drill_state", "association_tests", "consistency_checks",
            "auc_exact", "roc_points")
REPEATS = 2
COPIES = (1, 7)


def run(build: Callable[[], DataFrame]) -> float:
    started = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def mean_time(build: Callable[[], DataFrame]) -> float:
    run(build)
    return round(statistics.mean(run(build) for _ in range(REPEATS)), 3)


def tasks(spark: SparkSession, folder: str, copies: int) -> dict[str, float]:
    """Join + RFM, ntile and K-Means on copies of the data, cached beforehand."""
    t = star_tables(spark, folder)
    order_ids, customer_ids = ["order_id", "customer_id"], ["customer_id", "customer_unique_id"]
    inputs = (
        (t.orders.select(*order_ids, "order_status", "order_purchase_timestamp"), order_ids),
        (t.customers.select(*customer_ids), customer_ids),
        (t.payments.select("order_id", "payment_value"), ["order_id"]))
    cached = [replicate(df, copies, ids).cache() for df, ids in inputs]
    for df in cached:
        df.count()
    # Timed before its result is cached: Spark would answer the same plan from the cache.
    times = {f"task_join_rfm_x{copies}": mean_time(lambda: rfm.rfm_task(*cached, t.delivered))}
    table = rfm.rfm_task(*cached, t.delivered).cache()
    table.count()
    times |= {
        f"task_ntile_x{copies}": mean_time(lambda: rfm.ntile_scores(table)),
        f"task_kmeans_x{copies}": mean_time(lambda: segments.kmeans_segments(table, STAR)),
    }
    for df in (*cached, table):
        df.unpersist()
    return times


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.driver.memory", "16g")
             .config("spark.sql.shuffle.partitions", cpus)
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINE
    times = {name: mean_time(lambda n=name: QUERIES[n](spark, folder)) for name in chosen}
    if not sys.argv[1:]:
        for copies in COPIES:
            times |= tasks(spark, folder, copies)
    spark.stop()
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(folder)}))


if __name__ == "__main__":
    main()
