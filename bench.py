"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]: one JSON line."""

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from fanflow.plans.queries import QUERIES

NAMES = ("preimage_resolve", "route_counts", "conflict_resolve", "delete_keys_single", "delete_keys_composite", "apply_full", "multi_cursor_single_scan", "scan_as_of")


def main() -> None:
    sf, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    conf = {"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.sql.session.timeZone": "UTC", "spark.ui.showConsoleProgress": "false"}
    spark = SparkSession.builder.master(f"local[{cpus}]").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in NAMES:
        took = []
        for _ in range(4):
            t = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            took.append(time.perf_counter() - t)
        times[name] = round(statistics.median(took[1:]), 3)
    # One million rows to ten thousand destinations, from the events table repeated.
    from pyspark.sql import functions as F

    from fanflow.operators.routing import route_counts

    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id")
    n = events.count()
    rows = events.select(F.explode(F.sequence(F.lit(1), F.lit(max(1, 1_000_000 // n)))).alias("k"), "event_id").select(F.concat(F.lit("dest_"), F.pmod(F.xxhash64("event_id", "k"), F.lit(10_000))).alias("company"))
    values = {f"dest_{k}": f"d{k}" for k in range(10_000)}
    took = []
    for _ in range(3):
        t = time.perf_counter()
        route_counts(rows, "company", values).write.format("noop").mode("overwrite").save()
        took.append(time.perf_counter() - t)
    times["route_1m_10k"] = round(statistics.median(took[1:]), 3)
    print(json.dumps({"metric": "total warm seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
