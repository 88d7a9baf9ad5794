"""Benchmark: headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the ``noop`` sink (every row is
computed, nothing is collected).  After one warm-up query, each headline
query runs $BENCH_REPEAT times (default 3), with Spark's cache cleared before
each run; its time is the median, and its first run is given as ``first``.  Prints one
JSON line: {"metric", "value" (sum of medians), "unit", "queries", "sf", ...}.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "vulnerability_batch",
    "weather_cleaned",
    "co2_cleaned",
    "rule_violations_weather",
    "extreme_weather_emissions",
    "top_day_hottest_cities",
    "monthly_temp_co2",
    "monthly_daily_sample",
    "hot_cities_co2",
    "dedup_by_key",
    "spi_index",
    "impute_temps",
    "edge_has_weather",
    "json_round_trip",
    "vulnerability_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from aeris.plans.registry import QUERIES
    from aeris.session import build_session

    extra = dict(kv.split("=", 1) for kv in os.environ.get("BENCH_CONF", "").split(",") if "=" in kv)
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus, 8), app_name="aeris-bench",
                          extra=extra)

    def run(name: str) -> float:
        spark.catalog.clearCache()
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("risk_level")  # warm-up: JVM, codegen caches, file listing
    timings: dict[str, float] = {}
    first: dict[str, float] = {}
    for name in only or HEADLINE:
        samples = [run(name) for _ in range(repeat)]
        timings[name] = round(statistics.median(samples), 3)
        first[name] = round(samples[0], 3)
    sf_match = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_median",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "first": first,
        "sf": float(sf_match.group(1)) if sf_match else sf_dir,
        "cpus": cpus,
        "repeat": repeat,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
