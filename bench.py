"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local threads, ``BENCH_RUNS``
the timed runs of each query (the median counts, after one warm-up run). Results
go to a sink that reads every row and keeps none.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

from energy_series.catalog.queries import QUERIES
from energy_series.session import session

HEADLINE = (
    "mains_15min", "mains_daily", "mains_monthly_complete", "production_hourly",
    "battery_soc_daily", "prices_ffill", "trend_table_day", "trend_home_hour",
    "trend_euro_month", "trend_totals", "price_bands_mean", "price_bands_minimum",
    "interp_counter", "historic_series", "label_delta", "balance_single", "year_month_matrix",
    "meter_translate", "carry_last_known", "compact_meter", "upsert_last_wins", "gap_islands",
    "backfill_plan", "stream_compact",
)


def run(query, spark, sf_dir: str) -> float:
    started = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or (QUERIES if os.environ.get("BENCH_ALL") else HEADLINE)
    spark = session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(QUERIES[name], spark, sf_dir)
        timed = [run(QUERIES[name], spark, sf_dir) for _ in range(runs)]
        seconds[name] = round(statistics.median(timed), 3)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf.group(1)) if sf else None,
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
