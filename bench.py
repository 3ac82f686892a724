"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the cores (default 8).
All queries run once to warm up and then in BENCH_RUNS rounds (default 3); the median of the rounds
counts, plan building included. Results are written to a sink that discards them, so all rows are
computed and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from quotemart.checks.queries import QUERIES
from quotemart.session import build_session

HEADLINE = [
    "fact_stock_daily",
    "bars_dedup_first",
    "dim_date",
    "dim_company",
    "dim_exchange",
    "dim_industry",
    "bars_key_fallback",
    "price_trend_by_bar",
    "exchanges_first_wins",
    "resolve_company_rows",
    "companies_insert_update",
    "upsert_regions",
    "dims_scd2",
    "fact_replace_days",
    "surrogate_keys",
    "latest_snapshot",
    "quality_foreign_keys",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, list[float]] = {name: [] for name in HEADLINE}
    for _ in range(runs + 1):
        for name in HEADLINE:
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name].append(time.perf_counter() - start)
    seconds = {name: round(statistics.median(took[1:]), 3) for name, took in times.items()}
    for name, took in times.items():
        print(f"{name:28} cold {took[0]:7.3f}  warm {seconds[name]:7.3f}", file=sys.stderr)
    scale = Path(folder).name.removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {"metric": "headline_queries_warm_total", "value": total, "unit": "sec", "queries": seconds, "sf": float(scale)}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
