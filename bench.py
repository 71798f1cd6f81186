"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  folder of the input tables (default /root/testdata/sf0.1)
BENCH_CPUS    local threads (default 8)
BENCH_QUERIES comma separated names, or "all"
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "helper_token_balances_adjusted",
    "current_supplies_by_tokenimpl",
    "current_supplies_by_network",
    "current_reserves_by_tokenimpl",
    "current_by_tokenimpl",
    "historical_supplies_by_network",
    "historical_supplies_by_tokenproject",
    "historical_supplies_by_tokenimpl",
    "top_gainers_by_tokenimpl",
    "top_gainers_by_tokenimpl_absolute",
    "current_prices",
    "staking_outputs",
    "staking_outputs_onepass",
    "asof_block",
    "rank_global",
    "decode_observations",
    "upsert_token_balances",
    "finalize_day",
)
RUNS = 3


def main() -> None:
    from registry.queries import QUERIES
    from satlake import fixtures
    from satlake.session import get_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if wanted == "all" else [n for n in wanted.split(",") if n] or list(HEADLINE)

    spark = get_session(
        "satlake-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    # The domain tables are inputs at rest; writing them is timed on its own.
    start = time.perf_counter()
    fixtures.stage(spark, sf_dir)
    fixtures.stage_chain(spark, sf_dir)
    staging = time.perf_counter() - start

    timings: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        # The first run warms up the compiled code.
        timings[name] = round(statistics.median(runs[1:]), 3)

    found = re.search(r"sf([0-9.]+)$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "sum_of_median_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(found.group(1)) if found else sf_dir,
                "cpus": int(cpus),
                "staging_sec": round(staging, 3),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
