"""Time the headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from clearbook.registry import load
from clearbook.session import build_session

HEADLINE = [
    "classic_final",
    "paired_final",
    "spp_hourly_point",
    "dedup_orders",
    "combined_bids",
    "merged_pairs",
    "award_order_left",
    "award_price_left",
    "common_pairs",
    "new_rows_by_interval",
    "validate_rows",
    "load_profile",
    "json_pages",
    "update_slice",
]
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        int(cpus),
        **{"spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false", "spark.log.level": "ERROR"},
    )
    queries, _ = load()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        taken = []
        for _ in range(RUNS):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        # The first run also pays for class loading and code generation.
        seconds[name] = round(statistics.median(taken[1:]), 4)
    spark.stop()
    total = round(sum(seconds.values()), 4)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
