"""Time the headline queries and print one JSON line.

Each query is run to completion into the ``noop`` sink (every row is produced,
none is collected).  A first untimed run of one small query starts the JVM.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from wattloom.registry import QUERIES  # noqa: E402
from wattloom.session import local_session  # noqa: E402

HEADLINE = (
    "annual_share_fanout",
    "hourly_shape",
    "hourly_profiles",
    "disaggregate_annual",
    "disaggregate_hourly",
    "whatif_map_kinds",
    "calibrated_hourly",
    "reconcile_enduse",
    "monthly_peak",
    "winter_share_top100",
    "day_profiles",
    "wide_hourly",
    "wide_annual",
    "weighted_split",
    "split_conservation",
    "stock_counts",
    "flatten_scenario",
    "res_annual_catalogue",
    "res_hourly_catalogue",
    "com_hourly_catalogue",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench", os.environ.get("BENCH_MEMORY", "16g"))
    QUERIES["annual_share_literal"](spark, folder).write.format("noop").mode(
        "overwrite"
    ).save()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
