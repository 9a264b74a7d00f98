"""Times the headline queries and prints one JSON line.

Each query runs to completion into Spark's ``noop`` sink. The stored tables
that later queries read are built first and timed as ``build_landed``,
``build_clean`` and ``build_star``.
"""

from __future__ import annotations

import json
import os
import time

from blotterflow.registry import inputs
from blotterflow.registry.queries import QUERIES
from blotterflow.session import build_session

HEADLINE = (
    "candidate_dates",
    "first_seen",
    "block_incidents",
    "flat_incidents",
    "pick_form",
    "page_incidents",
    "report_page_incidents",
    "list_items",
    "deterministic",
    "guarded",
    "source_counts",
    "pending_limit",
    "norm_dates",
    "idempotent_insert",
    "upsert_incidents",
    "replace_dates",
    "dim_date",
    "daily_summary",
    "check_suite",
    "incident_detail",
    "search",
    "headline",
    "daily_trend",
    "calendar_effect",
    "by_zone",
    "zone_category_grid",
    "weekday_profile",
    "filter_options",
    "explorer",
)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "blotterflow-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark.read.parquet(f"{sf}/orders.parquet").count()  # start the executors
    seconds = {
        "build_landed": timed(lambda: inputs.landed(spark, sf)),
        "build_clean": timed(lambda: inputs.clean_tables(spark, sf)),
        "build_star": timed(lambda: inputs.star(spark, sf)),
    }
    for name in names:
        seconds[name] = timed(
            lambda: QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        )
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf.rstrip("/").rsplit("/", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
