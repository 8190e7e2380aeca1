"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of local threads, ``BENCH_RUNS`` the
timed runs per query after one warm-up (the median is reported). ``warehouse_build`` is the whole load:
staging, dimensions, fact. The KPI queries read the star it leaves behind.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starmill.registry import QUERIES  # noqa: E402
from starmill.registry import context  # noqa: E402
from starmill.session import build_session  # noqa: E402

HEADLINE = [
    "stg_incremental_filter", "stg_extract_customer", "stg_extract_product", "stg_lookup_one_per_key",
    "dim_surrogate_keys", "scd1_merge_customer", "scd1_dim_product", "scd1_dim_salesperson",
    "fact_load", "fact_idempotent_load", "fact_datekey_range",
    "kpi_totals", "kpi_avg_ticket", "kpi_monthly_with_mean", "kpi_salesperson_rank", "kpi_yoy_growth",
    "kpi_sliced", "mart_territory_category", "oltp_territory_category",
    "scd2_history", "scd2_incremental", "scd2_point_in_time_join",
    "audit_monitor", "dq_fact_orphans", "dq_fact_reconciliation", "stream_scd1_merge",
]


def timed(action) -> float:
    begin = time.perf_counter()
    action()
    return time.perf_counter() - begin


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")

    seconds = {"warehouse_build": timed(lambda: context.loaded_warehouse(spark, folder))}
    for name in HEADLINE:
        def run():
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        run()
        seconds[name] = statistics.median(timed(run) for _ in range(runs))
    print(json.dumps({
        "metric": "median query seconds, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": {name: round(value, 3) for name, value in seconds.items()},
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
