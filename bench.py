"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   folder of test tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 4)
BENCH_RUNS     timed runs per query after one warm-up; the median counts (default 3)
BENCH_QUERIES  comma-separated names, or "all" (default: the headline list)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame

from costloom.checks.registry import load
from costloom.session import get_spark

HEADLINE = [
    "four_level_rollup",
    "ledger_pivot_sum",
    "perf_kpi_model",
    "perf_overview_all",
    "health_rates",
    "pl_normalise_budget",
    "unit_moh",
    "kpi_full_outer",
    "fx_mixed_type",
    "cost_detail",
    "cost_level1",
    "cost_gap",
    "level2_unit_cost",
    "forecast_models",
    "cost_prediction",
    "prediction_rollup",
    "alert_texts",
]


def run(df: DataFrame) -> None:
    """Compute every row and column without storing them."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    conf = {
        "spark.master": f"local[{cpus}]",
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": str(cpus),
    }
    spark = get_spark("costloom-bench", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    registry = load()
    names = list(registry) if wanted == "all" else [n for n in wanted.split(",") if n] or HEADLINE
    timings = {}
    for name in names:
        query = registry[name]
        seconds = []
        for i in range(runs + 1):
            begin = time.perf_counter()
            run(query(spark, folder))
            if i or not runs:
                seconds.append(time.perf_counter() - begin)
        timings[name] = round(statistics.median(seconds), 3)
        print(f"{name}: {timings[name]} s", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "shuffle_partitions": cpus,
                "runs": runs,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
