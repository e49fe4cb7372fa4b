"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line of median seconds."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from quadrata.session import build_session
from quadrata.workload.all import REGISTRY

HEADLINE = (
    "annual_counts", "weighted_mean", "month_subtype", "annual_pivot", "snapshot_rollup", "reject_counters",
    "event_clean", "survey_aggregate", "text_key", "panel", "star_join", "dim_natural", "fact_lookup", "olap_rollup",
    "ranking", "yoy_change", "activity_rank", "null_report", "dq_unique", "dq_fk", "corr_matrix", "impute_median",
    "zscore", "train_eval", "dbscan_core",
)


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_median_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                "master": f"local[{cpus}]",
                "spark": spark.version,
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:] or list(HEADLINE))
