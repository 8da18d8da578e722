"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the number of cores.
Each query runs once to warm up and is then timed ``BENCH_RUNS`` times; the
median counts. Results are computed in full and discarded on the executors.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from tidemark.catalogue.queries import QUERIES
from tidemark.session import local_session

HEADLINE = [
    # clean-up
    "lenient_cast",
    "dedup_rows",
    "clean_table",
    # features
    "numeric_stats",
    "zscore_parts",
    "category_frequency",
    "category_index",
    "category_index_wide",
    "feature_matrix",
    "prepare_split_first",
    "one_hot",
    # sampling
    "balance_every_class",
    "split_hash",
    "split_exact",
    "snapshot_roundtrip",
    # ordering
    "latest_record",
    "recent_k_per_group",
    "champion_per_group",
    # drift
    "histogram_fixed",
    "psi_baseline",
    "psi_combined",
    "psi_from_profile",
    "drift_report",
    "drift_gate",
    "inject_shift",
    # quality and models
    "summary_metrics",
    "train_logistic",
    "train_forest",
    "batch_score",
    "run_and_promote",
]
# Fitting dominates these; a second run would only repeat it.
SINGLE_RUN = {n for n in HEADLINE if n.startswith("train_")} | {"run_and_promote"}


def measure(spark, folder: str, name: str, runs: int) -> float:
    def once() -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    if name in SINGLE_RUN:
        return once()
    once()
    return statistics.median(once() for _ in range(runs))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, app="bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {name: round(measure(spark, folder, name, runs), 3) for name in names}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(Path(folder).name.removeprefix("sf")),
            }
        )
    )


if __name__ == "__main__":
    main()
