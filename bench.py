"""Time the headline queries and print one JSON line.

Each query runs three times; its time is the median, so that the first run, which compiles, does not count.
The whole result is produced (a no-op sink), not just its first rows.
"""

from __future__ import annotations

import json
import os
import time
from statistics import median

from suite.queries import QUERIES
from tabsift.session import build_session

HEADLINE = [
    "duplicate_rows", "null_profile", "head_per_month", "fill_sentinel", "impute_median", "time_split",
    "hash_sample", "reconcile_scores", "quality_verdict", "spearman", "chi2_stat", "mutual_info",
    "psi_train_oot", "monthly_psi", "selected_features", "auc", "auc_continuous", "monthly_auc",
    "early_vs_latest", "score_bins", "average_precision", "quantiles_by_month", "stream_monitor",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(cpus), "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = os.environ.get("BENCH_QUERIES")
    times = {}
    for name in wanted.split(",") if wanted else HEADLINE:
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(median(runs), 3)
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": sf.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
