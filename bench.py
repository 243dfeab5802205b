"""Times the headline queries and prints one JSON line.

Each query runs BENCH_REPEAT times (2) to a no-op sink and its best time counts, so the figure is
that of a warm session.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plumbline.plans import QUERIES  # noqa: E402
from plumbline.session import local_session  # noqa: E402

HEADLINE = [
    "typed_layer",
    "feature_layer",
    "partitioned_sink",
    "stratified_split",
    "fitted_transform",
    "reference_profile",
    "describe",
    "outliers",
    "correlation_matrix",
    "rate_by_decile",
    "quality_record",
    "score_quality",
    "metric_bundle",
    "cost_optimal_threshold",
    "cohort_quality",
    "feature_psi",
    "ks_drift",
    "wasserstein_drift",
    "counter_rate",
    "alert_states",
    "shipped_logs",
    "count_over_time",
    "line_rate",
    "point_in_time",
    "latest_features",
    "logistic_regression",
    "batch_scores",
    "log_stream",
    "tumbling_counts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINE
    spark = local_session(cpus, shuffle_partitions=cpus)
    QUERIES["imbalance"].plan(spark, sf_dir).collect()
    seconds: dict[str, float] = {}
    for name in names:
        best = None
        for _ in range(repeat):
            start = time.perf_counter()
            QUERIES[name].plan(spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_wall_time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
