"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local threads. Each query runs into a sink that
keeps nothing; a first small query starts the JVM's work so that it is not charged to any of them.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from xoutcome import build_session  # noqa: E402
from xoutcome.catalog import registered  # noqa: E402

HEADLINE = [
    "clean_events", "segment_ids", "segment_rollup", "fill_backward_forward", "entity_day_rollup_both",
    "matchup_table", "impute_target", "median_table", "calendar_fill", "rolling_cluster_hard",
    "rolling_cluster_soft", "rolling_weighted_ratio", "rolling_rate", "rolling_rate_weighted", "lag_features",
    "depth_features", "batter_features", "pitcher_features", "matchup_features", "group_size_filter",
    "null_counts", "histogram_by_event", "top_n_per_cluster", "eval_table", "fuzzy_membership", "silhouette_score",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", int(cpus), **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    runs = registered()
    sink = lambda df: df.write.format("noop").mode("overwrite").save()
    sink(runs["entity_day_rollup_pitcher"].run(spark, folder))
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        sink(runs[name].run(spark, folder))
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": folder.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
