"""Time the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (table folder), BENCH_CPUS (local cores), BENCH_QUERIES
(comma-separated names; default: the list below).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rankflow.plans.queries import REGISTRY  # noqa: E402
from rankflow.session import local_session  # noqa: E402

HEADLINE = [
    "parse_edges_core",
    "node_set",
    "transition_probs",
    "adjacency_all_nodes",
    "rank_standard",
    "rank_weighted",
    "rank_personalized",
    "rank_weighted_personalized",
    "rank_drop_dangling",
    "rank_history",
    "rank_scale_free",
    "top_n",
    "rank_position",
    "rank_comparison",
    "bench_summary",
    "synth_scale_free",
    "repair_dangling",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE

    began = time.perf_counter()
    spark = local_session("bench", cores)
    spark.sparkContext.setLogLevel("ERROR")
    # the first job pays for class loading; it is reported on its own
    spark.read.parquet(f"{folder}/nation.parquet").groupBy("n_regionkey").count().collect()
    startup = round(time.perf_counter() - began, 3)
    seconds = {}
    for name in names:
        start = time.perf_counter()
        REGISTRY[name].build(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    whole = round(time.perf_counter() - began, 3)
    spark.stop()
    line = {
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cores),
        "startup_sec": startup,
        "whole_process_sec": whole,
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
