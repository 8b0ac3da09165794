"""Benchmark the headline queries; prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_REPS`` (default 3). Each query runs once to warm up,
then ``BENCH_REPS`` times; the median is reported. A run builds the query
and executes it completely into Spark's ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from spreadkit.plans import queries as Q  # noqa: E402
from spreadkit.session import local_session  # noqa: E402

HEADLINE = {
    "word_count": Q.word_count,
    "word_count_salted": Q.word_count_salted,
    "class_count": Q.class_count,
    "class_count_two_round": Q.class_count_two_round,
    "coreset": Q.coreset_lineitem,
    "diversity_mapreduce": Q.diversity_mapreduce_lineitem,
    "exact_diameter_pruned": Q.exact_diameter_pruned,
    "exact_diameter": Q.exact_diameter,
    "avg_pairwise_distance": Q.avg_pairwise_distance,
    "greedy_matching": Q.greedy_matching,
    "sampled_diameter": Q.sampled_diameter,
    "farthest_first": Q.farthest_first,
    "farthest_first_k20": Q.farthest_first_k20,
    "center_diameter": Q.center_diameter,
}


def run_once(spark, build, sf_dir: str) -> float:
    t0 = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    spark = local_session(cores=cpus, shuffle_partitions=max(8, int(cpus) if cpus.isdigit() else 8),
                          app="spreadkit-bench")
    times: dict[str, float] = {}
    for name, build in HEADLINE.items():
        run_once(spark, build, sf_dir)  # warm-up
        times[name] = round(statistics.median(run_once(spark, build, sf_dir) for _ in range(reps)), 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    spark.stop()
    match = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(match.group(1)) if match else sf_dir,
        "cpus": cpus,
        "reps": reps,
    }))


if __name__ == "__main__":
    main()
