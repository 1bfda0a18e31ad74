"""Benchmark: wall time of the headline queries on local[BENCH_CPUS].

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3, best run counts), BENCH_SHUFFLE_PARTITIONS (default 2 x cpus), BENCH_WARMUP_DIR (default: the
sf0.001 tables next to BENCH_SF_DIR; every headline query runs there once first
so JIT and code generation are warm).  Each timed query runs to completion via
the ``noop`` sink (full execution, nothing collected to the driver).
Prints one JSON line; ``cold`` holds the first timed run of each query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from linkgraph.plans.workload import QUERIES  # noqa: E402
from linkgraph.session import local_session  # noqa: E402

HEADLINE = [
    "job_shared_key_edges",
    "job_directed_edges",
    "job_bipartite_edges",
    "graph_nodes",
    "metric_pct_change",
    "edges_from_shared_key",
    "filter_edges_by_threshold",
    "weighted_edges",
    "dedup_subset",
    "flatten_lineup",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(2 * cpus)))
    spark = local_session("linkgraph-bench", cores=cpus, shuffle_partitions=parts,
                          extra={"spark.driver.memory": "16g"})
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001"))
    if os.path.isdir(warm_dir):
        for name in HEADLINE:
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times, cold = {}, {}
    for name in HEADLINE:
        best = None
        for i in range(repeat):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i == 0:
                cold[name] = round(dt, 3)
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total_wall", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus, "cold": cold,
                      "cold_total": round(sum(cold.values()), 3)}))
    spark.stop()


if __name__ == "__main__":
    main()
