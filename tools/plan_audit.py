"""Print a one-line physical-plan summary per registered query.

usage: python tools/plan_audit.py [--sf DIR] [name ...]

Per query: shuffle exchanges, broadcast exchanges, scans and the column count
each scan reads, plus operators worth a look (cartesian / nested-loop joins,
Python evaluation, windows, sort-based aggregates, generators).
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from linkgraph.plans.workload import QUERIES  # noqa: E402
from linkgraph.session import local_session  # noqa: E402

WATCH = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
         "Window", "SortAggregate", "Generate")
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def summary(plan: str) -> dict:
    return {
        "exchanges": len(re.findall(r"Exchange (hashpartitioning|SinglePartition|rangepartitioning|RoundRobin)", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "scans": len(re.findall(r"FileScan \w+", plan)),
        "flags": [w for w in WATCH if w in plan],
    }


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    spark = local_session("plan-audit", cores=8, shuffle_partitions=16)
    for name in a.names or list(QUERIES):
        s = summary(plan_text(QUERIES[name](spark, a.sf)))
        print(f"{name:28s} exch={s['exchanges']:2d} bcast={s['broadcasts']} scans={s['scans']:2d} {s['flags']}")


if __name__ == "__main__":
    main()
