"""Write the physical plan trees of the headline queries to docs/PLANS.md.

usage: python tools/dump_plans.py [--sf DIR]
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from linkgraph.plans.workload import QUERIES  # noqa: E402
from linkgraph.session import local_session  # noqa: E402


def tree(df) -> str:
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    head = text.split("\n\n\n")[0]
    return head.strip()


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    a = ap.parse_args()
    spark = local_session("dump-plans", cores=8, shuffle_partitions=16)
    out = ["# Physical plans of the headline queries", "",
           f"`explain(\"formatted\")` trees at {os.path.basename(a.sf)}, local[8], 16 shuffle partitions, AQE on",
           "(initial plans; AQE may still coalesce partitions or switch a join to broadcast when a side",
           "measures small at run time). Regenerate with `python tools/dump_plans.py`.", ""]
    for name in HEADLINE:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "10485760")
        local = tree(QUERIES[name](spark, a.sf))
        # large inputs: no side is small enough for an automatic broadcast (the only
        # broadcast left is the explicitly size-bounded hot-key table)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        large = tree(QUERIES[name](spark, a.sf))
        out += [f"## {name}", "", "As planned here:", "", "```", local, "```", "",
                "As planned for large inputs (automatic broadcasts off):", "", "```", large, "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
