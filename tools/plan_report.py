"""Physical-plan summary of every registered query (writes PLANS.md).

usage: python tools/plan_report.py [sf_dir]
Counts exchanges, join strategies, Python nodes and scans in each query's executed plan, so regressions in the
plan shape (an extra shuffle, a lost broadcast, a cartesian product) show up in review.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from recheck.plans import registry  # noqa: E402
from recheck.session import build_session  # noqa: E402

NODES = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition", "BroadcastExchange",
         "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct",
         "MapInPandas", "BatchEvalPython", "ArrowEvalPython", "Window", "FileScan parquet", "Scan ExistingRDD"]


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    registry.load_all()
    rows = []
    for name, fn in registry.QUERIES.items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        counts = {n: len(re.findall(re.escape(n), plan)) for n in NODES}
        rows.append((name, counts))
    short = {"Exchange hashpartitioning": "hash xchg", "Exchange rangepartitioning": "range xchg",
             "Exchange SinglePartition": "single xchg", "BroadcastExchange": "bcast xchg",
             "BroadcastHashJoin": "BHJ", "SortMergeJoin": "SMJ", "ShuffledHashJoin": "SHJ",
             "BroadcastNestedLoopJoin": "BNLJ", "CartesianProduct": "cartesian", "MapInPandas": "mapInPandas",
             "BatchEvalPython": "row UDF", "ArrowEvalPython": "pandas UDF", "Window": "window",
             "FileScan parquet": "parquet scans", "Scan ExistingRDD": "checkpoint scans"}
    out = ["# Plan shapes", "", f"Executed plans (before AQE re-planning) of every registered query at `{sf_dir}`, "
           "generated by `tools/plan_report.py`. Checkpointed inputs show up as `checkpoint scans`; a query that "
           "checkpoints has already run those jobs when its plan is taken.", "",
           "| query | " + " | ".join(short[n] for n in NODES) + " |", "|" + " --- |" * (len(NODES) + 1)]
    for name, c in rows:
        out.append(f"| {name} | " + " | ".join(str(c[n]) for n in NODES) + " |")
    tot = {n: sum(c[n] for _, c in rows) for n in NODES}
    out += ["", f"Totals: cartesian products {tot['CartesianProduct']}, nested-loop joins "
                f"{tot['BroadcastNestedLoopJoin']}, row-at-a-time Python UDFs {tot['BatchEvalPython']}, "
                f"single-partition exchanges {tot['Exchange SinglePartition']} (the final merge of global aggregates "
                "such as totals and per-column counts: each partition sends one partially aggregated row)."]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out) + "\n")
    print("\n".join(out[-1:]))


if __name__ == "__main__":
    main()
