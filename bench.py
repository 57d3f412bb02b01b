"""Headline timings: reconcile, rules pass, price statistics, summaries.

Runs each query to completion (noop sink: every row and column is produced) at $BENCH_SF_DIR on
local[$BENCH_CPUS] and prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from recheck.plans import registry  # noqa: E402
from recheck.session import build_session  # noqa: E402

HEADLINE = [
    "recon_pairs",          # greedy 1:1 reconciliation, exact compare (flagship)
    "recon_pairs_ci",       # database variant: every key n x m, streamed greedy
    "recon_right_only",
    "violations_all",       # all business rules in one pass with lookups
    "price_stats_per_row",
    "price_stats_by_name",
    "validation_summary",
    "issue_summary",
    "category_accuracy",
    "run_totals",
    "recon_cell_diffs",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    registry.load_all()
    # warm-up (not timed): JIT and Python workers, on the smallest scale factor when present
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    warm_dir = warm_dir if os.path.isdir(warm_dir) else sf_dir
    for name in ("rows_per_file", "recon_pairs_ci"):
        registry.QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.time()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        spark.catalog.clearCache()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
