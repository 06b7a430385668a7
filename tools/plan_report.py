"""Physical-plan summary of every registered query (before AQE re-planning).

Usage: python tools/plan_report.py [sf_dir] [name ...]
Counts hash shuffles, single-partition exchanges, join strategies, windows and
aggregates, and lists the filters pushed into Parquet scans.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summary(df) -> dict:
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = sorted({p for p in re.findall(r"PushedFilters: \[([^\]]+)\]", plan) if p})
    return {
        "hash_shuffles": len(re.findall(r"Exchange hashpartitioning", plan)),
        "range_shuffles": len(re.findall(r"Exchange rangepartitioning", plan)),
        "single_partition": len(re.findall(r"Exchange SinglePartition", plan)),
        "broadcast_joins": plan.count("BroadcastHashJoin"),
        "sort_merge_joins": plan.count("SortMergeJoin"),
        "nested_loop_joins": plan.count("BroadcastNestedLoopJoin"),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "python_udfs": plan.count("ArrowEvalPython") + plan.count("BatchEvalPython"),
        "pushed_filters": pushed[:4],
    }


if __name__ == "__main__":
    from almacen.queries import QUERIES
    from almacen.session import checkpoint_dir, local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8)
    checkpoint_dir(spark)
    for name in sys.argv[2:] or sorted(QUERIES):
        print(name, summary(QUERIES[name](spark, sf)), flush=True)
