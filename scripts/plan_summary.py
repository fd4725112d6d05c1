"""Physical-plan summary of every registered query (-> PLANS.md).

Usage: python scripts/plan_summary.py [sf_dir] > PLANS.md
Counts the operators that matter at scale in each query's physical plan
(before AQE re-plans at run time): shuffles, join strategies, windows,
aggregates, Python evaluation, scans with pushed filters.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tablepipe.plans import catalog  # noqa: E402
from tablepipe.session import local_session  # noqa: E402

OPS = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
       "Exchange RoundRobinPartitioning", "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin",
       "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "Window", "HashAggregate",
       "ObjectHashAggregate", "SortAggregate", "TakeOrderedAndProject", "MapInPandas", "ArrowEvalPython",
       "BatchEvalPython", "Generate", "Scan parquet", "Scan csv", "Scan ExistingRDD"]
SHORT = {"Exchange hashpartitioning": "hash shuffle", "Exchange rangepartitioning": "range shuffle",
         "Exchange SinglePartition": "to one task (global agg of partials)",
         "Exchange RoundRobinPartitioning": "round-robin", "BroadcastExchange": "broadcast",
         "BroadcastHashJoin": "BHJ", "SortMergeJoin": "SMJ", "ShuffledHashJoin": "SHJ",
         "BroadcastNestedLoopJoin": "BNLJ", "CartesianProduct": "cartesian", "Window": "window",
         "HashAggregate": "hash agg", "ObjectHashAggregate": "object agg", "SortAggregate": "sort agg",
         "TakeOrderedAndProject": "top-k", "MapInPandas": "mapInPandas", "ArrowEvalPython": "pandas UDF",
         "BatchEvalPython": "python UDF", "Generate": "generate", "Scan parquet": "parquet scan",
         "Scan csv": "csv scan", "Scan ExistingRDD": "local rows"}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    print(f"# PLANS\n\nPhysical plans of the registered queries at `{sf_dir}` (generated by "
          "`scripts/plan_summary.py`; counts of operators before AQE re-plans at run time).\n")
    print("| query | operators | pushed filters |\n| --- | --- | --- |")
    for name, fn in catalog.QUERIES.items():
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts = Counter()
        for op in OPS:
            counts[op] = len(re.findall(re.escape(op) + r"\b", plan))
        parts = [f"{SHORT[o]} ×{c}" for o, c in counts.items() if c]
        pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]+)\]", plan)))
        print(f"| `{name}` | {', '.join(parts)} | {'; '.join(p[:80] for p in pushed) or '—'} |")
    spark.stop()


if __name__ == "__main__":
    main()
