"""Summarise the executed physical plan of each registered query: shuffles,
join strategies, aggregate kinds, scans with pushed filters.

    python scripts/plan_summary.py [data_dir] [query ...]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tessera.plans import catalog  # noqa: E402
from tessera.session import build_session  # noqa: E402


def summary(plan: str) -> dict:
    return {
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "joins": sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)[^\n]*?(Inner|LeftSemi|LeftAnti|LeftOuter|FullOuter|RightOuter)", plan))),
        "aggregates": sorted(set(re.findall(r"(HashAggregate|SortAggregate|ObjectHashAggregate)", plan))),
        "windows": plan.count("Window ["),
        "pushed": sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", plan)) - {""}),
    }


def main():
    args = sys.argv[1:]
    d = args[0] if args else "/root/testdata/sf0.1"
    names = args[1:] or list(catalog.QUERIES)
    spark = build_session("local[8]", shuffle_partitions=16)
    for n in names:
        df = catalog.QUERIES[n](spark, d)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(n, summary(plan), flush=True)


if __name__ == "__main__":
    main()
