"""Summarise physical plans: exchanges, join strategies, aggregates, pushed filters.

usage: python tools/plan_report.py [--sf DIR] [--out DIR] [name ...]
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.1")
    ap.add_argument("--out", default=None)
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    from docket.plans import all_queries
    from docket.session import local_test_session
    spark = local_test_session()
    qs = all_queries()
    for n in a.names or sorted(qs):
        if n == "filter_page":
            continue
        df = qs[n](spark, a.sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        if a.out:
            with open(os.path.join(a.out, f"{n}.txt"), "w") as f:
                f.write(df._jdf.queryExecution().toString())
        ex = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan))
        bex = plan.count("BroadcastExchange")
        smj, bhj, shj = plan.count("SortMergeJoin"), plan.count("BroadcastHashJoin"), plan.count("ShuffledHashJoin")
        aggs = {k: plan.count(k) for k in ("HashAggregate", "ObjectHashAggregate", "SortAggregate") if plan.count(k)}
        win = plan.count("Window [") + plan.count("Window(")
        wgl = plan.count("WindowGroupLimit")
        pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
        pf = [p for p in pushed if p]
        single = "SinglePartition" in plan
        print(f"{n:28s} shuffles={ex:2d} bcast={bex} smj={smj} bhj={bhj} shj={shj} win={win} wgl={wgl} "
              f"aggs={aggs} single={single} pushed={pf[:2]}")
    spark.stop()


if __name__ == "__main__":
    main()
