"""Inspect the physical plan of every registered query.

Reports, per query: shuffles (Exchange), broadcast joins, sort-merge joins,
Python stages, and fails on a cartesian product or nested-loop join (no
registered query may form all pairs). Usage: python tools/plan_check.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from surgecast.plans import catalog  # noqa: E402
from surgecast.session import get_session  # noqa: E402

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]")
    bad = 0
    print("| query | exchanges | broadcast joins | sort-merge joins | python stages | pushed filters |")
    print("|---|---|---|---|---|---|")
    for name, q in catalog.registry().items():
        p = plan_text(q.fn(spark, sf))
        hits = [f for f in FORBIDDEN if f in p]
        bad += bool(hits)
        py = len(re.findall(r"FlatMapGroupsInPandas|MapInPandas|ArrowEvalPython|FlatMapGroupsInPandasWithState", p))
        pushed = len(re.findall(r"PushedFilters: \[[^\]]+\]", p))
        print(f"| {name} | {p.count('Exchange ')} | {p.count('BroadcastHashJoin')} | {p.count('SortMergeJoin')} | {py} | "
              f"{pushed} |" + (f" FORBIDDEN {hits}" if hits else ""))
    print(f"\n{bad} queries with forbidden joins")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
