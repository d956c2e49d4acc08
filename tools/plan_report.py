"""Summarise the physical plan of every registered query into PLANS.md.

Usage: python tools/plan_report.py [sf_dir] > PLANS.md
Per query: shuffles, join strategies, aggregate kinds, window limits,
Python evaluations, and per scan the columns read and filters pushed.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from leadsmith.plans import catalog  # noqa: E402
from leadsmith.session import local_session  # noqa: E402

NODES = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition", "BroadcastExchange",
         "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "HashAggregate",
         "SortAggregate", "ObjectHashAggregate", "WindowGroupLimit", "Window", "TakeOrderedAndProject",
         "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandasWithState", "Expand"]


def summarise(plan: str) -> tuple[str, str]:
    c = Counter()
    for line in plan.splitlines():
        body = line.strip().lstrip(":+- ").strip()
        for n in NODES:
            if body.startswith(n) and not (n == "Window" and body.startswith("WindowGroupLimit")):
                c[n] += 1
                break
    ops = ", ".join(f"{k} ×{v}" if v > 1 else k for k, v in c.items())
    scans = []
    # a scan node can span lines (string literals in pushed predicates)
    for m in re.finditer(r"FileScan \w+ \[.*?ReadSchema: struct<([^>\n]*)>?", plan, re.DOTALL):
        node = m.group(0)
        loc = re.search(r"Location: \w+\([^)]*\)\[([^\],]*)", node)
        pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", node, re.DOTALL)
        table = os.path.basename(loc.group(1)).replace(".parquet", "") if loc else "?"
        # the file-scan node lists the columns it reads
        cols = re.match(r"FileScan \w+ \[([^\]]*)\]", node)
        ncols = len(cols.group(1).split(",")) if cols else len(re.findall(r"(?:^|,)\w+:", m.group(1)))
        pf = " ".join(pushed.group(1).split()) if pushed else ""
        scans.append(f"{table}: {ncols} col" + (f"; pushed {pf[:60]}" if pf else ""))
    return ops, "; ".join(dict.fromkeys(scans))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 8)
    print("# PLANS\n")
    print(f"Physical plans of the registered queries at `{sf}` (local[8], AQE on, initial plans before "
          "runtime re-optimisation), from `tools/plan_report.py`. Columns: operators in the plan; parquet "
          "scans with the number of columns read and the filters pushed into the reader.\n")
    print("| Query | Operators | Scans |")
    print("|---|---|---|")
    for name, fn in catalog.queries().items():
        try:
            plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        except Exception as e:  # report, continue
            print(f"| `{name}` | error {type(e).__name__} | |")
            continue
        ops, scans = summarise(plan)
        print(f"| `{name}` | {ops or 'scan/project only'} | {scans} |")
    spark.stop()


if __name__ == "__main__":
    main()
