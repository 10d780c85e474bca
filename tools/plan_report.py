"""Summarise the physical plan of every registered query into PLANS.md.

Usage: python tools/plan_report.py [sf_dir]   (default /root/testdata/sf0.01)

Per query: shuffles (by partitioning kind), join strategies, scans with their pruned read
schema and pushed filters, Python operators, and any plan node that would not scale
(nested-loop or cartesian joins, single-partition exchanges, collect limits).  Plans are
the initial adaptive plans; AQE may still switch a sort-merge join to broadcast at run
time.  Plan-time jobs (split histograms, size checks) run while the frames are built.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reelrec.plans.catalog import QUERIES  # noqa: E402
from reelrec.session import local_session  # noqa: E402

RISKY = ("BroadcastNestedLoopJoin", "CartesianProduct", "CollectLimit", "BatchEvalPython", "GlobalLimit")


def summarise(plan: str) -> dict:
    ex = Counter(m.group(1) for m in re.finditer(r"Exchange (\w+)partitioning", plan))
    ex["broadcast"] = len(re.findall(r"BroadcastExchange", plan))
    joins = Counter(m.group(0) for m in re.finditer(
        r"BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct", plan))
    scans = []
    for m in re.finditer(r"FileScan parquet [^\n]*", plan):
        line = m.group(0)
        loc = re.search(r"\[file:[^\]]*/([^/\]]+)\]", line)
        schema = re.search(r"ReadSchema: (struct<[^\n]*?>)(?:,|$)", line)
        pushed = re.search(r"PushedFilters: (\[[^\]]*\])", line)
        scans.append((loc.group(1) if loc else "?", schema.group(1) if schema else "?",
                      pushed.group(1) if pushed else "[]"))
    python = sorted({n for n in ("MapInPandas", "ArrowEvalPython", "FlatMapGroupsInPandas", "BatchEvalPython")
                     if n in plan})
    other = sorted({n for n in ("TakeOrderedAndProject", "Window", "WindowGroupLimit", "Generate", "Union")
                    if n in plan})
    lines = plan.splitlines()
    for k, line in enumerate(lines):        # what goes to one task, by the node below the exchange
        if "Exchange SinglePartition" not in line:
            continue
        below = next((x for x in lines[k + 1:] if not re.search(r"InputAdapter|WholeStageCodegen", x)), "")
        if "REPARTITION" in line:
            other.append("SinglePartition: one block, by its number")
        elif re.search(r"partial_|LocalLimit", below):
            other.append("SinglePartition: partial rows of a global aggregate or limit, one a task")
        else:
            other.append(f"SinglePartition: rows of {below.strip(' :+-*()0123456789')[:40]}")
    risky = sorted({n for n in RISKY if n in plan})
    return {"exchanges": dict(ex), "joins": dict(joins), "scans": scans, "python": python,
            "other": other, "risky": risky}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8, "reelrec-plans")
    out = ["# PLANS", "",
           f"Physical plans of the registered queries at `{sf_dir}` (generated by `tools/plan_report.py`).",
           "Exchanges are shuffles; scans list the file, the pruned read schema and the filters pushed",
           "into Parquet.  `risky` lists nodes that would not scale (none expected).",
           "Queries that read a table several times store it first (a Parquet table in the checkpoint",
           "folder): their plan begins at that table, and the plan that wrote it is that of its operator.",
           "The training-data queries are not listed: most of their work is done while the result is built.", ""]
    for name, fn in QUERIES.items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        out.append(f"## {name}")
        out.append("")
        out.append(f"* shuffles: {s['exchanges'] or '{}'}; joins: {s['joins'] or '{}'}")
        out.append(f"* operators: {', '.join(s['other']) or '-'}; python: {', '.join(s['python']) or 'none'}; "
                   f"risky: {', '.join(s['risky']) or 'none'}")
        for table, schema, pushed in s["scans"]:
            out.append(f"* scan `{table}` read `{schema}` pushed `{pushed}`")
        out.append("")
        print(name, s["risky"], flush=True)
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()
