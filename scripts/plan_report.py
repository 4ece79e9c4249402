"""Summarise the final (post-AQE) physical plans of the headline queries.

Usage: python scripts/plan_report.py [sf_dir] > PLANS.md

For every query: columns read per scan, filters pushed into Parquet,
shuffles (and how many were reused), aggregate operators by kind, windows,
joins, Python evaluation, and whether whole-stage codegen covers the plan.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from viewlog.plans.catalog import QUERIES  # noqa: E402
from viewlog.session import get_spark  # noqa: E402

OPS = ["HashAggregate", "ObjectHashAggregate", "SortAggregate", "Window", "Expand",
       "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "ArrowEvalPython", "MapInArrow",
       "TakeOrderedAndProject", "Subquery", "ReusedSubquery"]


_NODE = re.compile(r"^[\s:|]*(\+- )?(\*\(\d+\) )?([A-Z][A-Za-z]+|== )")


def _node_lines(tree: str) -> list[str]:
    """Plan lines, with expression text that contains newlines rejoined."""
    out: list[str] = []
    for line in tree.split("\n"):
        if out and not _NODE.match(line):
            out[-1] += " " + line.strip()
        else:
            out.append(line)
    return out


def final_only(tree: str) -> str:
    """Drop every "== Initial Plan ==" section (main query and subqueries)."""
    keep, skip_at = [], None
    for line in _node_lines(tree):
        depth = len(line) - len(line.lstrip(" :+-|"))
        if skip_at is not None and depth >= skip_at:
            continue
        skip_at = None
        if "== Initial Plan ==" in line:
            skip_at = depth
            continue
        keep.append(line)
    return "\n".join(keep)


def summarize(plan: str, formatted: str) -> dict:
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", formatted)
    pushed = sorted({p for p in re.findall(r"PushedFilters: \[([^\]]*)\]", formatted) if p})
    ops = Counter()
    lines = plan.split("\n")
    for op in OPS:
        # Count plan nodes (the operator name starting a tree line), not mentions.
        node = re.compile(rf"^[\s:|]*(\+- )?(\*\(\d+\) )?{op}\b")
        ops[op] = sum(1 for line in lines if node.match(line))
    return {
        "scan_columns": sorted({len(s.split(",")) for s in scans}),
        "pushed": pushed,
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)),
        "reused": len(re.findall(r"ReusedExchange", plan)),
        "ops": {k: v for k, v in ops.items() if v},
        "codegen_stages": len(set(re.findall(r"\*\((\d+)\)", plan))),
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark("local[8]", 16)
    print("# Final physical plans of the headline queries\n")
    print(f"Generated by `scripts/plan_report.py` at `{sf}` after running each query "
          "(AQE final plans). Counts include scalar subqueries.\n")
    print("| Query | Parquet columns read | Pushed filters | Shuffles (reused) | Operators | Codegen stages |")
    print("|---|---|---|---|---|---|")
    for name in [*HEADLINE, "activity_cube", "dedup_hashed"]:
        df = QUERIES[name](spark, sf)
        df.collect()  # run this DataFrame's own plan so AQE finalises it
        qe = df._jdf.queryExecution()
        final = final_only(qe.executedPlan().toString())
        s = summarize(final,
                      spark._jvm.PythonSQLUtils.explainString(qe, "formatted"))
        ops = ", ".join(f"{k}×{v}" for k, v in s["ops"].items())
        pushed = "; ".join(p[:60] for p in s["pushed"]) or "—"
        print(f"| `{name}` | {s['scan_columns']} | {pushed} | {s['shuffles']} ({s['reused']}) | {ops} | {s['codegen_stages']} |")
    spark.stop()


if __name__ == "__main__":
    main()
