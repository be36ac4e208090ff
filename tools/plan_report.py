"""Write PLANS.md: for every registered query outside llm, the final (post-AQE) physical
plan at a scale factor and a one-line summary of its shuffles, joins,
partial aggregates, pushed filters and Python nodes.

usage: python tools/plan_report.py [sf_dir] [out.md]
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from quarry.plans.registry import QUERIES  # noqa: E402
from quarry.session import local_session  # noqa: E402


def final_plan(p: str) -> str:
    """The final-plan part of an adaptive plan string, control characters escaped."""
    p = p.split("== Initial Plan ==")[0]
    return re.sub(r"[\x00-\x08\x0b-\x1f]", lambda m: f"\\x{ord(m.group()):02x}", p)


def summarize(p: str) -> dict[str, str]:
    p = final_plan(p)
    shuffles = {
        "hash": len(re.findall(r"Exchange hashpartitioning", p)),
        "range": len(re.findall(r"Exchange rangepartitioning", p)),
        "single": len(re.findall(r"Exchange SinglePartition", p)),
        "round-robin": len(re.findall(r"Exchange RoundRobinPartitioning", p)),
        "broadcast": len(re.findall(r"BroadcastExchange", p)),
    }
    joins = sorted(set(
        f"{kind} {how}" for kind, how in re.findall(
            r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin)[^\n]*?"
            r"\b(Inner|LeftOuter|LeftSemi|LeftAnti|RightOuter|FullOuter|Cross)\b", p)
    ))
    pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]+)\]", p)))
    python = sorted(set(re.findall(r"(MapInPandas|MapInArrow|ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas)", p)))
    return {
        "shuffles": ", ".join(f"{k} {v}" for k, v in shuffles.items() if v) or "none",
        "joins": ", ".join(joins) or "-",
        "partial agg": "yes" if "partial_" in p or re.search(r"HashAggregate\(keys=.*functions=\[\]", p) else "-",
        "pushed filters": "; ".join(pushed) or "-",
        "python": ", ".join(python) or "-",
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    out = Path(sys.argv[2] if len(sys.argv) > 2 else Path(__file__).resolve().parents[1] / "PLANS.md")
    spark = local_session("8", 16, app="quarry-plans")
    spark.sparkContext.setLogLevel("ERROR")
    rows, trees = [], []
    for name, q in QUERIES.items():
        df = q(spark, sf_dir)
        qe = df._jdf.queryExecution()
        qe.executedPlan().executeCollect()  # run it so AQE settles the final plan
        p = qe.executedPlan().toString()
        s = summarize(p)
        rows.append(f"| `{name}` | {s['shuffles']} | {s['joins']} | {s['partial agg']} | {s['pushed filters']} | {s['python']} |")
        trees.append(f"### {name}\n\n```\n{final_plan(p).strip()}\n```\n")
    head = (
        f"# Physical plans\n\nFinal plans (after AQE) of every registered query outside `llm` at `{sf_dir}`, "
        "local[8], 16 shuffle partitions, written by `tools/plan_report.py`. Shuffle counts: hash / "
        "range (sort) / single-partition / round-robin exchanges and broadcasts. Queries that materialise an "
        "intermediate (row index, CSV, table, stream) show the plan that reads it back.\n\n"
        "| query | shuffles | joins | partial agg | pushed filters | python |\n| --- | --- | --- | --- | --- | --- |\n"
    )
    out.write_text(head + "\n".join(rows) + "\n\n## Plans\n\n" + "\n".join(trees))
    spark.stop()
    print(f"wrote {out}")


if __name__ == "__main__":
    main()
