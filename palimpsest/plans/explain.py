"""Print the final (AQE) physical plans of registered queries as Markdown.

Usage: ``python -m palimpsest.plans.explain [sf_dir] [name ...] > PLANS.md``
"""

from __future__ import annotations

import re
import sys

from ..session import local_session
from .registry import all_queries

DEFAULT = ["training_table", "attrition_report", "result_fields", "no_op_guard", "request_batches", "arm_outputs",
           "label_mask_template", "size_ladder"]


NODE = re.compile(r"^[\s:|]*(\+- )?[A-Z*(]")


def final_plan(df) -> str:
    """Run the DataFrame's own query execution, then return its final adaptive plan."""
    qe = df._jdf.queryExecution()
    qe.toRdd().count()
    return qe.executedPlan().toString()


def node_lines(plan: str, width: int = 180) -> list[str]:
    """Plan node lines only (literals with newlines would otherwise split nodes)."""
    return [ln[:width] for ln in plan.splitlines() if NODE.match(ln)]


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    names = argv[1:] or DEFAULT
    spark = local_session(8)
    queries = all_queries()
    print(f"# Physical plans (final AQE plans at `{sf_dir}`, local[8])\n")
    print("Generated by `python -m palimpsest.plans.explain`. Scans show pruned `ReadSchema`s and pushed")
    print("filters; checkpointed steps (distributed scans, packing rounds) appear as `Scan ExistingRDD`.\n")
    for name in names:
        fn, _ = queries[name]
        df = fn(spark, sf_dir)
        plan = final_plan(df)
        plan = re.sub(r"#\d+L?", "", plan)
        lines = node_lines(plan)
        print(f"## {name}\n\n{(fn.__doc__ or '').strip().splitlines()[0]}\n\n```")
        print("\n".join(lines[:150]))
        print("```\n")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
