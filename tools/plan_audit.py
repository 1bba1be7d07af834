"""Scan the physical plan of every registered query for shapes that do not
scale: ``Expand`` (multiple distinct aggregates), cartesian products,
nested-loop joins and single-partition exchanges. Prints one line per query
that has any, with the operator under each single-partition exchange, so it
can be checked that each is bounded (global aggregate, top-k merge, or a rank
of a small input).

    python tools/plan_audit.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from marketlake.plans.catalog import QUERIES
    from marketlake.session import build_session
    spark = build_session("local[8]", 16)
    for name, fn in QUERIES.items():
        if name.startswith(("ml_", "src_")):
            continue  # learners and file round-trips run jobs while planning
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        bad = [k for k in ("Expand", "CartesianProduct", "BroadcastNestedLoopJoin") if k in plan]
        lines = plan.split("\n")
        under = sorted({re.sub(r"[#\d\[\]=_]+|plan_id", "", lines[i + 1].strip().lstrip("+- :"))[:40]
                        for i, ln in enumerate(lines[:-1]) if "SinglePartition" in ln})
        if bad or under:
            print(f"{name}: {bad or ''} single-partition over: {under}")


if __name__ == "__main__":
    main()
