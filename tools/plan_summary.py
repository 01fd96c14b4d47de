"""Summarise the executed (final adaptive) plan of every registered query.

For each query: input scans per table, shuffle exchanges, reused exchanges,
broadcast / sort-merge joins, hash / sort aggregates, windows, and whether any
Python evaluation node appears. Writes a markdown table to stdout.

    python tools/plan_summary.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from holdcast.plans import catalog  # noqa: E402
from holdcast.session import local_session  # noqa: E402

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


def summarise(plan: str) -> dict[str, object]:
    final = plan.split("== Initial Plan ==")[0]
    scans = re.findall(r"FileScan parquet .*?Location: InMemoryFileIndex\(1 paths\)\[file:[^\]]*/(\w+)\.parquet\]", final)
    return {
        "scans": ", ".join(f"{t}×{scans.count(t)}" for t in sorted(set(scans))),
        "shuffles": len([line for line in final.splitlines()
                         if "+- Exchange hashpartitioning" in line and "REPARTITION_BY_NUM" not in line]),
        "reused": final.count("ReusedExchange"),
        "bhj": final.count("BroadcastHashJoin"),
        "smj": final.count("SortMergeJoin"),
        "hash_agg": final.count("HashAggregate("),
        "sort_agg": final.count("SortAggregate("),
        "window": len(re.findall(r"\bWindow \[", final)),
        "python": any(n in final for n in PYTHON_NODES),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 16, app_name="holdcast-plans")
    cols = ["scans", "shuffles", "reused", "bhj", "smj", "hash_agg", "sort_agg", "window", "python"]
    print(f"# Executed plans at `{sf_dir}` (final adaptive plan, local[8])\n")
    print("| query | " + " | ".join(cols) + " |")
    print("| --- | " + " | ".join("---" for _ in cols) + " |")
    for name in catalog.METRICS:
        df = catalog.run(name, spark, sf_dir)
        df.collect()
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        print(f"| `{name}` | " + " | ".join(str(s[c]) for c in cols) + " |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
