"""Physical-plan inventory of every proof query (writes PLANS.md's table to stdout).

For each query: shuffles (Exchange), broadcast and sort-merge joins, hash / sort / object
aggregates, windows, sorts, Python evaluation, and whether filters reached the scan.  Queries
that write files are built (their writes run) and the plan of the final read is inspected.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starmart.session import local_session  # noqa: E402


def features(plan: str) -> dict[str, int | str]:
    def n(pat: str) -> int:
        return len(re.findall(pat, plan))
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
    return {
        "exchange": n(r"Exchange hashpartitioning|Exchange SinglePartition|Exchange rangepartitioning|Exchange RoundRobin"),
        "broadcast": n(r"BroadcastHashJoin"),
        "smj": n(r"SortMergeJoin"),
        "hash_agg": n(r"HashAggregate\("),
        "sort_agg": n(r"SortAggregate\("),
        "obj_agg": n(r"ObjectHashAggregate\("),
        "window": n(r"\bWindow "),
        "sort": n(r"\bSort \["),
        "python": n(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas"),
        "pushed": "yes" if any(p.strip() for p in pushed) else "-",
    }


def main() -> None:
    from starmart.plans import proofs

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8, extra={"spark.sql.adaptive.enabled": "false"})
    cols = ["exchange", "broadcast", "smj", "hash_agg", "sort_agg", "obj_agg", "window", "sort",
            "python", "pushed"]
    print("| query | " + " | ".join(cols) + " |")
    print("| --- | " + " | ".join("---" for _ in cols) + " |")
    for name, fn in proofs.QUERIES.items():
        df = fn(spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        f = features(plan)
        print(f"| `{name}` | " + " | ".join(str(f[c]) for c in cols) + " |", flush=True)


if __name__ == "__main__":
    main()
