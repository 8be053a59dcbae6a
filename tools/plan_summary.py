"""Count the operators that matter at scale in each registered query's
executed (final, adaptive) plan: shuffles, reused exchanges, broadcasts,
sort-based aggregates, Python nodes.  Prints a Markdown table.

usage: python tools/plan_summary.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def final_lines(plan: str) -> list[str]:
    """Lines of the executed plan without any "Initial Plan" block (adaptive
    plans of the query and of each sub-query carry one)."""
    out, skip_deeper_than = [], None
    for ln in plan.splitlines():
        indent = len(ln) - len(ln.lstrip(" :|"))
        if skip_deeper_than is not None:
            if indent > skip_deeper_than:
                continue
            skip_deeper_than = None
        if "== Initial Plan ==" in ln:
            skip_deeper_than = indent
            continue
        out.append(ln)
    return out


def summarise(plan: str) -> dict:
    lines = final_lines(plan)

    def count(pattern):
        return sum(1 for ln in lines if re.search(pattern, ln))

    return {
        "shuffles": count(r"\+- Exchange hashpartitioning|\+- Exchange rangepartitioning|\+- Exchange SinglePartition"),
        "reused": count(r"ReusedExchange"),
        "broadcasts": count(r"BroadcastExchange"),
        "sort_aggs": count(r"SortAggregate\(") // 2,
        "python": count(r"EvalPython|InPandas|InArrow"),
        "skew_joins": count(r"isSkewJoin=true|skew=true"),
    }


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from tessera import jobs
    from tessera.session import local_session

    spark = local_session(8, shuffle_partitions=16)
    print("| query | shuffles | reused exchanges | broadcasts | sort-based aggregates | Python nodes |")
    print("| --- | --- | --- | --- | --- | --- |")
    for name in sorted(jobs.QUERIES):
        df = jobs.QUERIES[name](spark, sf)
        df.collect()
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        print(f"| `{name}` | {s['shuffles']} | {s['reused']} | {s['broadcasts']} | {s['sort_aggs']} | {s['python']} |",
              flush=True)


if __name__ == "__main__":
    main()
