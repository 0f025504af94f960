"""Print the executed physical plan (operator tree) of key registered
queries, with counts of exchanges, broadcasts and window-group limits.

usage: python tools/plans.py [sf_dir] [query ...]  > PLANS.md
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from demandlake.plans.catalog import QUERIES  # noqa: E402
from demandlake.session import get_session  # noqa: E402

KEY = ["gold_features", "feature_psi", "latest_run_per_role", "active_run_lookup", "severe_drift",
       "model_versions", "eval_window", "sales_facts_fixture"]


def tree(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or KEY
    spark = get_session("plans")
    from demandlake.plans import fixtures
    print(f"# Executed physical plans ({sf}, local session)\n")
    for n in names:
        df = fixtures.sales_facts(spark, sf) if n == "sales_facts_fixture" else QUERIES[n](spark, sf)
        t = tree(df)
        counts = {k: len(re.findall(k, t)) for k in
                  ["Exchange hashpartitioning", "Exchange SinglePartition", "BroadcastExchange", "WindowGroupLimit",
                   "SortMergeJoin", "BroadcastHashJoin", "CartesianProduct", "BroadcastNestedLoopJoin",
                   "HashAggregate", "SortAggregate", "ObjectHashAggregate", "TakeOrderedAndProject"]}
        pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", t)))
        print(f"## {n}\n")
        print("Counts: " + ", ".join(f"{k}={v}" for k, v in counts.items() if v) + "\n")
        if pushed:
            print("Pushed filters: " + "; ".join(p for p in pushed if p) + "\n")
        print("```")
        for line in t.splitlines():
            line = re.sub(r"#\d+L?", "", line)
            print(line[:220])
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
