"""Summarise (or print) the executed physical plans of registered queries.

usage: python tools/explain_plans.py [sf_dir] [--full key]
Without --full, writes a table of operator counts per query to stdout
(Markdown).  Plans are taken after execution (AQE final plans).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabsieve.plans import catalog  # noqa: E402
from tabsieve.session import get_spark  # noqa: E402

EAGER = {"cv_summary", "rf_predict", "predict_ordered", "redundancy_prune", "screen_report",
         "pca_components", "tfidf_hashed"}
COUNTS = [("shuffles", r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition"),
          ("bcast joins", r"BroadcastHashJoin"), ("smj", r"SortMergeJoin"),
          ("windows", r"\bWindow \["), ("aggregates", r"HashAggregate|ObjectHashAggregate|SortAggregate"),
          ("python", r"ArrowEvalPython|BatchEvalPython|MapInPandas|MapInArrow|FlatMapGroupsInArrow"),
          ("cartesian/nlj", r"CartesianProduct|BroadcastNestedLoopJoin")]


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def main() -> None:
    args = sys.argv[1:]
    sf = args[0] if args and not args[0].startswith("--") else "/root/testdata/sf0.01"
    spark = get_spark(master="local[*]", shuffle_partitions=8, driver_memory="16g")
    qs = catalog.queries()
    if "--full" in args:
        key = args[args.index("--full") + 1]
        qs[key](spark, sf).explain("formatted")
        return
    print("| query | " + " | ".join(n for n, _ in COUNTS) + " | scans (ReadSchema) |")
    print("|---|" + "---|" * (len(COUNTS) + 1))
    for key, fn in qs.items():
        if key in EAGER:
            continue
        plan = final_plan(fn(spark, sf))
        counts = [str(len(re.findall(p, plan))) for _, p in COUNTS]
        scans = sorted(set(re.findall(r"ReadSchema: struct<([^>\n]*)", plan)))
        print(f"| {key} | " + " | ".join(counts) + " | " + "; ".join(scans) + " |", flush=True)


if __name__ == "__main__":
    main()
