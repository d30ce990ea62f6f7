"""Plan shape of every registered query of the reference part with broadcasts disabled (the
shape at a scale where no side fits a broadcast).  Prints a markdown table.

Usage: python scripts/plan_shapes.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def shape(plan: str) -> dict:
    return {
        "shuffles": len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin|Exchange SinglePartition", plan)),
        "partial_topk": plan.count("WindowGroupLimit") // 2,
        "anti_semi": len(re.findall(r"LeftAnti|LeftSemi", plan)),
        "sort_agg": plan.count("SortAggregate"),
        "cartesian_or_nl": len(re.findall(r"CartesianProduct|BroadcastNestedLoopJoin", plan)),
        "python": len(re.findall(r"BatchEvalPython|ArrowEvalPython|PythonUDF|InPandas", plan)),
    }


def main() -> None:
    from playgraph.plans.queries import QUERIES
    from playgraph.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[4]", conf={"spark.sql.autoBroadcastJoinThreshold": "-1",
                                            "spark.sql.adaptive.enabled": "false",
                                            "spark.sql.shuffle.partitions": "8",
                                            "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    cols = ["shuffles", "partial_topk", "anti_semi", "sort_agg", "cartesian_or_nl", "python"]
    print("| query | " + " | ".join(cols) + " |")
    print("| --- | " + " | ".join("---:" for _ in cols) + " |")
    for name, q in QUERIES.items():
        plan = q(spark, sf)._jdf.queryExecution().executedPlan().toString()
        s = shape(plan)
        print(f"| `{name}` | " + " | ".join(str(s[c]) for c in cols) + " |")


if __name__ == "__main__":
    main()
