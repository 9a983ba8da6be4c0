"""Write the formatted physical plan of every registered SQL query to a folder.

Usage: python scripts/explain_plans.py <sf_dir> <out_dir>
Prints, per query, the join strategies and exchanges found in the plan.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

KINDS = ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
         "CartesianProduct", "Exchange", "WindowGroupLimit", "Window", "Generate")


def main(sf_dir: str, out_dir: str) -> None:
    from loanlens.plans.queries import SQL_QUERIES
    from loanlens.session import build_session

    spark = build_session("local[8]")
    os.makedirs(out_dir, exist_ok=True)
    for name, fn in SQL_QUERIES.items():
        df = fn(spark, sf_dir)
        plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        with open(os.path.join(out_dir, f"{name}.txt"), "w") as fh:
            fh.write(plan)
        tree = plan.split("\n\n")[0]
        counts = {k: len(re.findall(rf"\b{k}\b", tree)) for k in KINDS}
        print(name, {k: v for k, v in counts.items() if v})


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2])
