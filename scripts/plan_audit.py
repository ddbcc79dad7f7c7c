"""Physical-plan audit of every registered query.

    python scripts/plan_audit.py [sf_dir]

Per query: shuffle exchanges, broadcasts, single-partition exchanges,
Python evaluation nodes (should be none) and, per parquet scan, the
table and number of columns read.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.plans.registry import QUERIES  # noqa: E402
from tidemark.session import get_spark  # noqa: E402

PY_NODES = r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas|PythonUDF)"


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark()
    for name, fn in QUERIES.items():
        plan = fn(spark, sf)._jdf.queryExecution().executedPlan().toString()
        shuffles = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)",
                                  plan))
        scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?/(\w+)\.parquet", plan)
        cols = sorted({(t, len(c.split(","))) for c, t in scans})
        print(f"{name:26s} shuffles={shuffles:2d} broadcasts={plan.count('BroadcastExchange')} "
              f"single={plan.count('SinglePartition')} python={len(re.findall(PY_NODES, plan))} "
              f"scans={cols}")
    spark.stop()


if __name__ == "__main__":
    main()
