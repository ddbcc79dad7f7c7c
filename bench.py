"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is planned and executed to completion through Spark's ``noop``
sink (every row is produced, nothing is collected to the driver).  Prints
one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.registry import QUERIES  # noqa: E402
from tidemark.session import get_spark  # noqa: E402

HEADLINE = [
    "scd2_state", "stat_history", "current", "version_set_state", "roster_state",
    "scd1_state", "progression_key", "occurrence_stats", "latest",
    "keyed_upsert_state", "guarded_upsert", "backfill", "dedupe_first",
    "lookup_multi", "surrogate_ids", "row_hash", "blank_cast", "etl_summary",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(master=f"local[{cpus}]", app="tidemark-bench",
                      shuffle_partitions=int(cpus) * 2,
                      extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "16g")})
    # warm-up on the smallest scale: JIT and codegen caches, not the data
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in ("conditional_summary", "scd2_state", "version_set_state", "keyed_upsert_state"):
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
