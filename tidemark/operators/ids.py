"""Dense surrogate ids (``SERIAL``) without a single-partition window.

Rows are sorted by a total order (range partitioning, parallel) and written
with their partition and position to the shared scratch folder, each
partition's size is counted, and ids are ``base + rows in earlier
partitions + position in the partition``.  The sort makes the result
the same on every run and every retry.  Only the per-partition counts
(one number per partition) reach the driver.

Rows that already have a place within their key need no sort of their own:
``number_groups`` numbers the keys by how many rows each has.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.scratch import keep_table

_LOW = (1 << 33) - 1


def assign_ids(df: DataFrame, order_cols, base: int = 0, id_col: str = "id") -> DataFrame:
    return number_rows(df.sort(*order_cols), base, id_col)


def number_rows(df: DataFrame, base: int = 0, id_col: str = "id") -> DataFrame:
    """``df`` with dense numbers from ``base`` + 1 in the order its rows are
    in: by partition, then by place.  A row per partition goes to the
    driver."""
    # partition and place stand in the file (reliable storage, not
    # executor-local), so that the counts and the ids agree even after a
    # retry; in columns, so that those who need the ids alone, or the key,
    # do not read whole rows
    ordered = keep_table(df.withColumn("_mid", F.monotonically_increasing_id()), "numbered")
    ordered = ordered.withColumn("_part", F.shiftright("_mid", 33))
    counts = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).collect()
    counts = sorted((r["_part"], r["_n"]) for r in counts)
    starts = [0] + list(accumulate(n for _, n in counts))[:-1]
    # one row per partition
    offsets = df.sparkSession.createDataFrame(
        [(p, int(base) + s) for (p, _), s in zip(counts, starts)], "_part long, _start long")
    rid = F.col("_start") + F.col("_mid").bitwiseAND(F.lit(_LOW)) + F.lit(1).cast("bigint")
    return (ordered.join(F.broadcast(offsets), "_part").withColumn(id_col, rid)
            .select(*[F.col(f"`{c}`") for c in df.columns], id_col))


def number_groups(groups: DataFrame, order_cols, size: str, base: int = 0,
                  start_col: str = "_start") -> tuple[DataFrame, int]:
    """(``groups`` with the number before its first row's, last number), where
    a group stands for ``size`` rows and the groups' rows are numbered from
    ``base`` + 1 in the given order.  The rows themselves are not sorted; a
    total per partition goes to the driver."""
    ordered = keep_table(groups.sort(*order_cols)
                         .withColumn("_mid", F.monotonically_increasing_id()), "groups")
    ordered = ordered.withColumn("_part", F.shiftright("_mid", 33))
    totals = sorted((r["_part"], r["_n"]) for r in
                    ordered.groupBy("_part").agg(F.sum(size).alias("_n")).collect())
    starts = [int(base), *accumulate((n for _, n in totals), initial=int(base))][1:]
    offsets = groups.sparkSession.createDataFrame(
        [(p, s) for (p, _), s in zip(totals, starts)], "_part long, _off long")
    before = F.sum(size).over(Window.partitionBy("_part").orderBy("_mid")
                              .rowsBetween(Window.unboundedPreceding, -1))
    return (ordered.join(F.broadcast(offsets), "_part")
            .withColumn(start_col, F.col("_off") + F.coalesce(before, F.lit(0)))
            .select(*[F.col(f"`{c}`") for c in groups.columns], start_col)), starts[-1]


def next_id_base(state: DataFrame, id_col: str = "id") -> int:
    if id_col not in state.columns:
        return 0
    v = state.agg(F.max(id_col)).first()[0]
    return int(v or 0)
