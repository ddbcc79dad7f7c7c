"""The flag "in the latest batch", kept beside the rows it belongs to.

A run changes that flag on every row that the batch before held and this
one does not, which would rewrite a wide table each time.  Instead rows
stay as written, with the run that wrote them (``RUN``), and a run adds

- a presence row (``id``, run, time) per stored row that its batch holds,
- one row without an id, the mark that there was such a run.

``derive`` reads flag and stamp back: a row is flagged if the latest run
wrote or saw it; otherwise the run after the last one that did switched it
off, at that run's time.  A run's writes follow its batch, not the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.common import ID, UPDATED, ts_literal

RUN, RUN_TS = "_run", "run_timestamp"


def rows(ids: DataFrame, run: int, run_ts) -> DataFrame:
    """Presence rows of a run: its mark and the ``id``s seen (each once)."""
    ids = ids.select(F.col(ID).cast("bigint").alias(ID))
    mark = ids.sparkSession.range(1).select(F.lit(None).cast("bigint").alias(ID))
    return ids.unionByName(mark).select(ID, F.lit(run).cast("bigint").alias(RUN),
                                        ts_literal(run_ts).alias(RUN_TS))


def derive(versions: DataFrame, seen: DataFrame, flag: str) -> DataFrame:
    """``versions`` with ``flag`` and ``updated_at`` as of the latest run.
    ``seen`` holds the rows of all runs since the table was last written
    whole; its marks are a row per run, fewer than the store's segments."""
    marks = seen.where(F.col(ID).isNull()).groupBy(RUN).agg(F.max(RUN_TS).alias(RUN_TS))
    marks = marks.select(F.col(RUN).alias("_last"), F.col(RUN_TS).alias("_at"),
                         F.lead(RUN_TS).over(Window.orderBy(RUN)).alias("_off"))
    last = (seen.where(F.col(ID).isNotNull()).groupBy(ID).agg(F.max(RUN).alias("_seen")))
    df = (versions.join(last, ID, "left")
          .withColumn("_last", F.coalesce("_seen", F.when(F.col(flag), F.col(RUN))))
          .join(F.broadcast(marks), "_last", "left"))
    # never seen since it was stored switched off: as stored
    stamp = (F.when(F.col("_last").isNull(), F.col(UPDATED))
             .otherwise(F.coalesce("_off", "_at")))
    return df.withColumns({flag: F.col("_last").isNotNull() & F.col("_off").isNull(),
                           UPDATED: stamp}).select(
        *[F.col(f"`{c}`") for c in versions.columns if c != RUN])
