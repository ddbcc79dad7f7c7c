"""Backfill NULL foreign keys from another table (``UPDATE ... FROM``).

Only rows whose target column is NULL take part in the join; the others
pass through without a shuffle.  The source is pre-aggregated to one row
per match key (largest id wins, a deterministic choice where the
reference takes any match), so the join cannot fan out.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.common import UPDATED, shuffled, ts_literal
from tidemark.operators.sequence import qcols


def _matched(target: DataFrame, source: DataFrame, fill_col: str, source_col: str,
             match: list[tuple[Column, Column]], how: str) -> tuple[DataFrame, Column]:
    """Rows of ``target`` that lack a value joined with their ``_fill``, and
    the condition that they meet."""
    names = [f"_m{i}" for i in range(len(match))]
    src = (source.where(F.col(source_col).isNotNull())
           .select(*[s.alias(nm) for (_, s), nm in zip(match, names)], source_col)
           .groupBy(*names).agg(F.max(source_col).alias("_fill")))
    src = shuffled(src)
    # rows without a whole match key can match nothing: they stay out of the
    # join, where they would all meet in one partition
    whole = reduce(and_, [t.isNotNull() for t, _ in match])
    missing = F.col(fill_col).isNull() & whole
    need = target.where(missing).select("*", *[t.alias(nm) for (t, _), nm in zip(match, names)])
    cond = reduce(and_, [need[nm] == src[nm] for nm in names])
    return need.join(src, cond, how), missing


def fills(target: DataFrame, source: DataFrame, fill_col: str, source_col: str,
          match: list[tuple[Column, Column]], key) -> DataFrame:
    """Key and ``_fill`` of the rows of ``target`` that ``backfill`` fills."""
    return _matched(target, source, fill_col, source_col, match, "inner")[0].select(
        *qcols(key), "_fill")


def filled_rows(target: DataFrame, found: DataFrame, fill_col: str, key, run_ts,
                stamp_col: str | None = UPDATED) -> DataFrame:
    """``target`` with the values of ``found`` (``fills``)."""
    return _fill_in(target.join(shuffled(found), list(key), "left"), target, fill_col, run_ts, stamp_col)


def _fill_in(joined: DataFrame, target: DataFrame, fill_col: str, run_ts,
             stamp_col: str | None) -> DataFrame:
    exprs = {fill_col: F.coalesce(F.col(fill_col), F.col("_fill")).cast(
        target.schema[fill_col].dataType)}
    if stamp_col and stamp_col in target.columns:
        exprs[stamp_col] = F.when(F.col("_fill").isNotNull(), ts_literal(run_ts)).otherwise(
            F.col(stamp_col))
    return joined.withColumns(exprs).select(*qcols(target.columns))


def backfill(target: DataFrame, source: DataFrame, fill_col: str,
             source_col: str, match: list[tuple[Column, Column]], run_ts,
             stamp_col: str | None = UPDATED) -> tuple[DataFrame, DataFrame]:
    """Fill ``target.fill_col`` where NULL from ``source.source_col``.

    ``match`` pairs (target expression, source expression) must all be
    equal.  Returns (new target, one-row DataFrame ``filled_records``).
    """
    j, missing = _matched(target, source, fill_col, source_col, match, "left")
    out = (target.where(~F.coalesce(missing, F.lit(False)))
           .unionByName(_fill_in(j, target, fill_col, run_ts, stamp_col)))
    count = j.agg(F.count_if(F.col("_fill").isNotNull()).cast("bigint").alias("filled_records"))
    return out, count
