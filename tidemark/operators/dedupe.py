"""``DISTINCT ON (key) ... ORDER BY``: keep one row per key.

Written as an aggregate (``max_by`` of the whole row by an ordering
struct) rather than a window: the aggregate combines map-side, so a key
with very many duplicates is reduced in parallel before the shuffle.
NULL key parts group together, as ``DISTINCT ON`` does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sequence import qcols


def first_per_key(df: DataFrame, key, prefer, tie_break=()) -> DataFrame:
    """Keep, per ``key``, the row with the largest ``prefer`` values
    (``DESC NULLS LAST``), then the largest ``tie_break`` values.

    Struct ordering puts NULL below every value, so ``max_by`` over a
    struct of the preference columns is ``ORDER BY ... DESC NULLS LAST``.
    Give a ``tie_break`` that makes the order total; the reference leaves
    ties to chance.
    """
    key = list(key)
    order = F.struct(*[F.col(f"`{c}`") if isinstance(c, str) else c
                       for c in list(prefer) + list(tie_break)])
    rest = [c for c in df.columns if c not in key]
    picked = df.groupBy(*[F.col(f"`{k}`") for k in key]).agg(
        F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), order).alias("_r"))
    return picked.select(*[F.col(f"`{k}`") for k in key],
                         *[F.col(f"_r.`{c}`").alias(c) for c in rest]).select(*qcols(df.columns))
