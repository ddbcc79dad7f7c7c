"""Lookup joins that keep NULL keys out of the shuffle."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_join(df: DataFrame, lookup: DataFrame, on, how: str = "left",
                keys: list[Column] | None = None) -> DataFrame:
    """``df LEFT JOIN lookup ON ...``; the engine picks the strategy from the
    sides' sizes in bytes, at run time too.

    ``keys``: the expressions of ``df`` that ``on`` compares.  Rows where
    one of them is NULL match nothing, so they go round the join instead of
    meeting in one partition of it.
    """
    if not keys or how != "left":
        return df.join(lookup, on, how)
    whole = reduce(and_, [k.isNotNull() for k in keys])
    joined = df.where(whole).join(lookup, on, how)
    loose = df.where(~whole).select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in lookup.schema.fields])
    return joined.unionByName(loose)


def normalised_key(c: Column) -> Column:
    return F.upper(F.trim(c))
