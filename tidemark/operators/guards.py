"""Constraint guards run before a new version is published.

A violation raises, as a constraint error aborts the reference's
transaction.  Each check is one aggregate; the raising side reads one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sequence import qcols, complete_key


class ConstraintViolation(ValueError):
    pass


def key_violations(df: DataFrame, key) -> DataFrame:
    """Keys held by more than one row (NULL key parts are distinct, so rows
    with a NULL part never violate)."""
    key = list(key)
    return (df.where(complete_key(key)).groupBy(*qcols(key))
            .agg(F.count(F.lit(1)).alias("row_count"))
            .where(F.col("row_count") > 1))


def assert_unique(df: DataFrame, key, what: str = "unique key") -> None:
    bad = key_violations(df, key).first()
    if bad is not None:
        raise ConstraintViolation(f"{what} {list(key)} violated by {bad.asDict()}")


def null_counts(df: DataFrame, columns) -> DataFrame:
    """One row: NULL count per column (one pass, partial aggregation)."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns])


def assert_not_null(df: DataFrame, columns, what: str = "not null") -> None:
    counts = null_counts(df, columns).first()
    bad = {c: counts[c] for c in columns if counts[c]}
    if bad:
        raise ConstraintViolation(f"{what}: NULLs in {bad}")


def assert_no_batch_duplicates(batch: DataFrame, key) -> None:
    """An upsert batch must not carry one key twice (the reference's
    ``ON CONFLICT DO UPDATE`` refuses to touch a row twice)."""
    assert_unique(batch, key, "duplicate key in batch")
