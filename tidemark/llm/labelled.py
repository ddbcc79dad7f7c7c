"""Bounded labelled samples for the classifiers, and their held-out rows."""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Texts longer than this many characters are not fitted on (they are
#: scored whole like any other).
LONGEST_FITTED = 60_000


def held_out(key: Column) -> Column:
    """True for rows that no classifier learns from: crc32 of the key as
    text, modulo 4, is 2.  A null key is not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fitting_sample(docs: DataFrame, labels: DataFrame, label: str, *, per_class: int,
                   key: str = "doc_id", text: str = "text",
                   longest: int = LONGEST_FITTED) -> DataFrame:
    """At most ``per_class`` texts of each label (in the order of md5 of
    the key), held-out rows excluded: ``order``, ``key``, ``y``, ``text``.

    Of several labels of one key the greatest counts, of several texts the
    least; null keys, labels and texts are left out.  The chosen labels
    (``2 * per_class`` rows at most) are broadcast to the texts, which are
    not shuffled.
    """
    y = (labels.where(F.col(f"`{key}`").isNotNull() & F.col(f"`{label}`").isNotNull())
         .where(~held_out(F.col(f"`{key}`")))
         .groupBy(F.col(f"`{key}`").alias("key"))
         .agg(F.max(F.col(f"`{label}`").cast("int")).alias("y"))
         .withColumn("order", F.md5(F.concat(F.lit("fit:"), F.col("key").cast("string")))))
    chosen = None
    for value in (0, 1):
        part = y.where(F.col("y") == value).orderBy("order", "key").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    return (docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
            .where(F.length("text") <= longest)
            .join(F.broadcast(chosen), "key")
            .groupBy("key").agg(F.min("order").alias("order"), F.max("y").alias("y"),
                                F.min("text").alias("text"))
            .select("order", "key", "y", "text"))


def fit_in_task(sample: DataFrame, fit):
    """``fit(texts, labels)`` in one task over a bounded sample, so that
    its memory and time are an executor's; returns the model."""
    def run(batches):
        parts = list(batches)
        if not parts:
            return
        rows = pa.Table.from_batches(parts)
        model = pickle.dumps(fit(rows.column("text").combine_chunks(),
                                 rows.column("y").to_numpy().astype(np.float64)))
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], ["model"])

    one = sample.repartition(1).sortWithinPartitions("order", "key").select("y", "text")
    found = one.mapInArrow(run, "model binary").collect()  # one row
    if not found:  # no rows, no task
        return fit(pa.array([], pa.string()), np.zeros(0))
    return pickle.loads(found[0]["model"])
