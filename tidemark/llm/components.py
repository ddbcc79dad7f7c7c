"""Connected components by alternating large and small stars.

Each round hangs every node's larger neighbours on its least neighbour,
then every node's smaller ones; the number of rounds grows with the
logarithm of a component's size, not with its diameter.  Rounds are
written to the shared scratch folder, so lineage stays short.  A node with
very many neighbours is one key of plain joins and pre-aggregated minima,
which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch


def _mark(edges: DataFrame):
    """Row count and an order-free checksum of a set of edges."""
    return edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("hi", "lo"), F.lit(1 << 40)))).first()


def connected_components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """``edges``: two long columns; returns ``id``, ``root`` (the least id
    of its component) for every id that has an edge to another."""
    a, b = edges.columns
    now = scratch.keep(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), f"{name}-0")
    mark, round_ = _mark(now), 0
    while mark[0]:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        # minima are written before they are joined: a hub's rows are then an
        # input of the join alone, which can be split
        least = scratch.keep(both.groupBy("u").agg(F.min("v").alias("m"))
                             .withColumn("m", F.least("u", "m")), f"{name}-near-{round_}")
        large = (both.where(F.col("v") > F.col("u")).join(least, "u")
                 .select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())
        # no hubs here: a node hangs on few others now
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").where(F.col("lo") != F.col("m")).select(
            F.col("lo").alias("hi"), F.col("m").alias("lo"))
        small = small.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()
        round_ += 1
        now = scratch.keep(small, f"{name}-{round_}")
        scratch.drop(f"{name}-{round_ - 1}", f"{name}-near-{round_ - 1}")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("hi").alias("id"), F.col("lo").alias("root")).unionByName(
        now.select(F.col("lo").alias("id"), F.col("lo").alias("root")).distinct())
