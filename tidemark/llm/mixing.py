"""Mixing sources to target weights, by weighted fair queueing [native].

Every source is a queue of its documents in a shuffled order (md5 of a
seed and the document key).  A document's virtual finish time is the
source's running word count up to and with it, divided by the source's
target; a queue may be served up to ``max_epochs`` times over and stops
being served once its target is reached.  The mix is the stream of all
queues range-sorted by finish time and cut where the budget is spent.

Scale: texts are read once, to be counted.  Running sums are two-level
(sums per hash bucket, then rows within a bucket), so a source holding a
third of all rows is spread over as many tasks as it has buckets.
Everything is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import WORD_PATTERN, Scratch, shuffle_partitions

DEFAULT_WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: Documents of one source that one window task orders, on average.
ROWS_PER_BUCKET = 1000


def word_count(text: Column) -> Column:
    """Words of a text as bigint; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def source_targets(sources: DataFrame, weights: Sequence[float], max_epochs: int) -> DataFrame:
    """Targets of the sources: ``(src, source_size, docs)`` gains ``rank``
    and ``target``.

    Shares follow the weights (dealt to the sources by code point, null
    last, repeating) and stop at ``max_epochs`` times a source's size; the
    excess goes to the others by weight until none is above.  That is a
    water level: with sources sorted by cap over weight, the level left
    after capping the first k is (total - their caps) / (other weights),
    and it is greatest at the right k.  One row per source is sorted here.
    """
    by_name = W.orderBy(F.col("src").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    s = (sources.withColumn("rank", F.row_number().over(by_name))
         .withColumn("_w", w)
         .withColumn("_cap", (F.col("source_size") * max_epochs).cast("double")))
    by_ratio = W.orderBy(F.col("_cap") / F.col("_w"), "rank")
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing).orderBy("rank")
    s = (s.withColumn("_level",
                      (F.sum("source_size").over(everything).cast("double")
                       - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
                      / (F.sum("_w").over(everything)
                         - F.coalesce(F.sum("_w").over(before), F.lit(0.0))))
         .withColumn("target", F.least("_cap", F.max("_level").over(everything) * F.col("_w"))))
    return s.select("src", "rank", "source_size", "docs", "target")


def mix_sources(docs: DataFrame, *, key: str = "doc_id", text: str = "text",
                source: str = "source", carry: Sequence[str] = ("doc_id",),
                weights: Sequence[float] = DEFAULT_WEIGHTS, max_epochs: int = MAX_EPOCHS,
                budget: int | None = None, seed: str = "mix",
                rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """One row per row of ``docs``: ``row`` (a struct of the ``carry``
    columns, so no name can clash), ``size``, ``source_size``, ``target``
    (the source's), ``taken`` (words the mix takes from it, repeats
    counted) and ``finish`` (virtual finish time of its first serving).

    ``budget``: words of the whole mix; None takes the sum of all sizes.

    A null text has size 0 and is never taken.  A null source is a source
    of its own, last in the order.  A null key sorts as the empty string;
    rows that share a key follow each other by size, and rows equal in both
    are interchangeable.  No rows give no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"),
        F.col(f"`{source}`").alias("src"),
        word_count(F.col(f"`{text}`")).alias("size"),
        F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(f"`{key}`").cast("string"),
                                                      F.lit("")))).alias("ord"))
    base = scratch.keep(base, "base")

    sources = source_targets(
        base.groupBy("src").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs")),
        weights, max_epochs)
    if budget is not None:
        total = F.sum("source_size").over(W.partitionBy())
        sources = sources.withColumn("target", F.col("target") * F.lit(float(budget)) / total)
    sources = scratch.keep(sources, "sources")

    s = sources.withColumnRenamed("src", "_src")
    fraction = F.conv(F.substring("ord", 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))
    placed = (base.join(s, F.col("src").eqNullSafe(F.col("_src"))).drop("src", "_src")
              .withColumn("bucket", F.floor(
                  fraction * F.ceil(F.col("docs") / F.lit(float(rows_per_bucket)))).cast("bigint")))

    # words of a source ahead of each of its buckets
    ahead = (placed.groupBy("rank", "bucket").agg(F.sum("size").alias("_s"))
             .withColumn("ahead", F.sum("_s").over(
                 W.partitionBy("rank").orderBy("bucket")
                 .rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("_s"))
             .select("rank", "bucket", "ahead"))
    ahead = scratch.keep(ahead, "ahead")
    within = (W.partitionBy("rank", "bucket").orderBy("ord", "size")
              .rowsBetween(W.unboundedPreceding, W.currentRow))
    queue = (placed.withColumn("_run", F.sum("size").over(within))
             .join(ahead, ["rank", "bucket"])
             .withColumn("run", F.col("_run") + F.col("ahead")))
    queue = scratch.keep(queue.select("row", "rank", "ord", "size", "source_size", "target",
                                      "run"), "queue")
    scratch.drop("base", "ahead")

    # the stream: every serving that starts before its source's target,
    # range-sorted by finish time and cut where the budget is spent
    served = (queue.select("rank", "ord", "size", "target", "run", "source_size",
                           F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1))).alias("epoch"))
              .withColumn("at", F.col("epoch") * F.col("source_size") + F.col("run"))
              .where(F.col("at") - F.col("size") < F.col("target"))
              .select((F.col("at") / F.col("target")).alias("finish"),
                      "rank", "ord", "size", "epoch"))
    order = ["finish", "rank", "ord", "size", "epoch"]
    stream = (served.repartitionByRange(shuffle_partitions(spark), *order)
              .withColumn("part", F.spark_partition_id()))
    stream = scratch.keep(stream, "stream")
    parts = (stream.groupBy("part").agg(F.sum("size").alias("_s"))
             .withColumn("before", F.sum("_s").over(W.orderBy("part")) - F.col("_s"))
             .select("part", "before"))
    running = F.col("before") + F.sum("size").over(
        W.partitionBy("part").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow))
    limit = (F.lit(int(budget)) if budget is not None
             else F.lit(sources.agg(F.sum("source_size")).first()[0] or 0))
    last = (stream.join(parts, "part").withColumn("_spent", running)
            .where(F.col("_spent") <= limit)
            .agg(F.max(F.struct(*order)).alias("last")).first()["last"])

    at = [F.col("run") + F.lit(e) * F.col("source_size") for e in range(max_epochs)]
    if last is None:
        taken = F.lit(0).cast("bigint")
    else:
        end = F.struct(F.lit(last["finish"]).alias("finish"), F.lit(last["rank"]).alias("rank"),
                       F.lit(last["ord"]).alias("ord"), F.lit(last["size"]).alias("size"),
                       F.lit(last["epoch"]).alias("epoch"))
        taken = F.lit(0).cast("bigint")
        for e, a in enumerate(at):
            serving = F.struct((a / F.nullif(F.col("target"), F.lit(0.0))).alias("finish"),
                               F.col("rank"), F.col("ord"), F.col("size"),
                               F.lit(e).alias("epoch"))
            took = (a - F.col("size") < F.col("target")) & (serving <= end)
            taken = taken + F.when(took, F.col("size")).otherwise(F.lit(0))
    return queue.select("row", "size", "source_size", "target", taken.alias("taken"),
                        (at[0] / F.nullif(F.col("target"), F.lit(0.0))).alias("finish"))


def mixed_rows(docs: DataFrame, **kw) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    m = mix_sources(docs, carry=docs.columns, **kw).where("taken > 0")
    return (m.withColumn("_times", F.explode(F.sequence(
        F.lit(1), (F.col("taken") / F.col("size")).cast("int"))))
        .select("row.*"))
