"""A key holding a third of all rows: the chunked path gives the same
history as the plain window, and the window runs per (key, chunk)."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions.hashing import row_hash
from tidemark.operators.common import empty_like, history_schema
from tidemark.operators.scd1 import scd1_fold
from tidemark.operators.scd2 import scd2_fold
from tidemark.operators.sequence import keyed_lag

SF = "/root/testdata/sf0.01"


def hot_events(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    # every click/view row goes to user 0: ~40% of the table on one key
    uid = F.when(F.col("event_type").isin("click", "view"), F.lit(0)).otherwise(F.col("user_id"))
    b = ev.select("event_id", uid.cast("bigint").alias("user_id"), "event_type",
                  F.floor(F.col("value") / 100).cast("bigint").alias("level"))
    return b.withColumn("data_hash", row_hash(b.schema, ["level"]))


def rows(df):
    cols = sorted(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_hot_key_scd2_and_scd1(spark):
    b = hot_events(spark)
    assert b.where("user_id = 0").count() > b.count() / 3
    state = empty_like(spark, history_schema(b.drop("data_hash").schema, "scd"))
    for fold in (scd2_fold, scd1_fold):
        plain = fold(state, b, ["user_id"], dt.datetime(2024, 1, 1), seq="event_id")
        split = fold(state, b, ["user_id"], dt.datetime(2024, 1, 1), seq="event_id",
                     rows_per_chunk=300)
        assert rows(plain.state) == rows(split.state)
        assert plain.metrics.first() == split.metrics.first()
        plan = split.inserted._jdf.queryExecution().executedPlan().toString()
        assert "_chunk" in plan and "Window" in plan


def test_hot_key_lag(spark):
    b = hot_events(spark)
    plain = keyed_lag(b, ["user_id"], "event_id", ["level", "event_type"])
    split = keyed_lag(b, ["user_id"], "event_id", ["level", "event_type"], rows_per_chunk=250)
    assert rows(plain) == rows(split)


def test_hot_lag_keeps_null_keys(spark):
    from pyspark.sql import Window
    b = hot_events(spark).withColumn(
        "user_id", F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("user_id")))
    w = Window.partitionBy("user_id").orderBy("event_id")
    expect = b.withColumn("prev_level", F.lag("level").over(w))
    split = keyed_lag(b, ["user_id"], "event_id", ["level"], rows_per_chunk=250)
    assert split.where("user_id IS NULL").count() == b.where("user_id IS NULL").count()
    assert rows(split) == rows(expect)
