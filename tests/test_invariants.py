"""History invariants on the registry's fold states."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.hashing import row_hash
from tidemark.operators.scd2 import scd2_fold
from tidemark.operators.version_set import version_set_fold
from tidemark.plans import registry as R

SF = "/root/testdata/sf0.001"


def _no_gaps(state, key):
    w = Window.partitionBy(*key)
    bad = (state.withColumn("n", F.count(F.lit(1)).over(w))
           .withColumn("mx", F.max("occurrence_number").over(w))
           .withColumn("mn", F.min("occurrence_number").over(w))
           .where("n <> mx OR mn <> 1"))
    return bad.count() == 0


def test_scd2_invariants(spark):
    state, results = R.stat_state_df(spark, SF, stored=True)
    key = ["user_id", "event_type"]
    active = state.where("is_active").groupBy(*key).count().where("count > 1")
    assert active.count() == 0                       # at most one active version per key
    assert _no_gaps(state, key)                      # occurrences 1..n
    top = state.groupBy(*key).agg(F.max("occurrence_number").alias("occurrence_number"))
    act = state.where("is_active").select(*key, "occurrence_number")
    assert top.exceptAll(act).count() == 0           # the active version is the newest
    for r in results:                                # metrics balance
        m = r.metrics.first()
        assert m["total_processed"] == (m["unchanged_records"] + m["new_records"]
                                        + m["new_occurrences"])


def test_same_batch_twice_changes_nothing(spark):
    state, _ = R.stat_state_df(spark, SF, stored=True)
    # fold load 2 again on top of the state that already holds it
    _, l2 = R._event_loads(spark, SF)
    l2 = l2.withColumn("data_hash", row_hash(l2.schema, ["level"]))
    # only the last row of each key in load 2 matches the active version;
    # replaying just those rows must be a no-op
    last = (l2.withColumn("rk", F.row_number().over(
        Window.partitionBy("user_id", "event_type").orderBy(F.desc("event_id"))))
        .where("rk = 1").drop("rk"))
    res = scd2_fold(state, last, ["user_id", "event_type"], dt.datetime(2024, 7, 1),
                    seq="event_id")
    m = res.metrics.first()
    assert m["new_records"] == 0 and m["updated_records"] == 0 and m["new_occurrences"] == 0
    assert m["unchanged_records"] == m["total_processed"]


def test_version_set_same_batch_twice(spark):
    state, _ = R.version_state_df(spark, SF, stored=True)
    _, l2 = R._event_loads(spark, SF)
    l2 = l2.withColumn("data_hash", row_hash(l2.schema, ["event_type", "level"]))
    res = version_set_fold(state, l2, ["user_id"], dt.datetime(2024, 7, 1), seq="event_id")
    m = res.metrics.first()
    assert m["new_records"] == 0 and m["new_occurrences"] == 0
    assert _no_gaps(res.state, ["user_id"])
