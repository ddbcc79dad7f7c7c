"""The per-key summary beside a history table, and run-time bucket pruning."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.common import key_summary
from tidemark.plans.entities import Entity, _typed_hash
from tidemark.plans.jobs import fold_batch, keys_table, run_sync, stored_keys
from tidemark.sources.store import TableStore, buckets_of

COLUMNS = {"a": "bigint", "b": "string", "level": "bigint"}
T0 = dt.datetime(2024, 1, 1)


def _entity(strategy, buckets=8):
    return Entity("things", strategy, ["a", "b"], COLUMNS, hash_fn=_typed_hash([("level", "bigint")]),
                  log="things_log", buckets=buckets)


def _batch(spark, rng, n, start):
    rows = [(rng.choice([None, *range(12)]), rng.choice(["x", "y", None]), rng.randint(0, 2), start + i)
            for i in range(n)]
    return spark.createDataFrame(rows, "a long, b string, level long, seq long")


def _summary(frame):
    return sorted((r["a"], r["b"], r["_base"], r["_act"]) for r in frame.collect())


def _state(frame):
    return sorted((tuple(r[c] for c in ("a", "b", "level", "occurrence_number", "is_active", "created_at",
                                         "updated_at")) for r in frame.collect()), key=str)


@pytest.mark.parametrize("strategy", ["scd2", "scd1"])
def test_summary_follows_the_history(spark, scratch, strategy):
    """Runs that read the summary against folds that read the history."""
    rng, entity, store = random.Random(strategy), _entity(strategy), TableStore(spark, scratch)
    plain = spark.createDataFrame([], entity.state_schema())
    for run in range(3):
        batch, ts = _batch(spark, rng, (30, 5, 12)[run], 100 * run), T0 + dt.timedelta(days=run)
        at = store.snapshot()
        keys = stored_keys(store, entity, entity.prepare(batch, seq="seq"), None, at)
        assert (keys is None) == (run == 0)
        metrics, _, _ = run_sync(spark, store, entity, batch, run_ts=ts, order_by="seq")
        want = fold_batch(entity, plain, entity.prepare(batch, seq="seq"), ts, ordered=True)
        assert metrics.select(want.metrics.columns).first() == want.metrics.first()
        plain = spark.createDataFrame(want.state.collect(), entity.state_schema())
        assert _state(store.read("things")) == _state(plain)
        stored = store.read(keys_table(entity))
        assert _summary(stored) == _summary(key_summary(plain, entity.key))


def test_a_run_reads_no_inactive_version(spark, scratch):
    rng, entity, store = random.Random(2), _entity("scd2"), TableStore(spark, scratch)
    for run in range(2):
        run_sync(spark, store, entity, _batch(spark, rng, 40, 100 * run), run_ts=T0, order_by="seq")
    batch, at = entity.prepare(_batch(spark, rng, 3, 900), seq="seq"), store.snapshot()
    state = store.read("things", entity.state_schema(), at=at)
    keys = stored_keys(store, entity, batch, None, at)
    result = fold_batch(entity, state, batch, T0, ordered=True, keys=keys)
    plan = result.inserted._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan            # of the summary's buckets
    for part in (result.inserted, result.metrics, result.keys):
        assert not [f for f in part.inputFiles() if "/things/" in f]
    # the active rows: every scan of the history is pruned by the flag
    scans = [x for x in result.touched._jdf.queryExecution().executedPlan().toString().split("FileScan ")[1:]
             if "/things/" in x]
    assert scans and all("PartitionFilters: [is" in x for x in scans)


def test_summary_of_another_version_is_not_read(spark, scratch):
    """A history that another path wrote is summed up anew."""
    rng, entity, store = random.Random(5), _entity("scd2"), TableStore(spark, scratch)
    run_sync(spark, store, entity, _batch(spark, rng, 20, 0), run_ts=T0, order_by="seq")
    store.commit({"things": store.write_version("things", store.read("things"),
                                                partition_by=["is_active"])})
    batch = _batch(spark, rng, 10, 100)
    assert stored_keys(store, entity, entity.prepare(batch, seq="seq"), None, store.snapshot()) is None
    run_sync(spark, store, entity, batch, run_ts=T0, order_by="seq")
    assert _summary(store.read(keys_table(entity))) == _summary(
        key_summary(store.read("things"), entity.key))


def test_touched_buckets_prune_the_scan(spark, scratch):
    store = TableStore(spark, scratch)
    rows = spark.range(200).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x"))
    store.commit({"t": store.write_version("t", rows, bucket_key=["k"], buckets=16)})
    # a later version has one more column and carries what it does not touch
    one = rows.where("k = 5").withColumn("y", F.lit("new"))
    at = store.snapshot()
    near = store.read("t", one.schema, touched=buckets_of(one, ["k"], 16), at=at)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    held = {r.k for r in near.collect()}
    assert 5 in held and 0 < len(held) < 60
    changed = near.withColumn("y", F.when(F.col("k") == 5, "new"))
    store.commit({"t": store.write_version("t", changed, bucket_key=["k"], buckets=16, carry_buckets=at)})
    got = {r.k: (r.x, r.y) for r in store.read("t").collect()}
    assert got == {k: (2 * k, "new" if k == 5 else None) for k in range(200)}
    with pytest.raises(ValueError):
        store.write_version("t", rows.withColumnRenamed("x", "v"), bucket_key=["k"], buckets=16)
