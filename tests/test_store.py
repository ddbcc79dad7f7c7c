"""Versioned store: unpublished versions are invisible, commits publish
several tables at once, older versions are read with the current schema."""

import pathlib

import pytest
from pyspark.sql import types as T

from tidemark.sources.store import ConcurrentUpdate, TableStore


def test_publish_and_evolve(spark, scratch):
    store = TableStore(spark, scratch)
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    v1 = store.write_version("t", old)
    assert store.read("t") is None                       # written, not published
    other = store.write_version("u", spark.createDataFrame([(9,)], "x int"))
    store.commit({"t": v1, "u": other})
    assert store.current_versions() == {"t": v1, "u": other}
    schema = T.StructType([T.StructField("k", T.IntegerType()),
                           T.StructField("v", T.StringType()),
                           T.StructField("added", T.StringType())])
    got = store.read("t", schema).collect()
    assert [tuple(r) for r in got] == [(1, "a", None)]   # forward migration
    # a later commit of one table leaves the other's version in place
    v2 = store.write_version("t", spark.createDataFrame([(2, "b", "z")], schema))
    store.commit({"t": v2})
    assert store.current_versions() == {"t": v2, "u": other}
    assert [r["k"] for r in store.read("t").collect()] == [2]


def test_run_log_append(spark, scratch):
    store = TableStore(spark, scratch)
    assert store.next_log_id("l") == 1
    row = spark.createDataFrame([(1, 5)], "id long, total_processed int")
    store.append_log("l", row)
    store.append_log("l", spark.createDataFrame([(2, 7)], "id long, total_processed int"))
    assert store.next_log_id("l") == 3
    assert sorted(r["total_processed"] for r in store.read_log("l").collect()) == [5, 7]


def _kv(spark, rows):
    return spark.createDataFrame(rows, "k int, v string")


def test_lost_update_is_refused(spark, scratch):
    store, other = TableStore(spark, scratch), TableStore(spark, scratch)
    store.commit({"t": store.write_version("t", _kv(spark, [(1, "a")]))})
    base = store.snapshot()
    theirs = other.write_version("t", _kv(spark, [(1, "a"), (2, "b")]))
    mine = store.write_version("t", _kv(spark, [(1, "c")]))
    other.commit({"t": theirs}, base=other.snapshot())
    with pytest.raises(ConcurrentUpdate):
        store.commit({"t": mine}, base=base)
    assert sorted(r["k"] for r in store.read("t").collect()) == [1, 2]
    # a commit of another table in between is no conflict
    base = store.snapshot()
    other.commit({"u": other.write_version("u", _kv(spark, [(9, "z")]))})
    store.commit({"t": store.write_version("t", _kv(spark, [(5, "e")]))}, base=base)
    assert [r["k"] for r in store.read("t").collect()] == [5]
    assert [r["k"] for r in store.read("u").collect()] == [9]


def test_crashed_writes_do_not_block(spark, scratch):
    store = TableStore(spark, scratch)
    store.commit({"t": store.write_version("t", _kv(spark, [(1, "a")]))})
    store.write_version("t", _kv(spark, [(2, "b")]))         # never published
    again = TableStore(spark, scratch)                       # a new driver
    again.commit({"t": again.write_version("t", _kv(spark, [(3, "c")]))})
    assert [r["k"] for r in again.read("t").collect()] == [3]
    (pathlib.Path(scratch) / "_commits" / "_aside-x-c=000003.json").write_text("{")
    assert TableStore(spark, scratch).snapshot().number == 2
    gone = again.vacuum(keep_commits=1)
    assert any("c=000001" in p for p in gone) and len(gone) == 3
    assert [r["k"] for r in again.read("t").collect()] == [3]


def test_logs_are_published_with_the_tables(spark, scratch):
    store = TableStore(spark, scratch)
    row = spark.createDataFrame([(1, 5)], "id long, total_processed int")
    v = store.write_version("t", _kv(spark, [(1, "a")]))
    store._write_log("l", row)                               # died before its commit
    assert store.read_log("l") is None and store.next_log_id("l") == 1
    store.commit({"t": v}, logs={"l": row}, applied={"l": "batch 1"})
    assert store.read_log("l").count() == 1 and store.snapshot().applied == {"l": "batch 1"}


def test_types_of_partition_columns(spark, scratch):
    store = TableStore(spark, scratch)
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "k int, is_active boolean")
    v1 = store.write_version("t", df, partition_by=["is_active"])
    store.commit({"t": v1})
    assert dict(store.read("t").dtypes) == {"k": "int", "is_active": "boolean"}
    carry = store.frozen_segments("t", "is_active")
    v2 = store.write_version("t", df.where("is_active OR is_active IS NULL"),
                             partition_by=["is_active"], carry=carry)
    store.commit({"t": v2})
    assert sorted((r["k"], r["is_active"]) for r in store.read("t").collect()) == [
        (1, True), (2, False), (3, None)]
    # more segments than allowed: the oldest half becomes one
    many = [list(c) for c in store.frozen_segments("t", "is_active")] * 70
    store._pending[("t", 100)] = {**store.snapshot().table("t"), "version": 100, "segments": many}
    store.commit({"t": 100})
    merged = store.frozen_segments("t", "is_active")
    assert len(merged) == 36 and "/merged-" in merged[0][0]
    assert spark.read.parquet(merged[0][0]).count() == 35
