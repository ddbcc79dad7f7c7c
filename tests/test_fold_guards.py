"""Exact order, refused orders, all-version occurrences, NULL flags, ids and
runs that repeat, reset or change nothing."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from staged import run_sync
from tidemark.operators.common import empty_like, history_schema
from tidemark.operators.ids import assign_ids
from tidemark.operators.scd1 import scd1_fold
from tidemark.operators.scd2 import scd2_fold
from tidemark.operators.version_set import version_set_fold
from tidemark.plans.jobs import backfill_drafts
from tidemark.sources.staging import read_staging
from tidemark.sources.store import TableStore

D1, D2 = dt.datetime(2024, 3, 1), dt.datetime(2024, 3, 2)
FOLDS = [(scd2_fold, "scd"), (scd1_fold, "scd"), (version_set_fold, "versions")]


def _batch(spark, rows, seq="bigint"):
    return spark.createDataFrame(rows, f"k int, v string, data_hash string, seq {seq}")


def _empty(spark, batch, family):
    return empty_like(spark, history_schema(batch.drop("data_hash").schema, family))


@pytest.mark.parametrize("chunk", [None, 2])
@pytest.mark.parametrize("fold,family", FOLDS)
def test_wide_order(spark, fold, family, chunk):
    order = [3, 0, 5, 1, 4, 2]
    b = _batch(spark, [(1, f"v{i}", f"h{i}", 2 ** 60 + i) for i in order]).repartition(3)
    got = fold(_empty(spark, b, family), b, key=["k"], run_ts=D1, rows_per_chunk=chunk).state
    rows = sorted((r["occurrence_number"], r["v"]) for r in got.collect())
    assert rows == ([(1, "v5")] if fold is scd1_fold else [(i + 1, f"v{i}") for i in range(6)])


@pytest.mark.parametrize("fold,family", FOLDS)
@pytest.mark.parametrize("seqs", [[1, None, 3], [1, 2, 2]])
def test_refused_orders(spark, fold, family, seqs):
    b = _batch(spark, [(1, f"v{i}", f"h{i}", s) for i, s in enumerate(seqs)])
    with pytest.raises(Exception, match="order column"):
        fold(_empty(spark, b, family), b, key=["k"], run_ts=D1).state.collect()


@pytest.mark.parametrize("fold,family", FOLDS)
@pytest.mark.parametrize("seq,values", [("string", ["a", "ab", "b", "é"]),
                                        ("date", [dt.date(2024, 1, i) for i in (1, 2, 3, 4)])])
def test_other_orders(spark, fold, family, seq, values):
    rows = [(1, str(i), f"h{i}", s) for i, s in enumerate(values)]
    for chunk in (None, 2):
        b = _batch(spark, rows[::-1], seq)
        got = fold(_empty(spark, b, family), b, key=["k"], run_ts=D1, rows_per_chunk=chunk).state
        assert max(got.collect(), key=lambda r: r["occurrence_number"])["v"] == "3"


@pytest.mark.parametrize("fold", [scd2_fold, scd1_fold])
def test_inactive_only_key_continues(spark, fold):
    b = _batch(spark, [(1, "new", "h9", 1), (2, "x", "h1", 2)])
    schema = history_schema(b.drop("data_hash").schema, "scd")
    state = spark.createDataFrame(
        [(1, f"o{i}", 0, i, f"h{i}", False, D1, D1) for i in (1, 2, 3)]
        + [(7, "null flag", 0, 1, "h", None, D1, D1)], schema)
    res = fold(state, b, key=["k"], run_ts=D2)
    got = {(r["k"], r["occurrence_number"]): r["is_active"] for r in res.state.collect()}
    assert got == {(1, 1): False, (1, 2): False, (1, 3): False, (1, 4): True, (2, 1): True,
                   (7, 1): None}
    m = res.metrics.first()
    assert (m["new_records"], m["new_occurrences"]) == (1, 1)
    assert {r["k"] for r in res.touched.collect()} >= {7}      # written as it is, not lost


def test_ids_beyond_32_bits(spark):
    got = assign_ids(spark.range(4000).withColumnRenamed("id", "x"), ["x"], base=2_147_483_000)
    assert sorted(r["id"] for r in got.collect()) == list(range(2_147_483_001, 2_147_487_001))
    assert dict(got.dtypes)["id"] == "bigint"


def test_reset_drops_history_and_ids_restart(spark, scratch):
    from test_jobs import skater, staging
    store = TableStore(spark, scratch)
    for d, goals in ((D1, 5), (D2, 6)):
        run_sync(spark, store, "skaters", staging(spark, [skater(1, goals)]), run_ts=d)
    assert store.read("skaters").count() == 2
    run_sync(spark, store, "skaters", staging(spark, [skater(1, 7)]), run_ts=D2, mode="reset")
    rows = store.read("skaters").collect()
    assert [(r["id"], r["occurrence_number"], r["goals"]) for r in rows] == [(1, 1, 7)]
    assert store.read("skaters").schema["is_active"].dataType.simpleString() == "boolean"


def test_identical_snapshot_rewrites_nothing(spark, scratch):
    store = TableStore(spark, scratch)
    cols = "id string, fullName string, teamCommonName string, teamPlaceName string"
    rows = spark.createDataFrame([(str(i), f"F{i}", f"T{i}", f"P{i}") for i in range(200)], cols)
    run_sync(spark, store, "franchises", rows, run_ts=D1)
    before = store.segments("franchises")
    assert len(before) == len({p for p, _ in before}) <= 64
    m, st, _ = run_sync(spark, store, "franchises", rows, run_ts=D2)
    assert store.segments("franchises") == before
    assert m.first()["unchanged_records"] == 200 and st.where(F.col("updated_at") == D2).count() == 0


def test_bucket_count_stays_with_the_table(spark, scratch, monkeypatch):
    from tidemark.plans.entities import ENTITIES
    store = TableStore(spark, scratch)
    cols = "id string, fullName string, teamCommonName string, teamPlaceName string"

    def rows(n, mark=""):
        return spark.createDataFrame([(str(i), f"F{i}{mark}", "T", "P") for i in range(n)], cols)
    monkeypatch.setattr(ENTITIES["franchises"], "buckets", 4)
    run_sync(spark, store, "franchises", rows(16), run_ts=D1)
    monkeypatch.setattr(ENTITIES["franchises"], "buckets", 8)
    run_sync(spark, store, "franchises", rows(4, "x"), run_ts=D2)
    got = store.read("franchises").collect()
    assert len(got) == 16 and sum(r["fullName"].endswith("x") for r in got) == 4
    assert store.stored_buckets("franchises") == 4


def test_absent_columns_are_refused(spark, scratch):
    from tidemark.plans.jobs import run_sync as strict
    store = TableStore(spark, scratch)
    rows = spark.createDataFrame([("1", "F")], "id string, fullName string")
    with pytest.raises(ValueError, match="teamCommonName"):
        strict(spark, store, "franchises", rows, run_ts=D1)
    rows.write.parquet(f"{scratch}/staging")
    with pytest.raises(ValueError, match="nowhere"):
        read_staging(spark, f"{scratch}/staging", columns=["id", "nowhere"])


def test_backfill_as_a_job(spark, scratch):
    assert backfill_drafts(spark, TableStore(spark, scratch)) == 0


def test_checkpoint_folder_is_needed_on_a_cluster(spark, monkeypatch):
    from tidemark import session

    class Sc:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext, conf = Sc(), {}
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
