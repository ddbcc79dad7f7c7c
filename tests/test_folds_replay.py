"""Set-based folds == row-by-row replay, on random batches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import replay
from tidemark.functions.hashing import row_hash
from tidemark.operators.common import empty_like, history_schema
from tidemark.operators.scd1 import scd1_fold
from tidemark.operators.scd2 import scd2_fold
from tidemark.operators.version_set import version_set_fold

TS = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
BATCH_SCHEMA = "k bigint, v string, seq bigint"


def random_batch(rng, n, keys=6, values="abc", null_rate=0.1, hot=None):
    rows, seqs = [], rng.sample(range(10 * n), n)
    for s in seqs:
        k = None if rng.random() < null_rate else rng.randint(1, keys)
        if hot is not None and rng.random() < 0.5:
            k = hot
        rows.append(dict(k=k, v=rng.choice(values), seq=s))
    return rows


def to_df(spark, rows, parts):
    df = spark.createDataFrame([(r["k"], r["v"], r["seq"]) for r in rows], BATCH_SCHEMA)
    df = df.repartition(parts)
    return df.withColumn("data_hash", row_hash(df.schema, ["v"]))


def state_rows(df, active="is_active"):
    out = []
    for r in df.collect():
        out.append((r["k"], r["v"], r["seq"], r["occurrence_number"],
                    r[active] if active else None, r["created_at"], r["updated_at"]))
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def replay_rows(rows):
    out = [(r["k"], r["v"], r["seq"], r["occ"], r["active"], r["created"], r["updated"])
           for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def metrics_of(df):
    r = df.first().asDict()
    return dict(total=r["total_processed"], new=r["new_records"], upd=r["updated_records"],
                unch=r["unchanged_records"], occ=r["new_occurrences"],
                **({"deact": r["deactivated_records"]} if "deactivated_records" in r else {}))


# (seed, staging partitions, rows_per_chunk): a small rows_per_chunk makes
# the hot key (and some others) take the chunked path
CASES = [(1, 1, None), (3, 7, 3), (4, 3, 2)]


def run_case(spark, fold, ref, seed, parts, chunk, family="scd", active="is_active", **kw):
    rng = random.Random(seed)
    batches = [random_batch(rng, rng.randint(25, 45), hot=3 if chunk else None)
               for _ in range(3)]
    batches.append([])                                   # empty batch
    schema = history_schema(spark.createDataFrame([], BATCH_SCHEMA).schema, family)
    state = empty_like(spark, schema)
    ref_state = []
    for i, b in enumerate(batches):
        ts = TS[min(i, 2)] + dt.timedelta(hours=i)
        res = fold(state, to_df(spark, b, parts), key=["k"], run_ts=ts, seq="seq",
                   rows_per_chunk=chunk, **kw)
        ref_state, ref_m = ref(ref_state, b, ts)
        got_state = res.state.checkpoint(eager=True)
        assert state_rows(got_state, active) == replay_rows(ref_state), f"batch {i}"
        assert metrics_of(res.metrics) == ref_m, f"metrics batch {i}"
        state = got_state


@pytest.mark.parametrize("seed,parts,chunk", CASES)
def test_scd2_matches_replay(spark, seed, parts, chunk):
    run_case(spark, scd2_fold, replay.scd2, seed, parts, chunk)


@pytest.mark.parametrize("seed,parts,chunk", CASES)
def test_version_set_matches_replay(spark, seed, parts, chunk):
    def ref(st, b, ts):
        s, m = replay.version_set(st, b, ts)
        return s, m
    run_case(spark, version_set_fold, ref, seed, parts, chunk, family="versions",
             active=None)


@pytest.mark.parametrize("seed,parts,chunk", CASES)
def test_roster_matches_replay(spark, seed, parts, chunk):
    def ref(st, b, ts):
        return replay.version_set(st, b, ts, roster=True)
    run_case(spark, version_set_fold, ref, seed, parts, chunk, family="roster",
             active="active", active_col="active")


@pytest.mark.parametrize("seed,parts,chunk", CASES)
def test_scd1_matches_replay(spark, seed, parts, chunk):
    run_case(spark, scd1_fold, replay.scd1, seed, parts, chunk)
