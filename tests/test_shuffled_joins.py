"""Joins whose sides grow with the tables are never sent through the driver."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators.backfill import filled_rows, fills
from tidemark.plans.entities import ENTITIES
from tidemark.plans.job_queries import LOADS, _draft_players, _draft_staging
from tidemark.plans.jobs import _draft_fills, _draft_match, _prepare_upsert, run_sync
from tidemark.sources.store import TableStore
from tests.conftest import SF001


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_drafts_meet_players_in_shuffles(spark, scratch):
    players, drafts = _draft_players(spark, SF001, 1), ENTITIES["drafts"]
    store = TableStore(spark, scratch)
    batch = _prepare_upsert(spark, store, drafts, _draft_staging(spark, SF001, LOADS[1]),
                            {"players": players})
    assert "BroadcastHashJoin" not in _plan(batch)
    stored = batch.withColumns({"created_at": F.lit(None).cast("timestamp_ntz"),
                                "updated_at": F.lit(None).cast("timestamp_ntz")})
    found = fills(stored, players, "playerId", "playerId", _draft_match(), drafts.key)
    assert "BroadcastHashJoin" not in _plan(found)
    rows = filled_rows(stored, found, "playerId", drafts.key, dt.datetime(2024, 1, 1))
    assert "BroadcastHashJoin" not in _plan(rows)


def test_stored_drafts_of_a_batch_are_not_broadcast(spark, scratch):
    store, drafts = TableStore(spark, scratch), ENTITIES["drafts"]
    store.commit({"players": store.write_version("players", _draft_players(spark, SF001, 1))})
    staged = _draft_staging(spark, SF001, LOADS[1])
    run_sync(spark, store, "drafts", staged, run_ts=dt.datetime(2024, 1, 1))
    at = store.snapshot()
    plan = _plan(_draft_fills(store, at, at, drafts.prepare(staged), None))
    # bucket numbers alone are broadcast
    assert plan.count("BroadcastHashJoin") == plan.count("BroadcastHashJoin [_bucket")
