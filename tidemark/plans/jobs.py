"""Sync jobs: read stored state, fold a staging batch, guard, publish, log.

``run_sync`` is one call of the reference's ``sync_*_from_staging``; the
returned one-row DataFrame is its counters row.  ``sync_all_teams`` chains
teams -> franchises -> team_season -> team_gametypes and publishes the
four tables in one commit.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.sequence import complete_key, qcols

from tidemark.operators.backfill import backfill, filled_rows, fills
from tidemark.operators.common import OCC, FoldResult, key_summary, shuffled, ts_literal
from tidemark.operators.dedupe import first_per_key
from tidemark.operators.guards import (assert_no_batch_duplicates,
                                       assert_not_null, assert_unique)
from tidemark.operators.ids import assign_ids, next_id_base, number_groups
from tidemark.operators.keyed_upsert import keyed_upsert
from tidemark.operators.lookup import lookup_join, normalised_key
from tidemark.operators.scd1 import scd1_fold
from tidemark.operators.scd2 import scd2_fold
from tidemark.operators.version_set import version_set_fold
from tidemark.plans.entities import ENTITIES, Entity
from tidemark.sources import presence
from tidemark.sources.store import (BUCKET, MAX_SEGMENTS, Snapshot, TableStore, bucket_of,
                                    buckets_of)


def _now() -> dt.datetime:
    return dt.datetime.now().replace(tzinfo=None)


def _empty(spark: SparkSession, entity: Entity) -> DataFrame:
    return spark.createDataFrame([], entity.state_schema())


def load_state(spark, store: TableStore, entity: Entity, mode: str | None = None,
               touched: DataFrame | None = None, at: Snapshot | None = None):
    """Published state; ``mode="reset"`` starts from empty history;
    ``touched`` (``buckets_of``) reads only those hash buckets of a bucketed
    table; ``at`` pins the run's snapshot."""
    mode = mode or "keep"
    if mode == "reset":
        return _empty(spark, entity)
    st = store.read(entity.table, entity.state_schema(), touched=touched, at=at)
    return st if st is not None else _empty(spark, entity)


def bucket_count(store: TableStore, entity: Entity, at: Snapshot | None = None) -> int:
    """Buckets the table is stored in; the spec's number for a new table."""
    return store.stored_buckets(entity.table, at) or entity.buckets


def touched_buckets(store: TableStore, entity: Entity, batch: DataFrame,
                    mode: str | None = None, at: Snapshot | None = None) -> DataFrame | None:
    """Hash buckets the batch touches, or None when the stored table is not
    laid out in buckets yet."""
    if not entity.bucketed or (mode or "keep") == "reset":
        return None
    n = store.stored_buckets(entity.table, at)
    return buckets_of(batch, entity.key, n) if n else None


def _publish_bucketed(store: TableStore, entity: Entity, result: FoldResult,
                      inserted: DataFrame, touched, at: Snapshot | None,
                      max_id: int | None, follows=None) -> int:
    """Write the buckets that hold a changed or inserted row; carry the
    others from the current version."""
    n = bucket_count(store, entity, at) if touched is not None else entity.buckets
    new_rows = result.kept.unionByName(inserted)
    if touched is not None and result.classified is not None \
            and "_status" in result.classified.columns:
        # rows without a whole key are always inserted, by inserted itself
        changed = (result.classified.where("_status IN ('insert', 'update')").select(*qcols(entity.key))
                   .unionByName(inserted.select(*qcols(entity.key))))
        new_rows = (new_rows.withColumn(BUCKET, bucket_of(entity.key, n))
                    .join(buckets_of(changed, entity.key, n), BUCKET, "left_semi").drop(BUCKET))
    return store.write_version(entity.table, new_rows, bucket_key=entity.key, buckets=n, max_id=max_id,
                               carry_buckets=at if touched is not None else None,
                               follows=follows)


def _publish_seen(store: TableStore, entity: Entity, result: FoldResult, inserted: DataFrame,
                  mode: str | None, at: Snapshot, run_ts, max_id: int | None) -> int:
    """Write a version set with an active flag: the inserted rows, and the
    ids of the stored ones that the batch holds.  The whole table is written
    anew when it is not laid out so yet, after a reset, and when its
    segments are many."""
    run = (at.version(entity.table) or 0) + 1
    old = None if (mode or "keep") == "reset" else store.seen_paths(entity.table, at)
    append = old is not None and len(old) < MAX_SEGMENTS
    rows = inserted if append else result.kept.unionByName(inserted)
    ids = (result.seen if append else inserted.limit(0)).select("id")
    return store.write_version(
        entity.table, rows.withColumn(presence.RUN, F.lit(run).cast("bigint")), max_id=max_id,
        carry=store.segments(entity.table, at) if append else None,
        seen=presence.rows(ids, run, run_ts), seen_flag=entity.active_col,
        carry_seen=old if append else None)


# -- what the folds need to know of a key --------------------------------------

def keys_table(entity: Entity) -> str:
    """Companion of a history table: a row per key (``common.key_summary``)."""
    return f"{entity.table}__keys"


def stored_keys(store: TableStore, entity: Entity, batch: DataFrame, mode: str | None,
                at: Snapshot) -> DataFrame | None:
    """The summary rows in the buckets that the batch touches; None where the
    stored summary does not belong to the stored history (a table that
    another path wrote): the fold then reads the history itself."""
    name = keys_table(entity)
    if (mode or "keep") == "reset" or at.version(entity.table) is None \
            or store.follows(name, at) != at.version(entity.table):
        return None
    n = store.stored_buckets(name, at)
    return store.read(name, touched=buckets_of(batch.where(complete_key(entity.key)), entity.key, n),
                      at=at).select(*qcols(entity.key), "_base", "_act")


def _publish_keys(store: TableStore, entity: Entity, result: FoldResult, state: DataFrame,
                  keys: DataFrame | None, version: int, at: Snapshot) -> int:
    """Write the summary of the keys that the batch holds, with the other
    rows of their buckets; buckets the batch does not touch are carried."""
    old = keys if keys is not None else key_summary(state, entity.key, active_col=entity.active_col)
    rows = old.join(shuffled(result.keys.select(*qcols(entity.key))), list(entity.key), "left_anti") \
        .unionByName(result.keys)
    return store.write_version(keys_table(entity), rows, bucket_key=entity.key,
                               buckets=store.stored_buckets(keys_table(entity), at) or entity.buckets,
                               carry_buckets=at if keys is not None else None, follows=version)


def deploy(spark: SparkSession, store: TableStore, name: str) -> int | None:
    """(Re)deploy a table: tables whose life cycle is ``reset`` get an empty
    published version (history dropped, the run log kept); ``keep`` tables
    are left as they are."""
    entity = ENTITIES[name]
    if entity.load_mode != "reset" and store.read(entity.table) is not None:
        return None
    v = store.write_version(entity.table, _empty(spark, entity))
    store.commit({entity.table: v})
    return v


def fold_batch(entity: Entity, state: DataFrame, batch: DataFrame, run_ts,
               ordered: bool, rows_per_chunk: int | None = None,
               keys: DataFrame | None = None) -> FoldResult:
    """Fold a prepared batch into ``state`` with the entity's strategy;
    ``keys``: the stored summary of its keys, if there is one."""
    if not ordered:
        # the reference's scan order is undefined: without an explicit
        # order, repeated keys would give an arbitrary history
        assert_no_batch_duplicates(batch, entity.key)
        batch = batch.withColumn("_seq", F.lit(0))
    kw = dict(key=entity.key, run_ts=run_ts, seq="_seq", rows_per_chunk=rows_per_chunk)
    if entity.strategy == "scd2":
        return scd2_fold(state, batch, keys=keys, **kw)
    if entity.strategy == "scd1":
        return scd1_fold(state, batch, keys=keys, **kw)
    if entity.strategy == "version_set":
        return version_set_fold(state, batch, active_col=entity.active_col, **kw)
    raise ValueError(entity.strategy)


def upsert_batch(entity: Entity, state: DataFrame, batch: DataFrame, run_ts) -> FoldResult:
    if entity.dedupe is not None:
        prefer, tie = entity.dedupe
        rest = [c for c in batch.columns if c not in entity.key and c not in prefer]
        # deterministic tie-break where the reference takes any row
        batch = first_per_key(batch, entity.key, prefer, list(tie) or rest)
    if entity.not_null:
        assert_not_null(batch, entity.not_null)
    assert_no_batch_duplicates(batch, entity.key)
    return keyed_upsert(state, batch, entity.key, run_ts, entity.update_cols,
                        watched=entity.watched, guarded=entity.guarded,
                        coalesce_updates=entity.coalesce_updates,
                        updated_name=entity.updated_name)


def _inserted_with_ids(entity: Entity, result: FoldResult, state: DataFrame,
                       store: TableStore | None = None, at: Snapshot | None = None,
                       mode: str | None = None) -> tuple[DataFrame, int | None]:
    """(inserted rows with surrogate ids, largest id of the table then)."""
    if not entity.has_id:
        return result.inserted, None
    base = store.max_id(entity.table, at) if store is not None and mode != "reset" else 0
    if base is None:                    # a table stored without the number
        whole = store.read(entity.table, at=at)
        base = next_id_base(whole if whole is not None else state)
    elif base == 0 and mode != "reset":
        base = next_id_base(state)      # rows handed in, not from the store
    order = [F.col(f"`{k}`").asc_nulls_last() for k in entity.key]
    if "occurrence_number" in state.columns:
        order.append(F.col("occurrence_number").asc_nulls_last())
    if result.inserted_parts is not None:
        # a key's new occurrences follow each other: its rows are numbered
        # from the key's place among the keys; rows without a whole key after
        # them
        whole, loose = result.inserted_parts
        starts, last = number_groups(
            result.per_key.where("_new > 0").select(*qcols(entity.key), "_old", "_new"),
            [F.col(f"`{k}`") for k in entity.key], "_new", base)
        rows = (whole.drop("id").join(shuffled(starts), list(entity.key))
                .withColumn("id", F.col("_start") + F.col(OCC) - F.col("_old")))
        rest = assign_ids(loose.drop("id"), order, base=last)
        top = rest.agg(F.max("id")).first()[0]
        cols = qcols(result.kept.columns)
        return rows.select(*cols).unionByName(rest.select(*cols)), max(base, top or last)
    ins = assign_ids(result.inserted.drop("id"), order, base=base)
    top = ins.agg(F.max("id")).first()[0]
    return ins.select(*qcols(result.kept.columns)), max(base, top or 0)


def _publish_history(store: TableStore, entity: Entity, result: FoldResult,
                     inserted: DataFrame, mode: str | None, at: Snapshot,
                     max_id: int | None) -> int:
    """Write the new SCD state.  Inactive versions never change, so when the
    stored table is laid out by the active flag only touched and inserted
    rows are written and the old inactive directories are carried over.  A
    reset carries nothing."""
    flag = entity.active_col
    carry = (store.frozen_segments(entity.table, flag, at)
             if result.untouched is not None and mode != "reset" else None)
    new_state = (result.touched if carry is not None else result.kept).unionByName(inserted)
    return store.write_version(entity.table, new_state, partition_by=[flag], carry=carry,
                               max_id=max_id)


def _assert_new_keys(inserted: DataFrame, state: DataFrame, key, label: str,
                     keys: DataFrame | None = None) -> None:
    """Unique key of the inserted rows, among themselves and against every
    stored row (a semi-join on the key columns alone).  With ``keys``, the
    stored summary, an occurrence must be beyond the key's highest."""
    assert_unique(inserted, key, label)
    whole = complete_key(key)
    if keys is not None:
        by = [k for k in key if k != OCC]
        clash = (inserted.where(whole).select(*qcols(key)).join(keys.select(*qcols(by), "_base"), by)
                 .where(F.col(OCC) <= F.col("_base")))
        if not clash.isEmpty():
            raise ValueError(f"{label}: inserted rows repeat stored keys, e.g. {clash.first()}")
        return
    clash = (inserted.where(whole).select(*qcols(key))
             .join(shuffled(state.where(whole).select(*qcols(key))), list(key), "left_semi"))
    if not clash.isEmpty():
        raise ValueError(f"{label}: inserted rows repeat stored keys, e.g. {clash.first()}")


def _finish_metrics(metrics: DataFrame, run_ts, seconds: float, log_id: int,
                    notes: str | None = None) -> DataFrame:
    cols = metrics.columns
    return metrics.select(
        F.lit(log_id).cast("long").alias("id"),
        ts_literal(run_ts).alias("run_timestamp"), *cols,
        F.lit(round(seconds, 6)).cast("decimal(18,6)").alias("run_duration"),
        F.lit(notes).cast("string").alias("notes"))


def run_sync(spark: SparkSession, store: TableStore, name: str | Entity, staging: DataFrame,
             run_ts: dt.datetime | None = None, order_by: str | None = None,
             mode: str | None = None, log: bool = True, extra_state=None,
             rows_per_chunk: int | None = None, publish: bool = True,
             notes: str | None = None):
    """Run one sync; returns (metrics row, new state, version written).
    ``name`` is a table of ``ENTITIES`` or an ``Entity`` spec."""
    entity = name if isinstance(name, Entity) else ENTITIES[name]
    name = entity.name
    started = time.perf_counter()
    run_ts = run_ts or _now()
    at = store.snapshot()
    if entity.strategy == "upsert":
        batch = _prepare_upsert(spark, store, entity, staging, extra_state)
    else:
        batch = entity.prepare(staging, seq=order_by)
    # the prepared batch is read by the bucket list, the guards and the fold
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    held = [batch]
    try:
        touched = touched_buckets(store, entity, batch, mode, at) if publish else None
        state = load_state(spark, store, entity, mode, touched=touched, at=at)
        history = publish and entity.strategy in ("scd2", "scd1")
        keys = stored_keys(store, entity, batch, mode, at) if history else None
        if entity.strategy == "upsert":
            result = upsert_batch(entity, state, batch, run_ts)
        else:
            result = fold_batch(entity, state, batch, run_ts, ordered=order_by is not None,
                                rows_per_chunk=rows_per_chunk, keys=keys)
        if result.classified is not None:
            held.append(result.classified.persist(StorageLevel.MEMORY_AND_DISK))
        inserted, max_id = _inserted_with_ids(entity, result, state, store, at, mode)
        key = entity.key + (["occurrence_number"]
                            if "occurrence_number" in state.columns else [])
        _assert_new_keys(inserted, state, key, f"{name} unique key", keys)
        version, versions, backfilled = None, {}, None
        if history:
            version = _publish_history(store, entity, result, inserted, mode, at, max_id)
            versions[keys_table(entity)] = _publish_keys(store, entity, result, state, keys, version, at)
        else:
            new_state = result.kept.unionByName(inserted)
            if publish and name == "drafts":
                version, backfilled = _publish_drafts(store, result, inserted, touched, at, mode,
                                                      run_ts, batch, extra_state)
            elif publish and entity.bucketed:
                version = _publish_bucketed(store, entity, result, inserted, touched, at, max_id)
            elif publish and entity.strategy == "version_set" and entity.active_col:
                version = _publish_seen(store, entity, result, inserted, mode, at, run_ts, max_id)
            elif publish:
                version = store.write_version(entity.table, new_state, max_id=max_id)
            elif name == "drafts":
                new_state, backfilled = _backfilled(store, new_state, run_ts, extra_state)
        counters = result.metrics.collect()
        # what is left is one small file and one manifest
        row = _finish_metrics(spark.createDataFrame(counters, result.metrics.schema), run_ts,
                              time.perf_counter() - started,
                              store.next_log_id(entity.log_name, at) if log else 0, notes)
        row = spark.createDataFrame(row.collect(), row.schema)   # one row, fixed now
        if publish:
            store.commit({entity.table: version, **versions}, logs={entity.log_name: row} if log else None,
                         base=at, applied={entity.log_name: notes} if notes else None)
        published = store.read(entity.table) if publish else new_state
        if backfilled is not None:
            # the reference prints this count and does not log it: it comes
            # back on the returned row only
            row = spark.createDataFrame(
                [tuple(row.first()) + (backfilled,)],
                T.StructType(row.schema.fields
                             + [T.StructField("backfilled_records", T.LongType())]))
        return row, published, version
    finally:
        for df in held:
            df.unpersist()


# -- the drafts' missing player ids ---------------------------------------------

def _draft_match() -> list:
    """What is equal in a draft and its player: (draft, player)."""
    return [(F.col("draftYear"), F.col("draftYear")),
            (normalised_key(F.col("teamAbbrev")), normalised_key(F.col("draftTeamAbbrev"))),
            (F.col("round"), F.col("draftRound")),
            (F.col("pickInRound"), F.col("draftPickInRound"))]


def _draft_fills(store: TableStore, at: Snapshot, now: Snapshot, batch: DataFrame | None,
                 players: DataFrame | None) -> DataFrame | None:
    """Player ids for drafts of ``now`` that miss one; None if nothing can
    have changed.  The stored drafts follow the players' segments that they
    were last filled from: only players of other segments are held against
    all drafts, and only the drafts of ``batch`` against all players.
    ``players``: a frame in place of the stored table, all of it new."""
    entity = ENTITIES["drafts"]
    key, schema = entity.key, entity.state_schema()
    known = store.follows(entity.table, at) if players is None else None
    parts = []
    if players is not None or set(player_segments(store, at)) - set(known or ()):
        new = players if players is not None else store.read("players", at=at, but=known or ())
        parts.append(fills(store.read(entity.table, schema, at=now), new, "playerId", "playerId",
                           _draft_match(), key))
    if batch is not None and known is not None:
        n = store.stored_buckets(entity.table, now)
        mine = (store.read(entity.table, schema, touched=buckets_of(batch, key, n), at=now)
                .join(shuffled(batch.select(*qcols(key))), key, "left_semi"))
        parts.append(fills(mine, store.read("players", at=at), "playerId", "playerId",
                           _draft_match(), key))
    if not parts:
        return None
    found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return found.groupBy(*qcols(key)).agg(F.max("_fill").alias("_fill"))


def player_segments(store: TableStore, at: Snapshot) -> list[str]:
    return [p for p, _ in store.segments("players", at) or []]


def _write_fills(store: TableStore, now: Snapshot, found: DataFrame, run_ts, follows) -> tuple:
    """(version, number of drafts filled): the buckets that hold a filled
    draft, written anew; the others are carried."""
    entity = ENTITIES["drafts"]
    found = found.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        count = found.count()
        n = store.stored_buckets(entity.table, now)
        touched = buckets_of(found, entity.key, n) if n else None
        rows = store.read(entity.table, entity.state_schema(), touched=touched, at=now)
        rows = filled_rows(rows, found, "playerId", entity.key, run_ts)
        return store.write_version(entity.table, rows, bucket_key=entity.key,
                                   buckets=n or entity.buckets, carry_buckets=now if n else None,
                                   follows=follows), count
    finally:
        found.unpersist()


def _publish_drafts(store: TableStore, result: FoldResult, inserted: DataFrame, touched,
                    at: Snapshot, mode: str | None, run_ts, batch: DataFrame,
                    extra_state) -> tuple[int, int | None]:
    """Write the synced drafts, then the buckets that the backfill changes;
    (version, drafts filled or None without a players table)."""
    entity, given = ENTITIES["drafts"], (extra_state or {}).get("players")
    if given is None and at.version("players") is None:
        return _publish_bucketed(store, entity, result, inserted, touched, at, None), None
    follows = player_segments(store, at) if given is None else None
    version = _publish_bucketed(store, entity, result, inserted, touched, at, None, follows)
    now = store.with_written(at, entity.table, version)
    found = _draft_fills(store, at, now, batch, given)
    if found is None or found.isEmpty():
        return version, 0
    return _write_fills(store, now, found, run_ts, follows)


def backfill_drafts(spark: SparkSession, store: TableStore,
                    run_ts: dt.datetime | None = None) -> int:
    """Fill the missing player ids of the stored drafts from the players
    history, as a job of its own; returns how many were filled.  With no
    player stored since the last fill it reads neither table."""
    at = store.snapshot()
    if at.version("drafts") is None or at.version("players") is None:
        return 0
    found = _draft_fills(store, at, at, None, None)
    if found is None:
        return 0
    # also without a find: the version notes which players were held against it
    version, count = _write_fills(store, at, found, run_ts or _now(), player_segments(store, at))
    store.commit({"drafts": version}, base=at)
    return count


def _backfilled(store: TableStore, drafts: DataFrame, run_ts, extra_state):
    """Unpublished drafts, backfilled: (rows, number filled or None)."""
    players = (extra_state or {}).get("players") or store.read("players")
    if players is None:
        return drafts, None
    rows, filled = backfill(drafts, players, "playerId", "playerId", _draft_match(), run_ts)
    return rows, filled.first()["filled_records"]


def _prepare_upsert(spark, store, entity: Entity, staging: DataFrame, extra_state):
    batch = entity.prepare(staging)
    extra_state = extra_state or {}
    if entity.name == "drafts":
        # enrich picks with playerId from the players history (J1)
        players = extra_state.get("players") or store.read("players")
        if players is not None:
            p = players.select(
                F.col("playerId").alias("_pid"), F.col("draftYear").alias("_y"),
                F.col("draftTeamAbbrev").alias("_t"), F.col("draftRound").alias("_r"),
                F.col("draftPickInRound").alias("_p"))
            p = shuffled(p)
            on = [batch["draftYear"] == p["_y"], batch["teamAbbrev"] == p["_t"],
                  batch["round"] == p["_r"], batch["pickInRound"] == p["_p"]]
            batch = lookup_join(batch, p, on, "left", keys=[
                batch[k] for k in ("draftYear", "teamAbbrev", "round", "pickInRound")]).withColumn("playerId", F.col("_pid")) \
                .drop("_pid", "_y", "_t", "_r", "_p")
    if entity.name == "team_gametypes":
        # teamId from franchises by common name = triCode (J2)
        fr = extra_state.get("franchises") or store.read("franchises")
        if fr is not None:
            f = shuffled(fr.select(F.col("id").alias("_fid"), F.col("teamCommonName").alias("_tcn")))
            batch = lookup_join(batch, f, batch["triCode"] == f["_tcn"], "left",
                                keys=[batch["triCode"]]) \
                .withColumn("teamId", F.col("_fid")).drop("_fid", "_tcn")
    return batch


def sync_all_teams(spark: SparkSession, store: TableStore, staging: dict,
                   run_ts: dt.datetime | None = None) -> DataFrame:
    """teams -> franchises -> team_season -> team_gametypes, one commit."""
    run_ts = run_ts or _now()
    at = store.snapshot()
    versions, logs, extra, held = {}, {}, {}, []
    try:
        for name in ("teams", "franchises", "team_season", "team_gametypes"):
            if name not in staging:
                continue
            entity = ENTITIES[name]
            started = time.perf_counter()
            batch = _prepare_upsert(spark, store, entity, staging[name], extra)
            batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
            held.append(batch)
            touched = touched_buckets(store, entity, batch, at=at)
            state = load_state(spark, store, entity, touched=touched, at=at)
            result = upsert_batch(entity, state, batch, run_ts)
            held.append(result.classified.persist(StorageLevel.MEMORY_AND_DISK))
            inserted, max_id = _inserted_with_ids(entity, result, state, store, at)
            _assert_new_keys(inserted, state, entity.key, f"{name} unique key")
            versions[name] = _publish_bucketed(store, entity, result, inserted, touched, at, max_id)
            extra[name] = store.read_version_rows(name, versions[name])
            m = _finish_metrics(spark.createDataFrame(result.metrics.collect(),
                                                      result.metrics.schema),
                                run_ts, time.perf_counter() - started,
                                store.next_log_id(entity.log_name, at))
            logs[entity.log_name] = spark.createDataFrame(m.collect(), m.schema)
    finally:
        for df in held:
            df.unpersist()
    store.commit(versions, logs=logs, base=at)
    out = None
    for m in logs.values():
        out = m if out is None else out.unionByName(m)
    return out
