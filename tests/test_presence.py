"""Rosters whose active flag lies beside the rows, and the change-driven
backfill of the drafts."""

import datetime as dt
import random
from dataclasses import replace

import pytest

from pyspark.sql import functions as F

from tidemark.plans import jobs
from tidemark.plans.entities import ENTITIES, Entity, _typed_hash
from tidemark.sources import presence
from tidemark.sources.store import TableStore

T0 = dt.datetime(2024, 1, 1)
COLUMNS = {"a": "bigint", "b": "string", "level": "bigint"}
ROSTER = Entity("things", "version_set", ["a", "b"], COLUMNS,
                hash_fn=_typed_hash([("level", "bigint")]), family="roster", active_col="active",
                log="things_log")


def _batch(spark, rng, n, start):
    rows = [(rng.choice([None, *range(8)]), rng.choice(["x", "y", None]), rng.randint(0, 2), start + i)
            for i in range(n)]
    return spark.createDataFrame(rows, "a long, b string, level long, seq long")


def _rows(df):
    cols = ("a", "b", "level", "occurrence_number", "data_hash", "active", "created_at", "updated_at")
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def _run(spark, store, batch, day, **kw):
    return jobs.run_sync(spark, store, ROSTER, batch, run_ts=T0 + dt.timedelta(days=day),
                         order_by="seq", **kw)


def test_derived_flags_equal_a_rewriting_fold(spark, scratch, monkeypatch):
    """Runs against folds that rewrite every row: empty batches, keys that
    leave and come back, a table written anew in between, a reset."""
    monkeypatch.setattr(jobs, "MAX_SEGMENTS", 3)
    rng, store = random.Random(4), TableStore(spark, scratch)
    plain = spark.createDataFrame([], ROSTER.state_schema())
    sizes = (25, 12, 0, 9, 7)
    for day, n in enumerate(sizes):
        batch = _batch(spark, rng, n, 100 * day)
        mode = "reset" if day == 4 else None
        if mode:
            plain = plain.limit(0)
        metrics, published, _ = _run(spark, store, batch, day, mode=mode)
        want = jobs.fold_batch(ROSTER, plain, ROSTER.prepare(batch, seq="seq"),
                               T0 + dt.timedelta(days=day), ordered=True)
        assert metrics.select(want.metrics.columns).first() == want.metrics.first()
        plain = spark.createDataFrame(want.state.collect(), ROSTER.state_schema())
        assert _rows(published) == _rows(plain), day
        assert presence.RUN not in published.columns
        # one path per run since the table was last written whole
        assert len(store.seen_paths("things")) == (1, 2, 3, 1, 1)[day]
    # a store that knows the folder alone reads the same
    assert _rows(TableStore(spark, scratch).read("things", ROSTER.state_schema())) == _rows(plain)
    assert store.read("things").count() == store.read("things").select("id").distinct().count()


def test_a_run_writes_its_batch_only(spark, scratch):
    rng, store = random.Random(5), TableStore(spark, scratch)
    _run(spark, store, _batch(spark, rng, 60, 0), 0)
    before = store.segments("things")
    one = spark.createDataFrame([(1, "x", 77, 1000)], "a long, b string, level long, seq long")
    _run(spark, store, one, 1)
    after = store.segments("things")
    assert after[:-1] == before and spark.read.parquet(after[-1][0]).count() == 1
    got = store.read("things")
    assert [r["level"] for r in got.where("active").collect()] == [77]
    # a fold over the derived rows does not join what it does not read
    fold = jobs.fold_batch(ROSTER, got, ROSTER.prepare(one, seq="seq"), T0, ordered=True)
    for part in (fold.inserted, fold.metrics, fold.seen.select("id")):
        assert presence.RUN_TS not in part._jdf.queryExecution().optimizedPlan().toString()
    # the same again: no new row, one id seen
    _run(spark, store, one, 2)
    assert spark.read.parquet(store.segments("things")[-1][0]).count() == 0
    seen = spark.read.parquet(store.seen_paths("things")[-1])
    assert seen.where("id IS NOT NULL").count() == 1 and seen.count() == 2
    assert [r["updated_at"] for r in store.read("things").where("active").collect()] \
        == [T0 + dt.timedelta(days=2)]


def test_tables_written_whole_are_taken_over_and_kept_by_vacuum(spark, scratch):
    """A table of the layout before (flag and stamp in the rows)."""
    rng, store = random.Random(6), TableStore(spark, scratch)
    first = _batch(spark, rng, 30, 0)
    fold = jobs.fold_batch(ROSTER, spark.createDataFrame([], ROSTER.state_schema()),
                           ROSTER.prepare(first, seq="seq"), T0, ordered=True)
    rows = fold.state.withColumn("id", F.monotonically_increasing_id())
    rows = spark.createDataFrame(rows.collect(), ROSTER.state_schema())
    store.commit({"things": store.write_version("things", rows)})
    plain = rows
    for day in (1, 2):
        batch = _batch(spark, rng, 8, 100 * day)
        _run(spark, store, batch, day)
        want = jobs.fold_batch(ROSTER, plain, ROSTER.prepare(batch, seq="seq"),
                               T0 + dt.timedelta(days=day), ordered=True)
        plain = spark.createDataFrame(want.state.collect(), ROSTER.state_schema())
        assert _rows(store.read("things")) == _rows(plain)
    assert store.vacuum(keep_commits=1)
    assert _rows(store.read("things")) == _rows(plain)


PLAYERS = ("playerId long, draftYear int, draftTeamAbbrev string, draftRound int, "
           "draftPickInRound int")


@pytest.fixture()
def few_buckets(monkeypatch):
    monkeypatch.setitem(ENTITIES, "drafts", replace(ENTITIES["drafts"], buckets=8))


def _drafts(spark, picks):
    names = [c for c in ENTITIES["drafts"].columns if c not in ("ordinalPick", "playerId")]
    given = {"draftYear": "2015", "teamAbbrev": "EDM", "round": "1", "overallPick": "1"}
    rows = [tuple(str(p) if c == "pickInRound" else given.get(c, "") for c in names) for p in picks]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in names))


def _add_players(spark, store, picks):
    rows = spark.createDataFrame([(p + 100, 2015, " edm", 1, p) for p in picks], PLAYERS)
    store.commit({"players": store.write_version("players", rows, carry=store.segments("players"))})


def _ids(store):
    return {r["pickInRound"]: r["playerId"] for r in store.read("drafts").collect()}


def test_backfill_reads_only_new_players(spark, scratch, few_buckets, monkeypatch):
    store = TableStore(spark, scratch)
    jobs.run_sync(spark, store, "drafts", _drafts(spark, range(1, 41)), run_ts=T0)
    assert jobs.backfill_drafts(spark, store) == 0          # no players yet
    _add_players(spark, store, [1, 2, 3])
    assert jobs.backfill_drafts(spark, store, T0 + dt.timedelta(days=1)) == 3
    # nothing new: neither table is read, nothing is written
    reads, commits = [], store.snapshot().number
    read = TableStore.read
    monkeypatch.setattr(TableStore, "read", lambda self, table, *a, **k: (
        reads.append((table, len(list(k.get("but", ()))))), read(self, table, *a, **k))[1])
    assert jobs.backfill_drafts(spark, store) == 0
    assert reads == [] and store.snapshot().number == commits
    # one more player: the old ones' segment is left out, one bucket written
    _add_players(spark, store, [7])
    before = dict((b, p) for p, b in store.segments("drafts"))
    assert jobs.backfill_drafts(spark, store, T0 + dt.timedelta(days=2)) == 1
    assert ("players", 1) in reads
    after = dict((b, p) for p, b in store.segments("drafts"))
    assert set(before) == set(after) and sum(before[b] != after[b] for b in before) == 1
    monkeypatch.setattr(TableStore, "read", read)
    got = {r["pickInRound"]: r for r in store.read("drafts").collect()}
    assert {p: r["playerId"] for p, r in got.items() if r["playerId"]} == {1: 101, 2: 102, 3: 103, 7: 107}
    assert got[7]["updated_at"] == T0 + dt.timedelta(days=2)
    assert got[8]["updated_at"] == T0
    # a player without a draft is noted too: the next run has nothing to do
    _add_players(spark, store, [500])
    assert jobs.backfill_drafts(spark, store) == 0
    assert jobs._draft_fills(store, store.snapshot(), store.snapshot(), None, None) is None


def test_a_sync_fills_its_own_drafts_from_old_players(spark, scratch, few_buckets):
    store = TableStore(spark, scratch)
    _add_players(spark, store, [1, 50])
    m, _, _ = jobs.run_sync(spark, store, "drafts", _drafts(spark, [1, 2]), run_ts=T0)
    assert m.first()["backfilled_records"] == 1 and _ids(store) == {1: 101, 2: None}
    # pick 50 arrives after its player, who is held against the batch alone
    m, _, _ = jobs.run_sync(spark, store, "drafts", _drafts(spark, [50]), run_ts=T0)
    assert m.first()["backfilled_records"] == 1 and _ids(store) == {1: 101, 2: None, 50: 150}
    # pick 2's player arrives; the sync of another pick fills it
    _add_players(spark, store, [2])
    m, _, _ = jobs.run_sync(spark, store, "drafts", _drafts(spark, [9]), run_ts=T0)
    assert m.first()["backfilled_records"] == 1
    assert _ids(store) == {1: 101, 2: 102, 9: None, 50: 150}
