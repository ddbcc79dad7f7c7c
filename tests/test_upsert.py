"""Keyed upsert cases (games and drafts rules)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators.guards import ConstraintViolation, assert_no_batch_duplicates
from tidemark.operators.keyed_upsert import keyed_upsert

T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
GAMES = "id bigint, score int, tv string, venue string"


def stamped(df, ts):
    return df.withColumn("created_at", F.lit(ts).cast("timestamp_ntz")) \
             .withColumn("updated_at", F.lit(ts).cast("timestamp_ntz"))


def test_games_rules(spark):
    state = stamped(spark.createDataFrame(
        [(1, 0, "A", "X"), (2, 0, "A", "X"), (3, 0, "A", "X"), (4, 0, "A", "X"),
         (None, 9, "N", "N")], GAMES), T0)
    batch = spark.createDataFrame(
        [(1, 0, "B", "X"),          # only tv differs -> unchanged, stored tv stays
         (2, 5, "B", "X"),          # score and tv differ -> both updated
         (3, 0, "A", "Y"),          # venue differs (not watched) -> unchanged
         (5, 1, "C", "Z"),          # new id -> insert
         (None, 1, "Q", "Q")],      # NULL key never matches -> insert
        GAMES)
    res = keyed_upsert(state, batch, ["id"], T1, update_cols=["score", "tv"],
                       watched=["score"])
    rows = {(r["id"], r["tv"]): r for r in res.state.collect()}
    assert rows[(1, "A")]["updated_at"] == T0
    assert rows[(2, "B")]["score"] == 5 and rows[(2, "B")]["updated_at"] == T1
    assert rows[(3, "A")]["venue"] == "X"
    assert rows[(5, "C")]["created_at"] == T1
    assert (None, "Q") in rows and (None, "N") in rows
    assert len(rows) == 7
    m = res.metrics.first().asDict()
    assert m == dict(total_processed=5, inserted_records=2, updated_records=1,
                     unchanged_records=2)


def test_duplicate_key_in_batch_raises(spark):
    batch = spark.createDataFrame([(1, 0, "A", "X"), (1, 1, "A", "X")], GAMES)
    with pytest.raises(ConstraintViolation):
        assert_no_batch_duplicates(batch, ["id"])


def test_draft_guarded_coalesce(spark):
    schema = "y int, pick int, playerId bigint, ordinalPick string, teamName string"
    state = stamped(spark.createDataFrame(
        [(2020, 1, 10, "1st", "A"), (2020, 2, None, "2nd", "A"), (2020, 3, 30, "3rd", "A")],
        schema), T0)
    batch = spark.createDataFrame(
        [(2020, 1, None, "1st", "A"),   # incoming NULL playerId -> unchanged
         (2020, 2, 7, "2nd", "A"),      # stored NULL, incoming 7 -> updated
         (2020, 3, 30, "3rd", "B")],    # only teamName differs -> unchanged
        schema)
    res = keyed_upsert(state, batch, ["y", "pick"], T1, ["playerId", "ordinalPick"],
                       guarded=True, coalesce_updates=True,
                       updated_name="updated_playerid_records")
    rows = {r["pick"]: r for r in res.state.collect()}
    assert rows[1]["playerId"] == 10 and rows[1]["updated_at"] == T0
    assert rows[2]["playerId"] == 7 and rows[2]["updated_at"] == T1
    assert rows[3]["teamName"] == "A"
    m = res.metrics.first().asDict()
    assert m["updated_playerid_records"] == 1 and m["unchanged_records"] == 2
