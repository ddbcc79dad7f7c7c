"""Entity specs through run_sync: goalies (SCD1), rosters (version set with
active flag), season tables (SCD2 with localised names)."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.plans import reports
from tidemark.plans.entities import SEASON_GOALIE_OPTIONAL
from staged import run_sync
from tidemark.sources.store import TableStore

D1, D2 = dt.datetime(2024, 4, 1), dt.datetime(2024, 4, 2)

GOALIE = ("playerId bigint, headshot string, firstName string, lastName string, "
          "fullName string, gamesPlayed bigint, gamesStarted bigint, wins bigint, "
          "losses bigint, overtimeLosses double, goalsAgainstAverage double, "
          "savePercentage double, shotsAgainst double, saves double, goalsAgainst bigint, "
          "shutouts bigint, goals bigint, assists bigint, points bigint, "
          "penaltyMinutes bigint, timeOnIce bigint, season bigint, gameType bigint, "
          "team string")


def goalie(pid, wins, head="h1"):
    return (pid, head, "G", "K", "G K", 10, 9, wins, 2, 1.0, 2.5, 0.91, 300.0, 273.0, 27,
            1, 0, 0, 0, 2, 36000, 20232024, 2, "TOR")


def test_goalies_scd1_in_place(spark, scratch):
    store = TableStore(spark, scratch)
    # staging without the optional ``ties`` column
    m1, _, _ = run_sync(spark, store, "goalies",
                        spark.createDataFrame([goalie(1, 5), goalie(2, 3)], GOALIE), run_ts=D1)
    assert m1.first()["new_records"] == 2
    m2, st, _ = run_sync(spark, store, "goalies",
                         spark.createDataFrame([goalie(1, 6, "h2"), goalie(2, 3, "h9")], GOALIE),
                         run_ts=D2)
    r = m2.first()
    assert (r["updated_records"], r["unchanged_records"], r["new_records"]) == (1, 1, 0)
    rows = {x["playerId"]: x for x in store.read("goalies").collect()}
    assert len(rows) == 2
    assert rows[1]["wins"] == 6 and rows[1]["headshot"] == "h2"
    assert rows[1]["occurrence_number"] == 1 and rows[1]["updated_at"] == D2
    # an equal hash touches the row but does not refresh unhashed columns
    assert rows[2]["headshot"] == "h1" and rows[2]["updated_at"] == D2
    assert rows[1]["ties"] is None


ROSTER = ("teamAbbreviation string, positionGroup string, playerId bigint, headshot string, "
          "firstName string, lastName string, sweaterNumber double, positionCode string, "
          "shootsCatches string, heightInInches bigint, weightInPounds bigint, "
          "heightInCentimeters bigint, weightInKilograms bigint, birthDate string, "
          "birthCity string, birthCountry string, birthStateProvince string")


def roster(pid, team, group, number):
    return (team, group, pid, "h", "F", "L", number, "C", "L", 72, 200, 183, 90,
            "1990-01-01", "X", "CAN", None)


def test_rosters_active_flag(spark, scratch):
    store = TableStore(spark, scratch)
    b1 = [roster(1, "TOR", "forwards", 34.0), roster(2, "TOR", "goalies", 35.0),
          roster(3, "MTL", "defensemen", 2.0)]
    run_sync(spark, store, "current_rosters", spark.createDataFrame(b1, ROSTER), run_ts=D1)
    # player 1 changes number, player 3 leaves, player 2 stays
    b2 = [roster(1, "TOR", "forwards", 16.0), roster(2, "TOR", "goalies", 35.0)]
    m2, _, _ = run_sync(spark, store, "current_rosters", spark.createDataFrame(b2, ROSTER),
                        run_ts=D2)
    r = m2.first()
    assert (r["new_occurrences"], r["unchanged_records"], r["deactivated_records"]) == (1, 1, 2)
    st = store.read("current_rosters")
    active = {(x["playerId"], x["sweaterNumber"]) for x in reports.current(st, "active").collect()}
    assert active == {(1, 16.0), (2, 35.0)}
    summary = {x["teamAbbreviation"]: x for x in reports.roster_summary(st).collect()}
    assert summary["TOR"]["active_players"] == 2 and summary["TOR"]["active_goalies"] == 1
    assert summary["MTL"]["inactive_players"] == 1
    latest = reports.latest(st, ["playerId", "teamAbbreviation"]).collect()
    assert {(x["playerId"], x["occurrence_number"]) for x in latest} == {(1, 2), (2, 1), (3, 1)}


SEASON_SKATER = ("playerId bigint, assists bigint, gameTypeId bigint, gamesPlayed bigint, "
                 "goals bigint, leagueAbbrev string, pim bigint, plusMinus bigint, "
                 "points bigint, season bigint, sequence bigint, `teamName.default` string, "
                 "avgToi string, faceoffWinningPctg double, shootingPctg double, shots double, "
                 "powerPlayGoals double, shorthandedGoals double, gameWinningGoals double, "
                 "otGoals double, powerPlayPoints double, shorthandedPoints double")


def test_season_skater_hash_and_toi(spark, scratch):
    store = TableStore(spark, scratch)

    def row(goals, toi, ot):
        return (8, 1, 2, 10, goals, "LGA", 4, 1, goals + 1, 20232024, 1, "Toronto", toi,
                0.5, 0.1, 30.0, 1.0, 0.0, 1.0, ot, 0.0, 0.0)
    run_sync(spark, store, "season_skater",
             spark.createDataFrame([row(5, "15:32", 0.0)], SEASON_SKATER), run_ts=D1)
    # otGoals is not part of the hash (the reference passes a constant 0)
    m2, _, _ = run_sync(spark, store, "season_skater",
                        spark.createDataFrame([row(5, "15:32", 3.0)], SEASON_SKATER),
                        run_ts=D2)
    assert m2.first()["unchanged_records"] == 1
    st = store.read("season_skater")
    r = st.first()
    assert r["avgToi"] is None and r["teamName.default"] == "Toronto"
    assert r["teamName.fr"] is None                      # optional localised column added
    m3, _, _ = run_sync(spark, store, "season_skater",
                        spark.createDataFrame([row(6, "15.5", 0.0)], SEASON_SKATER),
                        run_ts=D2)
    assert m3.first()["new_occurrences"] == 1
    stints = reports.progression(store.read("season_skater"),
                                 ["playerId", "season", "sequence", "teamName.default",
                                  "gameTypeId", "leagueAbbrev"],
                                 ["goals"], ["playerId", "occurrence_number", "goals"]).collect()
    assert [(x["goals"], x["prev_goals"]) for x in stints] == [(5, None), (6, 5)]


def test_season_goalie_missing_localised_columns(spark, scratch):
    store = TableStore(spark, scratch)
    cols = ("playerId bigint, gameTypeId bigint, season bigint, sequence bigint, "
            "leagueAbbrev string, timeOnIce string, gamesPlayed double, goalsAgainst double, "
            "goalsAgainstAvg double, losses double, shutouts double, ties double, wins double, "
            "assists double, gamesStarted double, goals double, pim double, savePctg double, "
            "shotsAgainst double, otLosses double, `teamName.default` string, "
            "`teamCommonName.default` string")
    row = (30, 2, 20232024, 1, "LGA", "1200:00", 20.0, 50.0, 2.5, 5.0, 1.0, None, 14.0, 0.0,
           19.0, 0.0, 2.0, 0.915, 600.0, 1.0, "Toronto", "Leafs")
    m, _, _ = run_sync(spark, store, "season_goalie", spark.createDataFrame([row], cols),
                       run_ts=D1)
    assert m.first()["new_records"] == 1
    st = store.read("season_goalie")
    assert set(SEASON_GOALIE_OPTIONAL) <= set(st.columns)
    stats = reports.occurrence_stats(st, ["playerId"],
                                     progress=[("Save%", "savePctg", 3)]).collect()
    assert stats == []                                    # one version: no repeats
