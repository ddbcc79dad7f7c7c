"""End-to-end sync jobs on sports-shaped staging fixtures with the store."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.plans import reports
from staged import run_sync, sync_all_teams
from tidemark.sources.store import TableStore

D1, D2 = dt.datetime(2024, 3, 1), dt.datetime(2024, 3, 2)

SKATER_STAGING = ("playerId bigint, headshot string, firstName string, lastName string, "
                  "fullName string, positionCode string, gamesPlayed bigint, goals bigint, "
                  "assists bigint, points bigint, plusMinus bigint, penaltyMinutes bigint, "
                  "powerPlayGoals double, shorthandedGoals double, gameWinningGoals double, "
                  "overtimeGoals double, shots double, shootingPctg double, "
                  "avgTimeOnIcePerGame double, avgShiftsPerGame double, faceoffWinPctg double, "
                  "season string, gameType double, triCode string")


def skater(pid, goals, tri="TOR", season="20232024", seq=0):
    return (pid, "h", "F", "L", "F L", "C", 10, goals, 1, goals + 1, 2, 4, 1.0, 0.0, 1.0,
            0.0, 30.0, 0.1, 900.5, 20.0, 0.5, season, 2.0, tri), seq


def staging(spark, rows):
    df = spark.createDataFrame([r for r, _ in rows], SKATER_STAGING)
    seqs = [s for _, s in rows]
    return df.withColumn("_ord", F.lit(0)) if len(set(seqs)) == 1 else df


def test_skaters_scd2_two_runs(spark, scratch):
    store = TableStore(spark, scratch)
    b1 = staging(spark, [skater(1, 5), skater(2, 3), skater(None, 1)])
    m1, s1, v1 = run_sync(spark, store, "skaters", b1, run_ts=D1, mode="keep")
    assert m1.first()["new_records"] == 3
    b2 = staging(spark, [skater(1, 6), skater(2, 3), skater(None, 1)])
    m2, s2, v2 = run_sync(spark, store, "skaters", b2, run_ts=D2, mode="keep")
    r = m2.first().asDict()
    assert (r["total_processed"], r["new_records"], r["updated_records"],
            r["unchanged_records"], r["new_occurrences"]) == (3, 1, 1, 1, 1)
    assert v2 == v1 + 1
    st = store.read("skaters")
    assert st.count() == 5
    assert sorted(st.select("id").rdd.flatMap(lambda x: x).collect()) == list(range(1, 6))
    cur = reports.current(st).where("playerId = 1").first()
    assert cur["goals"] == 6 and cur["occurrence_number"] == 2 and cur["season"] == 20232024
    log = store.read_log("skaters_etl_log")
    summ = reports.etl_summary(log, shown=["id", "run_timestamp", "total_processed",
                                           "new_records", "unchanged_records",
                                           "new_occurrences", "run_duration"]).collect()
    assert [x["id"] for x in summ] == [2, 1]
    assert float(summ[0]["change_percentage"]) == round(200 / 3, 1)
    # run 3: history written so far stays where it is; only the active rows
    # and the new versions are written
    b3 = staging(spark, [skater(1, 7), skater(2, 3)])
    m3, _, v3 = run_sync(spark, store, "skaters", b3, run_ts=D2, mode="keep")
    segs = store.segments("skaters")
    assert any(f"/v={v2:06d}-" in p and part == "is_active=false" for p, part in segs)
    st = store.read("skaters")
    assert st.count() == 6
    assert st.where("is_active").count() == 4       # players 1, 2 and two NULL-key rows
    occ = {r["occurrence_number"] for r in st.where("playerId = 1").collect()}
    assert occ == {1, 2, 3}


def test_games_upsert_job(spark, scratch):
    store = TableStore(spark, scratch)
    cols = ("id string, season string, gameType string, gameDate string, gameState string, "
            "gameScheduleState string, startTimeUTC string, venueTimezone string, "
            "neutralSite boolean, venue_default string, tvBroadcasts string, "
            "awayTeam_id string, awayTeam_abbrev string, awayTeam_score string, "
            "homeTeam_id string, homeTeam_abbrev string, homeTeam_score string, "
            "periodDescriptor_periodType string, gameOutcome_lastPeriodType string, "
            "winningGoalie_playerId string, winningGoalScorer_playerId string")
    g = ("20241", "20232024", "2", "2024-01-05", "FUT", "OK", "2024-01-05T00:00:00Z", "UTC",
         False, "Arena", "tv1", "10", "TOR", "", "11", "MTL", "", "REG", "", "", "")
    b1 = spark.createDataFrame([g, ("",) + g[1:]], cols)          # blank id dropped
    m1, _, _ = run_sync(spark, store, "games", b1, run_ts=D1)
    assert m1.first()["inserted_records"] == 1 and m1.first()["total_processed"] == 1
    g2 = g[:4] + ("OFF",) + g[5:10] + ("tv2",) + g[11:13] + ("3",) + g[14:]
    m2, st, _ = run_sync(spark, store, "games", spark.createDataFrame([g2], cols), run_ts=D2)
    assert m2.first()["updated_records"] == 1
    row = st.first()
    assert row["awayTeam_score"] == 3 and row["tvBroadcasts"] == "tv2"
    assert row["gameDate"] == dt.date(2024, 1, 5) and row["updated_at"] == D2
    listing = reports.dated_listing(st, {"id": "id", "gameDate": "gameDate",
                                         "awayTeam_abbrev": "away_team"}, ["gameDate"])
    assert listing.first()["away_team"] == "TOR"


def test_players_then_drafts_backfill(spark, scratch):
    store = TableStore(spark, scratch)
    pcols = ("playerId bigint, isActive boolean, currentTeamId double, "
             "currentTeamAbbrev string, `fullTeamName.default` string, "
             "`firstName.default` string, `lastName.default` string, sweaterNumber double, "
             "position string, headshot string, heroImage string, heightInInches double, "
             "heightInCentimeters double, weightInPounds double, weightInKilograms double, "
             "birthDate string, `birthCity.default` string, "
             "`birthStateProvince.default` string, birthCountry string, "
             "shootsCatches string, playerSlug string, inTop100AllTime bigint, inHHOF bigint, "
             "`draftDetails.year` double, `draftDetails.teamAbbrev` string, "
             "`draftDetails.round` double, `draftDetails.pickInRound` double, "
             "`draftDetails.overallPick` double")
    p = (8, True, 10.0, "TOR", "Toronto", "A", "B", 34.0, "C", "h", "hero", 72.0, 183.0,
         200.0, 90.0, "", "City", None, "CAN", "L", "a-b", 0, 1, 2015.0, "EDM", 1.0, 1.0, 1.0)
    m, players, _ = run_sync(spark, store, "players", spark.createDataFrame([p], pcols),
                             run_ts=D1)
    row = players.first()
    assert row["fullTeamName"] == "Toronto" and row["inHHOF"] is True
    assert row["birthDate"] is None and row["draftYear"] == 2015
    # the same player again -> unchanged; a changed team -> a second version
    p2 = p[:3] + ("EDM",) + p[4:]
    m2, players, _ = run_sync(spark, store, "players",
                              spark.createDataFrame([p, p2], pcols).withColumn("o", F.lit(1))
                              .withColumn("o", F.monotonically_increasing_id()),
                              run_ts=D2, order_by="o")
    assert m2.first()["unchanged_records"] == 1 and m2.first()["new_occurrences"] == 1
    assert reports.latest(players, ["playerId"]).first()["currentTeamAbbrev"] == "EDM"
    dcols = ("draftYear string, teamAbbrev string, round string, pickInRound string, "
             "overallPick string, teamId string, teamName string, firstName string")
    drafts = spark.createDataFrame(
        [("2015", "EDM", "1", "1", "1", "22", "Oilers", "A"),
         ("2015", "EDM", "1", "2", "22", "22", "Oilers", "C")], dcols)
    md, st, _ = run_sync(spark, store, "drafts", drafts, run_ts=D2)
    got = {r["pickInRound"]: r for r in st.collect()}
    assert got[1]["playerId"] == 8 and got[1]["ordinalPick"] == "1st"
    assert got[2]["playerId"] is None and got[2]["ordinalPick"] == "22nd"
    assert md.first()["inserted_records"] == 2
    assert md.first()["backfilled_records"] == 0      # the lookup already matched pick 1
    # a player for pick 2 arrives later; a drafts run without pick 2 backfills it
    p3 = (9,) + p[1:26] + (2.0, 22.0)
    run_sync(spark, store, "players", spark.createDataFrame([p3], pcols), run_ts=D2)
    md2, st, _ = run_sync(spark, store, "drafts", drafts.where("pickInRound = '1'"), run_ts=D2)
    assert md2.first()["backfilled_records"] == 1
    got = {r["pickInRound"]: r for r in st.collect()}
    assert got[2]["playerId"] == 9 and got[2]["updated_at"] == D2


def test_sync_all_teams_chain(spark, scratch):
    store = TableStore(spark, scratch)
    teams = spark.createDataFrame([("1", "5", "Toronto Maple Leafs", "133", "TOR", "TOR")],
                                  "id string, franchiseId string, fullName string, "
                                  "leagueId string, rawTricode string, triCode string")
    fr = spark.createDataFrame([("5", "Toronto Maple Leafs", "TOR", "Toronto")],
                               "id string, fullName string, teamCommonName string, "
                               "teamPlaceName string")
    ts = spark.createDataFrame([("20232024", "1", "Toronto", "82", "2"),
                                ("20232024", "1", "Toronto", "80", "2")],
                               "seasonId string, teamId string, teamFullName string, "
                               "gamesPlayed string, gameTypeId string")
    gt = spark.createDataFrame([("20232024", "2,3", "TOR"), ("20232024", "2", "XXX")],
                               "season string, gameTypes string, triCode string")
    out = sync_all_teams(spark, store, {"teams": teams, "franchises": fr,
                                        "team_season": ts, "team_gametypes": gt}, run_ts=D1)
    assert out.count() == 4
    versions = store.current_versions()
    assert set(versions) == {"teams", "franchises", "team_season", "team_gametypes"}
    g = {r["triCode"]: r["teamId"] for r in store.read("team_gametypes").collect()}
    assert g == {"TOR": 5, "XXX": None}
    assert store.read("team_season").count() == 1


def test_bucketed_upsert_rewrites_only_touched_buckets(spark, scratch):
    store = TableStore(spark, scratch)
    cols = "id string, fullName string, teamCommonName string, teamPlaceName string"
    rows = [(str(i), f"F{i}", f"T{i}", f"P{i}") for i in range(1, 41)]
    run_sync(spark, store, "franchises", spark.createDataFrame(rows, cols), run_ts=D1)
    first = dict((part, p) for p, part in store.segments("franchises"))
    assert len(first) > 10 and all(k.startswith("_bucket=") for k in first)
    m, st, v2 = run_sync(spark, store, "franchises",
                         spark.createDataFrame([("7", "F7 new", "T7", "P7")], cols), run_ts=D2)
    assert m.first()["updated_records"] == 1
    second = dict((part, p) for p, part in store.segments("franchises"))
    assert set(second) == set(first)
    rewritten = [k for k in second if second[k] != first[k]]
    assert len(rewritten) == 1 and f"v={v2:06d}" in second[rewritten[0]]
    got = {r["id"]: r["fullName"] for r in store.read("franchises").collect()}
    assert len(got) == 40 and got[7] == "F7 new" and got[8] == "F8"
