"""The reference's named views and report functions, per synced table.

``view(store, name)`` returns the DataFrame of one named view (for
example ``skaters_multiple_stints`` or ``get_goalies_occurrence_stats``)
over the published tables, built from the generic reports.  Column
names, labels and orderings below are fixed values that must equal the
reference's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import reports
from tidemark.plans.entities import ENTITIES, SEASON_KEY
from tidemark.sources.store import TableStore

_STAMPS = ["occurrence_number", "created_at", "updated_at"]

# -- fixed values: multiple-stint views ---------------------------------------
STINTS = {
    "skaters": dict(
        key=["playerId", "season", "gameType", "triCode"], filter_on=["playerId"],
        select=["playerId", "firstName", "lastName", "season", "gameType", "triCode"]
        + _STAMPS + ["goals", "assists", "points", "gamesPlayed"],
        lags={"goals": "prev_goals", "assists": "prev_assists", "points": "prev_points",
              "gamesPlayed": "prev_games"}),
    "goalies": dict(
        key=["playerId", "season", "gameType", "team"], filter_on=["playerId"],
        select=["playerId", "firstName", "lastName", "season", "gameType", "team"]
        + _STAMPS + ["wins", "losses", "gamesPlayed", "savePercentage", "goalsAgainstAverage"],
        lags={"wins": "prev_wins", "losses": "prev_losses", "gamesPlayed": "prev_games",
              "savePercentage": "prev_save_pct"}),
    "current_rosters": dict(
        key=["playerId", "teamAbbreviation"], filter_on=["playerId"],
        select=["playerId", "firstName", "lastName", "teamAbbreviation", "positionCode",
                "sweaterNumber", "occurrence_number", "active", "created_at", "updated_at"],
        lags={"sweaterNumber": "prev_sweater_number", "positionCode": "prev_position"}),
    "season_skater": dict(
        key=SEASON_KEY, filter_on=None,
        select=SEASON_KEY + _STAMPS + ["goals", "assists", "points", "gamesPlayed"],
        lags={"goals": "prev_goals", "assists": "prev_assists", "points": "prev_points",
              "gamesPlayed": "prev_games"}),
    "season_goalie": dict(
        key=SEASON_KEY, filter_on=None,
        select=SEASON_KEY + _STAMPS + ["wins", "losses", "goalsAgainstAvg", "savePctg",
                                       "gamesPlayed"],
        lags={"wins": "prev_wins", "losses": "prev_losses", "goalsAgainstAvg": "prev_gaa",
              "gamesPlayed": "prev_games"}),
}

_SEASON_NAMES = {"playerId": "player_id", "season": "season_val", "sequence": "sequence_val",
                 "teamName.default": "team_name", "gameTypeId": "game_type",
                 "leagueAbbrev": "league"}

# -- fixed values: occurrence statistics functions ----------------------------
OCCURRENCE_STATS = {
    "skaters": dict(
        group=["playerId", "firstName", "lastName", "season", "gameType", "triCode"],
        names={"playerId": "player_id", "firstName": "first_name", "lastName": "last_name",
               "season": "season_val", "gameType": "game_type", "triCode": "team"},
        progress=[("Games", "gamesPlayed"), ("Goals", "goals"), ("Points", "points")],
        order_after=["playerId", "season"]),
    "goalies": dict(
        group=["playerId", "firstName", "lastName", "season", "gameType", "team"],
        names={"playerId": "player_id", "firstName": "first_name", "lastName": "last_name",
               "season": "season_val", "gameType": "game_type", "team": "team_name"},
        progress=[("Games", "gamesPlayed"), ("Wins", "wins"), ("Save%", "savePercentage", 3)],
        order_after=["playerId", "season"]),
    "season_skater": dict(
        group=SEASON_KEY, names=_SEASON_NAMES,
        progress=[("Games", "gamesPlayed"), ("Goals", "goals"), ("Points", "points")],
        order_after=["playerId", "season"]),
    "season_goalie": dict(
        group=SEASON_KEY, names=_SEASON_NAMES,
        progress=[("Games", "gamesPlayed"), ("Wins", "wins"), ("GAA", "goalsAgainstAvg")],
        order_after=["playerId", "season"]),
    "current_rosters": dict(
        group=["playerId", "firstName", "lastName", "teamAbbreviation", "positionCode"],
        names={"playerId": "player_id", "firstName": "first_name", "lastName": "last_name",
               "teamAbbreviation": "team", "positionCode": "position_code"},
        flags=[("is_active", "active")], order_after=["playerId"]),
}

# -- fixed values: run summaries ----------------------------------------------
_SCD_SHOWN = ["id", "run_timestamp", "total_processed", "new_records", "unchanged_records",
              "new_occurrences"]
_GAMES_COLUMNS = {"id": "id", "gameDate": "gameDate", "startTimeUTC": "startTimeUTC",
                  "gameState": "gameState", "awayTeam_abbrev": "away_team",
                  "awayTeam_score": "away_score", "homeTeam_abbrev": "home_team",
                  "homeTeam_score": "home_score", "venue_default": "venue",
                  "gameOutcome_lastPeriodType": "outcome_period",
                  "tvBroadcasts": "tvBroadcasts"}

# the reference names the summary views after these prefixes
_SUMMARY_PREFIX = {"current_rosters": "rosters"}
_STATS_FUNCTION = {"skaters": "get_occurrence_stats", "goalies": "get_goalies_occurrence_stats",
                   "season_skater": "get_season_skaters_occurrence_stats",
                   "season_goalie": "get_season_goalies_occurrence_stats",
                   "current_rosters": "get_rosters_occurrence_stats"}


def _state(spark: SparkSession, store: TableStore, table: str) -> DataFrame:
    entity = ENTITIES[table]
    df = store.read(table, entity.state_schema())
    return df if df is not None else spark.createDataFrame([], entity.state_schema())


def etl_summary(spark: SparkSession, store: TableStore, table: str) -> DataFrame | None:
    entity = ENTITIES[table]
    log = store.read_log(entity.log_name)
    if log is None:
        return None
    if entity.strategy == "upsert":
        shown = ["id", "run_timestamp", "total_processed", "inserted_records",
                 entity.updated_name, "unchanged_records", "run_duration"]
        changed = ("inserted_records", entity.updated_name)
    else:
        extra = ["deactivated_records"] if entity.active_col == "active" else []
        shown = _SCD_SHOWN + extra + ["run_duration"]
        changed = ("new_records", "new_occurrences")
    return reports.etl_summary(log, changed=changed, shown=shown)


def _builders():
    out = {}
    for t in ("skaters", "goalies", "season_skater", "season_goalie"):
        out[f"{t}_current"] = (lambda t: lambda s, st: reports.current(_state(s, st, t)))(t)
    out["players_current"] = lambda s, st: reports.latest(_state(s, st, "players"), ["playerId"])
    out["rosters_active"] = lambda s, st: reports.current(_state(s, st, "current_rosters"),
                                                          "active")
    out["rosters_latest"] = lambda s, st: reports.latest(_state(s, st, "current_rosters"),
                                                         ["playerId", "teamAbbreviation"])
    out["rosters_inactive"] = lambda s, st: reports.inactive(_state(s, st, "current_rosters"),
                                                             "active")
    out["team_roster_summary"] = lambda s, st: reports.roster_summary(
        _state(s, st, "current_rosters"))
    out["games_by_date"] = lambda s, st: reports.dated_listing(
        _state(s, st, "games"), _GAMES_COLUMNS, ["gameDate", "startTimeUTC"])
    for t, spec in STINTS.items():
        name = ("rosters" if t == "current_rosters" else t) + "_multiple_stints"
        out[name] = (lambda t, spec: lambda s, st: reports.progression(
            _state(s, st, t), spec["key"], list(spec["lags"]), spec["select"],
            filter_on=spec["filter_on"], names=spec["lags"]))(t, spec)
    for t, spec in OCCURRENCE_STATS.items():
        out[_STATS_FUNCTION[t]] = (lambda t, spec: lambda s, st: reports.occurrence_stats(
            _state(s, st, t), spec["group"], progress=spec.get("progress", ()),
            flags=spec.get("flags", ()), order_after=spec["order_after"],
            names=spec["names"]))(t, spec)
    for t in ENTITIES:
        name = _SUMMARY_PREFIX.get(t, t) + "_etl_summary"
        out[name] = (lambda t: lambda s, st: etl_summary(s, st, t))(t)
    return out


VIEWS = _builders()


def view(spark: SparkSession, store: TableStore, name: str) -> DataFrame | None:
    """The named view / report function over the published tables."""
    return VIEWS[name](spark, store)
