"""One declarative spec per synced table.

A spec says how a staging batch becomes typed rows (casts, renames,
missing columns, required keys), how its change hash is built, which
strategy folds it into history and which columns an upsert updates and
watches.  Column names, types and hash column orders are fixed values
that must equal the reference's for equal hashes and equal tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.casts import (blank_cast, canonical_text, flag_bool,
                                      guarded_date, guarded_number, keep_required,
                                      ordinal_label, round_half_even_cast,
                                      with_missing_columns)
from tidemark.functions.hashing import row_hash

LONG, INT, DBL, STR, BOOL = "bigint", "int", "double", "string", "boolean"
DATE, TSTZ = "date", "timestamp"


def _t(name: str) -> T.DataType:
    return T._parse_datatype_string(name)


def c(name: str) -> Column:
    return F.col(f"`{name}`")


@dataclass
class Entity:
    name: str
    strategy: str                   # scd2 | version_set | scd1 | upsert
    key: list[str]
    columns: dict[str, str]         # production data columns -> type, in order
    sources: dict[str, Callable] = field(default_factory=dict)  # target -> fn(df) -> Column
    hash_fn: Callable | None = None  # fn(df) -> Column (md5)
    missing: dict[str, str] = field(default_factory=dict)      # staging columns added if absent
    required: list[str] = field(default_factory=list)          # rows with blank/NULL dropped
    not_null: list[str] = field(default_factory=list)          # NULL aborts the run
    cast_mode: str = "assign"       # assign: cast (doubles round half-even); blank: NULLIF text
    family: str = "scd"
    active_col: str | None = "is_active"
    update_cols: list[str] = field(default_factory=list)
    watched: list[str] | None = None
    guarded: bool = False
    coalesce_updates: bool = False
    updated_name: str = "updated_records"
    dedupe: tuple | None = None     # (prefer columns, tie-break columns)
    has_id: bool = True
    load_mode: str = "keep"         # reset: deploying the table wipes its history
    log: str | None = None
    # stored in hash buckets of the key: a run reads and rewrites only the
    # buckets its batch touches (tables where rows change only by key)
    bucketed: bool = False
    buckets: int = 64

    @property
    def table(self) -> str:
        return self.name

    @property
    def log_name(self) -> str:
        return self.log or f"{self.name}_etl_log"

    def data_schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, _t(t)) for n, t in self.columns.items()])

    def state_schema(self) -> T.StructType:
        from tidemark.operators.common import history_schema
        fam = {"scd2": "scd", "scd1": "scd", "version_set": self.family,
               "upsert": "upsert"}[self.strategy]
        s = history_schema(self.data_schema(), fam)
        if self.has_id:
            s = T.StructType([T.StructField("id", T.LongType())] + s.fields)
        return s

    def prepare(self, staging: DataFrame, seq: str | None = None) -> DataFrame:
        """Staging -> typed batch with ``data_hash`` (history strategies)."""
        df = with_missing_columns(staging, self.missing)
        types = {f.name: f.dataType for f in df.schema.fields}
        out = []
        for name, target in self.columns.items():
            if name in self.sources:
                out.append(self.sources[name](df).cast(target).alias(name))
                continue
            if name not in types:
                # only the columns of ``missing`` may be absent
                raise ValueError(f"staging of {self.name} has no column {name}")
            if self.cast_mode == "blank":
                out.append(blank_cast(c(name), target, types[name]).alias(name))
            else:
                out.append(round_half_even_cast(c(name), target, types[name]).alias(name))
        if self.hash_fn is not None:
            out.append(self.hash_fn(df).alias("data_hash"))
        if seq:
            out.append(c(seq).alias("_seq"))
        return keep_required(df.select(*out), self.required)


def _typed_hash(items: list[tuple[str, str]], as_double: bool = False):
    """Hash over staging columns cast to the hash function's parameter types."""
    def fn(df: DataFrame) -> Column:
        types = {f.name: f.dataType for f in df.schema.fields}
        parts = []
        for name, t in items:
            if name is None:            # a constant part
                parts.append((F.lit(0.0), T.DoubleType()))
                continue
            dt_ = _t(t)
            parts.append((round_half_even_cast(c(name), dt_, types[name]), dt_))
        return row_hash(df.schema, parts, as_double=as_double)
    return fn


# -- fixed values: column lists and types --------------------------------------

SKATER_COLUMNS = {
    "url_index": LONG, "playerId": LONG, "headshot": STR, "positionCode": STR, "gamesPlayed": LONG,
    "goals": LONG, "assists": LONG, "points": LONG, "plusMinus": DBL,
    "penaltyMinutes": LONG, "powerPlayGoals": DBL, "shorthandedGoals": DBL,
    "gameWinningGoals": DBL, "overtimeGoals": DBL, "shots": DBL, "shootingPctg": DBL,
    "avgTimeOnIcePerGame": DBL, "avgShiftsPerGame": DBL, "faceoffWinPctg": DBL,
    "firstName": STR, "lastName": STR, "fullName": STR, "season": LONG,
    "gameType": LONG, "triCode": STR,
}
SKATER_HASH = [("gamesPlayed", LONG), ("goals", LONG), ("assists", LONG), ("points", LONG),
               ("plusMinus", DBL), ("penaltyMinutes", LONG), ("powerPlayGoals", DBL),
               ("shorthandedGoals", DBL), ("gameWinningGoals", DBL), ("overtimeGoals", DBL),
               ("shots", DBL), ("shootingPctg", DBL), ("avgTimeOnIcePerGame", DBL),
               ("avgShiftsPerGame", DBL), ("faceoffWinPctg", DBL)]

GOALIE_COLUMNS = {
    "playerId": LONG, "headshot": STR, "firstName": STR, "lastName": STR, "fullName": STR,
    "gamesPlayed": LONG, "gamesStarted": LONG, "wins": LONG, "losses": LONG,
    "overtimeLosses": DBL, "goalsAgainstAverage": DBL, "savePercentage": DBL,
    "shotsAgainst": DBL, "saves": DBL, "goalsAgainst": LONG, "shutouts": LONG,
    "goals": LONG, "assists": LONG, "points": LONG, "penaltyMinutes": LONG,
    "timeOnIce": LONG, "ties": DBL, "season": LONG, "gameType": LONG, "team": STR,
}
GOALIE_HASH = [("gamesPlayed", LONG), ("gamesStarted", LONG), ("wins", LONG), ("losses", LONG),
               ("overtimeLosses", DBL), ("goalsAgainstAverage", DBL), ("savePercentage", DBL),
               ("shotsAgainst", DBL), ("saves", DBL), ("goalsAgainst", LONG),
               ("shutouts", LONG), ("goals", LONG), ("assists", LONG), ("points", LONG),
               ("penaltyMinutes", LONG), ("timeOnIce", LONG), ("ties", DBL)]

PLAYER_RENAMES = {
    "fullTeamName": "fullTeamName.default", "firstName": "firstName.default",
    "lastName": "lastName.default", "birthCity": "birthCity.default",
    "birthStateProvince": "birthStateProvince.default", "draftYear": "draftDetails.year",
    "draftTeamAbbrev": "draftDetails.teamAbbrev", "draftRound": "draftDetails.round",
    "draftPickInRound": "draftDetails.pickInRound",
    "draftOverallPick": "draftDetails.overallPick",
}
PLAYER_COLUMNS = {
    "playerId": LONG, "isActive": BOOL, "currentTeamId": LONG, "currentTeamAbbrev": STR,
    "fullTeamName": STR, "firstName": STR, "lastName": STR, "sweaterNumber": INT,
    "position": STR, "headshot": STR, "heroImage": STR, "heightInInches": DBL,
    "heightInCentimeters": DBL, "weightInPounds": DBL, "weightInKilograms": DBL,
    "birthDate": DATE, "birthCity": STR, "birthStateProvince": STR, "birthCountry": STR,
    "shootsCatches": STR, "playerSlug": STR, "inTop100AllTime": BOOL, "inHHOF": BOOL,
    "draftYear": INT, "draftTeamAbbrev": STR, "draftRound": INT, "draftPickInRound": INT,
    "draftOverallPick": INT,
}
PLAYER_HASH = [("isActive", BOOL), ("currentTeamId", DBL), ("currentTeamAbbrev", STR),
               ("fullTeamName", STR), ("sweaterNumber", DBL), ("position", STR),
               ("headshot", STR), ("heroImage", STR), ("heightInInches", DBL),
               ("heightInCentimeters", DBL), ("weightInPounds", DBL),
               ("weightInKilograms", DBL), ("birthDate", STR), ("birthCity", STR),
               ("birthStateProvince", STR), ("birthCountry", STR), ("shootsCatches", STR),
               ("inTop100AllTime", LONG), ("inHHOF", LONG), ("draftYear", DBL),
               ("draftTeamAbbrev", STR), ("draftRound", DBL), ("draftPickInRound", DBL),
               ("draftOverallPick", DBL)]

ROSTER_COLUMNS = {
    "teamAbbreviation": STR, "positionGroup": STR, "playerId": LONG, "headshot": STR,
    "firstName": STR, "lastName": STR, "sweaterNumber": DBL, "positionCode": STR,
    "shootsCatches": STR, "heightInInches": LONG, "weightInPounds": LONG,
    "heightInCentimeters": LONG, "weightInKilograms": LONG, "birthDate": STR,
    "birthCity": STR, "birthCountry": STR, "birthStateProvince": STR,
}
ROSTER_HASH = [("teamAbbreviation", STR), ("positionGroup", STR), ("playerId", LONG),
               ("headshot", STR), ("firstName", STR), ("lastName", STR),
               ("sweaterNumber", STR), ("positionCode", STR), ("shootsCatches", STR),
               ("heightInInches", LONG), ("weightInPounds", LONG),
               ("heightInCentimeters", LONG), ("weightInKilograms", LONG),
               ("birthDate", STR), ("birthCity", STR), ("birthCountry", STR),
               ("birthStateProvince", STR)]

SEASON_KEY = ["playerId", "season", "sequence", "teamName.default", "gameTypeId",
              "leagueAbbrev"]
SEASON_SKATER_COLUMNS = {
    "playerId": LONG, "assists": LONG, "gameTypeId": LONG, "gamesPlayed": LONG,
    "goals": LONG, "leagueAbbrev": STR, "pim": LONG, "plusMinus": LONG, "points": LONG,
    "season": LONG, "sequence": LONG, "teamName.default": STR,
    "faceoffWinningPctg": DBL, "shootingPctg": DBL, "shots": DBL, "powerPlayGoals": DBL,
    "shorthandedGoals": DBL, "gameWinningGoals": DBL,
    "teamCommonName.default": STR, "teamCommonName.cs": STR, "teamCommonName.de": STR,
    "teamCommonName.es": STR, "teamCommonName.fi": STR, "teamCommonName.sk": STR,
    "teamCommonName.sv": STR, "teamName.cs": STR, "teamName.de": STR, "teamName.fi": STR,
    "teamName.sk": STR, "teamName.sv": STR, "teamPlaceNameWithPreposition.default": STR,
    "avgToi": DBL, "otGoals": DBL, "powerPlayPoints": DBL, "shorthandedPoints": DBL,
    "teamName.fr": STR, "teamPlaceNameWithPreposition.fr": STR, "teamCommonName.fr": STR,
    "teamPlaceNameWithPreposition.cs": STR, "teamPlaceNameWithPreposition.es": STR,
    "teamPlaceNameWithPreposition.fi": STR, "teamPlaceNameWithPreposition.sk": STR,
    "teamPlaceNameWithPreposition.sv": STR,
}
# the last three parts are the constant 0 the reference passes for otGoals,
# powerPlayPoints and shorthandedPoints
SEASON_SKATER_HASH = [("assists", DBL), ("gamesPlayed", DBL), ("goals", DBL), ("pim", DBL),
                      ("plusMinus", DBL), ("points", DBL), ("shots", DBL),
                      ("faceoffWinningPctg", DBL), ("shootingPctg", DBL),
                      ("powerPlayGoals", DBL), ("shorthandedGoals", DBL),
                      ("gameWinningGoals", DBL)]
SEASON_GOALIE_COLUMNS = {
    "playerId": LONG, "gameTypeId": LONG, "gamesPlayed": DBL, "goalsAgainst": DBL,
    "goalsAgainstAvg": DBL, "leagueAbbrev": STR, "losses": DBL, "season": LONG,
    "sequence": LONG, "shutouts": DBL, "ties": DBL, "timeOnIce": STR, "wins": DBL,
    "teamName.default": STR, "assists": DBL, "gamesStarted": DBL, "goals": DBL, "pim": DBL,
    "savePctg": DBL, "shotsAgainst": DBL, "teamCommonName.default": STR,
    "teamName.fr": STR, "teamPlaceNameWithPreposition.default": STR,
    "teamPlaceNameWithPreposition.fr": STR, "teamCommonName.cs": STR,
    "teamCommonName.de": STR, "teamCommonName.es": STR, "teamCommonName.fi": STR,
    "teamCommonName.sk": STR, "teamCommonName.sv": STR, "teamName.cs": STR,
    "teamName.de": STR, "teamName.fi": STR, "teamName.sk": STR, "teamName.sv": STR,
    "otLosses": DBL, "teamCommonName.fr": STR, "teamPlaceNameWithPreposition.cs": STR,
    "teamPlaceNameWithPreposition.es": STR, "teamPlaceNameWithPreposition.fi": STR,
    "teamPlaceNameWithPreposition.sk": STR, "teamPlaceNameWithPreposition.sv": STR,
}
SEASON_GOALIE_HASH = [("gamesPlayed", DBL), ("goalsAgainst", DBL), ("goalsAgainstAvg", DBL),
                      ("losses", DBL), ("shutouts", DBL), ("ties", DBL), ("wins", DBL),
                      ("assists", DBL), ("gamesStarted", DBL), ("goals", DBL), ("pim", DBL),
                      ("savePctg", DBL), ("shotsAgainst", DBL), ("otLosses", DBL),
                      ("timeOnIce", STR)]
# localised names that may be absent from a season_goalie staging batch
SEASON_GOALIE_OPTIONAL = {
    "teamCommonName.cs": STR, "teamCommonName.de": STR, "teamCommonName.es": STR,
    "teamCommonName.fi": STR, "teamCommonName.sk": STR, "teamCommonName.sv": STR,
    "teamCommonName.fr": STR, "teamName.cs": STR, "teamName.de": STR, "teamName.fi": STR,
    "teamName.sk": STR, "teamName.sv": STR, "teamPlaceNameWithPreposition.cs": STR,
    "teamPlaceNameWithPreposition.es": STR, "teamPlaceNameWithPreposition.fi": STR,
    "teamPlaceNameWithPreposition.sk": STR, "teamPlaceNameWithPreposition.sv": STR,
    "teamPlaceNameWithPreposition.fr": STR,
}

DRAFT_COLUMNS = {
    "draftYear": INT, "teamAbbrev": STR, "round": INT, "pickInRound": INT,
    "overallPick": INT, "ordinalPick": STR, "teamId": LONG, "teamName": STR,
    "teamCommonName": STR, "teamPlaceNameWithPreposition": STR, "displayAbbrev": STR,
    "teamLogoLight": STR, "teamLogoDark": STR, "firstName": STR, "lastName": STR,
    "positionCode": STR, "countryCode": STR, "height": DBL, "weight": DBL,
    "amateurLeague": STR, "amateurClubName": STR, "playerId": LONG,
}
GAME_COLUMNS = {
    "id": LONG, "season": INT, "gameType": INT, "gameDate": DATE, "gameState": STR,
    "gameScheduleState": STR, "startTimeUTC": TSTZ, "venueTimezone": STR,
    "neutralSite": BOOL, "venue_default": STR, "tvBroadcasts": STR, "awayTeam_id": INT,
    "awayTeam_abbrev": STR, "awayTeam_score": INT, "homeTeam_id": INT,
    "homeTeam_abbrev": STR, "homeTeam_score": INT, "periodDescriptor_periodType": STR,
    "gameOutcome_lastPeriodType": STR, "winningGoalie_playerId": LONG,
    "winningGoalScorer_playerId": LONG,
}
GAME_UPDATED = ["gameState", "gameScheduleState", "awayTeam_score", "homeTeam_score",
                "periodDescriptor_periodType", "gameOutcome_lastPeriodType",
                "winningGoalie_playerId", "winningGoalScorer_playerId", "tvBroadcasts"]
GAME_WATCHED = GAME_UPDATED[:-1]
TEAM_SEASON_STATS = {
    "faceoffWinPct": DBL, "gamesPlayed": INT, "goalsAgainst": INT,
    "goalsAgainstPerGame": DBL, "goalsFor": INT, "goalsForPerGame": DBL, "losses": INT,
    "otLosses": INT, "penaltyKillNetPct": DBL, "penaltyKillPct": DBL, "pointPct": DBL,
    "points": INT, "powerPlayNetPct": DBL, "powerPlayPct": DBL,
    "regulationAndOtWins": INT, "shotsAgainstPerGame": DBL, "shotsForPerGame": DBL,
    "teamShutouts": INT, "ties": INT, "wins": INT, "winsInRegulation": INT,
    "winsInShootout": INT,
}
TEAM_SEASON_COLUMNS = {"seasonId": STR, "teamId": LONG, "teamFullName": STR} \
    | TEAM_SEASON_STATS | {"gameTypeId": STR}


def _season_skater_hash(df: DataFrame) -> Column:
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = [(round_half_even_cast(c(n), _t(t), types[n]), _t(t)) for n, t in SEASON_SKATER_HASH]
    toi = c("avgToi").cast("string")
    parts.append((guarded_number(toi, 0.0), T.DoubleType()))
    parts += [(F.lit(0.0), T.DoubleType())] * 3
    return row_hash(df.schema, parts)


def _player_sources() -> dict:
    src = {new: (lambda old: (lambda df: c(old)))(old) for new, old in PLAYER_RENAMES.items()}
    src["birthDate"] = lambda df: guarded_date(c("birthDate").cast("string"))
    src["inTop100AllTime"] = lambda df: flag_bool(c("inTop100AllTime"))
    src["inHHOF"] = lambda df: flag_bool(c("inHHOF"))
    for n in ("currentTeamId", "sweaterNumber"):
        src[n] = (lambda n: lambda df: F.bround(c(n).cast("double"), 0))(n)
    for n in ("draftYear", "draftRound", "draftPickInRound", "draftOverallPick"):
        old = PLAYER_RENAMES[n]
        src[n] = (lambda old: lambda df: F.bround(c(old).cast("double"), 0))(old)
    return src


def _player_hash(df: DataFrame) -> Column:
    renamed = df.select("*", *[c(old).alias(new) for new, old in PLAYER_RENAMES.items()])
    types = {f.name: f.dataType for f in renamed.schema.fields}
    parts = []
    for name, t in PLAYER_HASH:
        col = c(PLAYER_RENAMES.get(name, name))
        if name == "birthDate":
            parts.append((col.cast("string"), T.StringType()))
        elif t == BOOL:
            parts.append((col.cast("boolean"), T.BooleanType()))
        else:
            parts.append((round_half_even_cast(col, _t(t), types[name]), _t(t)))
    return row_hash(df.schema, parts)


def _roster_hash(df: DataFrame) -> Column:
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = []
    for name, t in ROSTER_HASH:
        if name == "sweaterNumber":
            parts.append((canonical_text(c(name), types[name]), T.StringType()))
        else:
            parts.append((round_half_even_cast(c(name), _t(t), types[name]), _t(t)))
    return row_hash(df.schema, parts)


def _draft_sources() -> dict:
    def pick(df):
        t = df.schema["overallPick"].dataType
        return ordinal_label(blank_cast(c("overallPick"), "int", t))
    return {"ordinalPick": pick, "playerId": lambda df: F.lit(None)}


ENTITIES: dict[str, Entity] = {
    "skaters": Entity(
        "skaters", "scd2", ["playerId", "season", "gameType", "triCode"], SKATER_COLUMNS,
        sources={"url_index": lambda df: F.lit(None)},  # no sync fills it
        hash_fn=_typed_hash(SKATER_HASH), load_mode="reset"),
    "season_skater": Entity(
        "season_skater", "scd2", SEASON_KEY, SEASON_SKATER_COLUMNS,
        sources={"avgToi": lambda df: guarded_number(c("avgToi").cast("string"))},
        hash_fn=_season_skater_hash, load_mode="reset"),
    "season_goalie": Entity(
        "season_goalie", "scd2", SEASON_KEY, SEASON_GOALIE_COLUMNS,
        hash_fn=_typed_hash(SEASON_GOALIE_HASH), missing=dict(SEASON_GOALIE_OPTIONAL),
        load_mode="reset"),
    "goalies": Entity(
        "goalies", "scd1", ["playerId", "season", "gameType", "team"], GOALIE_COLUMNS,
        hash_fn=_typed_hash(GOALIE_HASH), missing={"ties": DBL}, load_mode="reset"),
    "players": Entity(
        "players", "version_set", ["playerId"], PLAYER_COLUMNS, sources=_player_sources(),
        hash_fn=_player_hash, family="versions", active_col=None, load_mode="reset", bucketed=True),
    "current_rosters": Entity(
        "current_rosters", "version_set", ["playerId", "teamAbbreviation"], ROSTER_COLUMNS,
        hash_fn=_roster_hash, family="roster", active_col="active", load_mode="reset",
        log="rosters_etl_log"),
    "drafts": Entity(
        "drafts", "upsert", ["draftYear", "teamAbbrev", "round", "pickInRound"],
        DRAFT_COLUMNS, sources=_draft_sources(), cast_mode="blank",
        not_null=["draftYear", "teamAbbrev", "round", "pickInRound"],
        update_cols=["playerId", "ordinalPick"], guarded=True, coalesce_updates=True,
        updated_name="updated_playerid_records", dedupe=(["playerId"], []), has_id=False,
        bucketed=True),
    "games": Entity(
        "games", "upsert", ["id"], GAME_COLUMNS, cast_mode="blank", required=["id"],
        sources={"neutralSite": lambda df: c("neutralSite").cast("boolean")},
        update_cols=GAME_UPDATED, watched=GAME_WATCHED, has_id=False, bucketed=True),
    "franchises": Entity(
        "franchises", "upsert", ["id"],
        {"id": LONG, "fullName": STR, "teamCommonName": STR, "teamPlaceName": STR},
        cast_mode="blank", required=["id"], not_null=["fullName"],
        update_cols=["fullName", "teamCommonName", "teamPlaceName"], has_id=False, bucketed=True),
    "team_season": Entity(
        "team_season", "upsert", ["seasonId", "teamId", "gameTypeId"], TEAM_SEASON_COLUMNS,
        cast_mode="blank", required=["seasonId", "teamId"],
        sources={"seasonId": lambda df: F.nullif(c("seasonId").cast("string"), F.lit(""))},
        update_cols=["teamFullName"] + list(TEAM_SEASON_STATS),
        dedupe=([], []), not_null=["seasonId", "teamId"], bucketed=True),
    "team_gametypes": Entity(
        "team_gametypes", "upsert", ["season", "teamId"],
        {"season": STR, "gameTypes": STR, "triCode": STR, "teamId": LONG},
        cast_mode="blank", required=["season"],
        sources={"season": lambda df: F.nullif(c("season").cast("string"), F.lit("")),
                 "teamId": lambda df: c("teamId") if "teamId" in df.columns else F.lit(None)},
        update_cols=["gameTypes", "triCode"], not_null=["season"], bucketed=True),
    "teams": Entity(
        "teams", "upsert", ["id"],
        {"id": LONG, "franchiseId": LONG, "fullName": STR, "leagueId": STR,
         "rawTricode": STR, "triCode": STR, "active": BOOL},
        cast_mode="blank", required=["id"],
        sources={"active": lambda df: c("active") if "active" in df.columns else F.lit(None)},
        update_cols=["franchiseId", "fullName", "leagueId", "rawTricode", "triCode"],
        has_id=False, bucketed=True),
}
