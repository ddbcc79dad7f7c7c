"""The sync jobs of every table, run twice on staging made from ``orders``.

A staging table is a projection of ``orders``: ``n`` is the order key, ``g``
a small number that stays the same over several rows of a key (so that
batches hold changed and unchanged rows), and every column of a spec is an
expression over them.  Key parts are NULL for some rows.  Load 1 holds two
thirds of the orders, load 2 another two, one third being in both.

Each job's SQL is generated from the same column lists, written for DuckDB
as one pass over both loads; the staging expressions are shared, the folds
are not.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.guards import ConstraintViolation
from tidemark.plans import entities as S
from tidemark.plans.entities import BOOL, DATE, DBL, ENTITIES, INT, LONG, STR, TSTZ
from tidemark.plans.jobs import run_sync, sync_all_teams
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources.store import TableStore

TS1, TS2 = "2024-06-01 00:00:00", "2024-06-02 00:00:00"
SQL1, SQL2 = f"TIMESTAMP '{TS1}'", f"TIMESTAMP '{TS2}'"
LOADS = {1: "o_orderkey % 3 <> 0", 2: "o_orderkey % 3 <> 1"}
#: All orders in one load, for jobs that run once.
WHOLE = "TRUE"
#: Distinct first key parts of a history table, and rows whose key is NULL.
KEYS, NULL_KEY = 997, "n % 101 = 0"


class Col(NamedTuple):
    """A column: its staging name and expression, its stored value and its
    text in the row hash, all over ``n`` and ``g`` in both engines' SQL."""
    name: str
    staged_name: str
    staged: str
    stored: str
    text: str | None


def double_text_sql(x: str) -> str:
    """A double's text as the reference database prints it, for DuckDB: its
    own text but for whole numbers, 1e15 to 1e16 and names."""
    digits = (f"rtrim(replace(regexp_replace(CAST(abs({x}) AS VARCHAR), '[.]0$', ''), '.', ''), '0')")
    return (f"CASE WHEN isnan({x}) THEN 'NaN' WHEN isinf({x}) THEN CASE WHEN {x} > 0 THEN 'Infinity' "
            f"ELSE '-Infinity' END WHEN abs({x}) >= 1e15 AND abs({x}) < 1e16 THEN "
            f"CASE WHEN {x} < 0 THEN '-' ELSE '' END || regexp_replace({digits}, '^(.)(.)', '\\1.\\2') "
            f"|| 'e+15' ELSE regexp_replace(CAST({x} AS VARCHAR), '[.]0$', '') END")


#: Factors of double columns, in turn: plain, tiny and large values.
DOUBLE_FACTORS = ("1", "1e-4", "3e15")


def _col(name: str, kind: str, i: int) -> Col:
    v = f"(g + {i}) % {2 + i % 4}"
    if kind in (LONG, INT):
        whole = f"CAST({v} AS {'BIGINT' if kind == LONG else 'INT'})"
        return Col(name, name, whole, whole, f"CAST({v} AS VARCHAR)")
    if kind == DBL:
        x = f"(CAST({v} AS DOUBLE) / 4 * CAST('{DOUBLE_FACTORS[i % 3]}' AS DOUBLE))"
        return Col(name, name, x, x, double_text_sql(x))
    if kind == BOOL:
        return Col(name, name, f"{v} = 0", f"{v} = 0",
                   f"CASE WHEN {v} = 0 THEN 'true' ELSE 'false' END")
    # a text that is missing in some rows
    x = f"CASE WHEN g = 3 THEN NULL ELSE concat('x', CAST({v} AS VARCHAR(9))) END"
    return Col(name, name, x, x, x)


def _key_col(name: str, kind: str, first: bool) -> Col:
    if first:
        v = f"CASE WHEN {NULL_KEY} THEN NULL ELSE n % {KEYS} END"
        whole = f"CAST({v} AS BIGINT)"
        return Col(name, name, whole, whole, f"CAST({whole} AS VARCHAR)")
    if kind == STR:
        x = "concat('k', CAST(n % 2 AS VARCHAR(9)))"
        return Col(name, name, x, x, x)
    return Col(name, name, "CAST(n % 2 AS BIGINT)", "CAST(n % 2 AS BIGINT)", "CAST(n % 2 AS VARCHAR)")


def _history_cols(name: str) -> list[Col]:
    e = ENTITIES[name]
    cols = []
    for i, (c, kind) in enumerate(e.columns.items()):
        if c in e.key:
            cols.append(_key_col(c, kind, c == e.key[0]))
        else:
            cols.append(_col(c, kind, i))
    by = {c.name: k for k, c in enumerate(cols)}

    def put(col: Col) -> None:
        cols[by[col.name]] = col
    if name == "skaters":
        put(Col("url_index", None, None, "CAST(NULL AS BIGINT)", None))
    if name == "season_skater":
        toi = "CASE g WHEN 0 THEN '12.5' WHEN 1 THEN 'n/a' WHEN 2 THEN '7' ELSE NULL END"
        put(Col("avgToi", "avgToi", toi, f"TRY_CAST({toi} AS DOUBLE)",
                "CASE g WHEN 0 THEN '12.5' WHEN 2 THEN '7' ELSE '0' END"))
    if name == "players":
        for i, (c, kind) in enumerate(e.columns.items()):
            old = S.PLAYER_RENAMES.get(c, c)
            v = f"((g + {i}) % {2 + i % 4})"
            if c in ("currentTeamId", "sweaterNumber", "draftYear", "draftRound",
                     "draftPickInRound", "draftOverallPick"):
                put(Col(c, old, f"CAST({v} AS DOUBLE)",
                        f"CAST({v} AS {'BIGINT' if kind == LONG else 'INT'})",
                        f"CAST({v} AS VARCHAR)"))
            elif c in ("inTop100AllTime", "inHHOF"):
                flag = f"(g + {i}) % 2"
                put(Col(c, old, f"CAST({flag} AS BIGINT)", f"{flag} = 1", f"CAST({flag} AS VARCHAR)"))
            elif c == "birthDate":
                day = f"concat('2000-01-0', CAST(1 + {v} AS VARCHAR(9)))"
                put(Col(c, old, day, f"CAST({day} AS DATE)", day))
            elif old != c:
                put(cols[by[c]]._replace(staged_name=old))
    return cols


def _hash_texts(name: str, cols: list[Col]) -> list[str]:
    by = {c.name: c for c in cols}
    parts = {"skaters": S.SKATER_HASH, "season_goalie": S.SEASON_GOALIE_HASH,
             "goalies": S.GOALIE_HASH, "players": S.PLAYER_HASH,
             "current_rosters": S.ROSTER_HASH,
             "season_skater": [*S.SEASON_SKATER_HASH, ("avgToi", DBL)]}[name]
    texts = [by[c].text for c, _ in parts]
    # three constant parts follow in this table
    return texts + (["'0'"] * 3 if name == "season_skater" else [])


G = "CASE WHEN n % 5 < 3 THEN 0 ELSE n % 4 END"


def staging(spark: SparkSession, sf: str, cols: list[Col], where: str, g: str = G) -> DataFrame:
    rows = (spark.read.parquet(f"{sf.rstrip('/')}/orders.parquet").where(where)
            .selectExpr("o_orderkey AS n").selectExpr("n", f"{g} AS g"))
    return rows.select(F.col("n").alias("staged_order"), *[
        F.expr(_spark(c.staged)).alias(c.staged_name) for c in cols if c.staged is not None])


def _spark(sql: str) -> str:
    return sql.replace("AS VARCHAR(9))", "AS STRING)").replace("AS VARCHAR)", "AS STRING)")


def _q(name: str) -> str:
    return f'"{name}"'


def _list(names, prefix: str = "") -> str:
    return ", ".join(prefix + _q(n) for n in names)


def _rows_sql(name: str, cols: list[Col]) -> str:
    """CTE ``b``: typed rows of both loads with their hash."""
    stored = ", ".join(f"{c.stored} AS {_q(c.name)}" for c in cols)
    texts = ", ".join(f"coalesce({t}, '')" for t in _hash_texts(name, cols))
    loads = " UNION ALL ".join(
        f"SELECT {k} AS load_no, o_orderkey AS n FROM orders WHERE {w}" for k, w in LOADS.items())
    return (f"a AS (SELECT load_no, n, {G} AS g FROM ({loads})),\n"
            f"b AS (SELECT load_no, n, {stored}, md5(concat_ws('|', {texts})) AS data_hash FROM a)")


def _whole(keys) -> str:
    return " AND ".join(f"{_q(k)} IS NOT NULL" for k in keys)


def _run(load: str) -> str:
    return f"CASE WHEN {load} = 1 THEN {SQL1} ELSE {SQL2} END"


def scd2_sql(name: str) -> str:
    e, cols = ENTITIES[name], _history_cols(name)
    keys, data = _list(e.key), _list(c.name for c in cols)
    return f"""WITH {_rows_sql(name, cols)},
s AS (SELECT *, lag(data_hash) OVER (PARTITION BY {keys} ORDER BY load_no, n) AS prev
      FROM b WHERE {_whole(e.key)}),
v AS (SELECT *, sum(CASE WHEN prev IS NULL OR prev <> data_hash THEN 1 ELSE 0 END)
                  OVER (PARTITION BY {keys} ORDER BY load_no, n ROWS UNBOUNDED PRECEDING) AS occ,
             (prev IS NULL OR prev <> data_hash) AS chg FROM s),
i AS (SELECT *, max(occ) OVER (PARTITION BY {keys}) AS mx,
             max(CASE WHEN load_no = 1 THEN occ END) OVER (PARTITION BY {keys}) AS mx1
      FROM v WHERE chg),
l2 AS (SELECT DISTINCT {keys}, TRUE AS seen FROM s WHERE load_no = 2)
SELECT {data}, CAST(occ AS INTEGER) AS occurrence_number, data_hash, occ = mx AS is_active,
  {_run('load_no')} AS created_at,
  CASE WHEN load_no = 2 OR (occ = mx1 AND seen) THEN {SQL2} ELSE {SQL1} END AS updated_at
FROM i LEFT JOIN l2 USING ({keys})
UNION ALL
SELECT {data}, 1, data_hash, TRUE, {_run('load_no')}, {_run('load_no')}
FROM b WHERE NOT ({_whole(e.key)})"""


def scd1_sql(name: str) -> str:
    e, cols = ENTITIES[name], _history_cols(name)
    keys, data = _list(e.key), _list(c.name for c in cols)
    return f"""WITH {_rows_sql(name, cols)},
s AS (SELECT *, lag(data_hash) OVER (PARTITION BY {keys} ORDER BY load_no, n) AS prev,
             min(load_no) OVER (PARTITION BY {keys}) AS l1, max(load_no) OVER (PARTITION BY {keys}) AS l2
      FROM b WHERE {_whole(e.key)}),
w AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY load_no DESC, n DESC) AS rk
      FROM s WHERE prev IS NULL OR prev <> data_hash)
SELECT {data}, CAST(1 AS INTEGER) AS occurrence_number, data_hash, TRUE AS is_active,
  {_run('l1')} AS created_at, {_run('l2')} AS updated_at
FROM w WHERE rk = 1
UNION ALL
SELECT {data}, 1, data_hash, TRUE, {_run('load_no')}, {_run('load_no')}
FROM b WHERE NOT ({_whole(e.key)})"""


def version_set_sql(name: str) -> str:
    e, cols = ENTITIES[name], _history_cols(name)
    keys, data = _list(e.key), _list(c.name for c in cols)
    roster = e.active_col is not None
    active = ", coalesce(seen, FALSE) AS active" if roster else ""
    # a roster switches every stored active row off first, which stamps it
    stamp = SQL2 if roster else f"CASE WHEN load_no = 2 OR seen THEN {SQL2} ELSE {SQL1} END"
    loose = ", load_no = 2" if roster else ""
    loose_stamp = SQL2 if roster else _run("load_no")
    return f"""WITH {_rows_sql(name, cols)},
f AS (SELECT *, row_number() OVER (PARTITION BY {keys}, data_hash ORDER BY load_no, n) AS rn
      FROM b WHERE {_whole(e.key)}),
o AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY load_no, n) AS occ
      FROM f WHERE rn = 1),
l2 AS (SELECT DISTINCT {keys}, data_hash, TRUE AS seen FROM f WHERE load_no = 2)
SELECT {data}, CAST(occ AS INTEGER) AS occurrence_number, data_hash{active},
  {_run('load_no')} AS created_at, {stamp} AS updated_at
FROM o LEFT JOIN l2 USING ({keys}, data_hash)
UNION ALL
SELECT {data}, 1, data_hash{loose}, {_run('load_no')}, {loose_stamp}
FROM b WHERE NOT ({_whole(e.key)})"""


# -- upserts -----------------------------------------------------------------

#: ``g`` of an upsert changes with the load for some rows.
UPSERT_G = "CASE WHEN n % 3 = 2 AND n % 4 < 2 THEN (n + {load}) % 4 ELSE n % 4 END"


def _upsert_cols(name: str) -> list[Col]:
    """Staged as texts, blank for a missing value."""
    e, cols = ENTITIES[name], []
    for i, (c, kind) in enumerate(e.columns.items()):
        v = f"(g + {i}) % {2 + i % 4}"
        if c == e.key[0]:
            whole = "CAST(n AS BIGINT)" if kind == LONG else "CAST(n AS VARCHAR)"
            cols.append(Col(c, c, f"CASE WHEN {NULL_KEY} THEN '' ELSE CAST(n AS VARCHAR(9)) END",
                            whole, None))
        elif c in e.key or c in e.not_null:
            text = "CAST(n % 5 AS VARCHAR(9))"
            stored = text if kind == STR else f"CAST(n % 5 AS {'BIGINT' if kind == LONG else 'INT'})"
            cols.append(Col(c, c, text, stored, None))
        elif kind == BOOL:
            cols.append(Col(c, c, f"{v} = 0", f"{v} = 0", None))
        elif kind in (DATE, TSTZ):
            day = f"concat('2024-01-0', CAST(1 + {v} AS VARCHAR(9)))"
            cols.append(Col(c, c, day, f"CAST({day} AS DATE)", None))
        elif kind == STR:
            x = f"concat('x', CAST({v} AS VARCHAR(9)))"
            cols.append(Col(c, c, f"CASE WHEN g = 3 THEN '' ELSE {x} END",
                            f"CASE WHEN g = 3 THEN NULL ELSE {x} END", None))
        else:
            num = f"CAST({v} AS {'DOUBLE' if kind == DBL else 'BIGINT' if kind == LONG else 'INT'})"
            cols.append(Col(c, c, f"CASE WHEN g = 3 THEN '' ELSE CAST({v} AS VARCHAR(9)) END",
                            f"CASE WHEN g = 3 THEN NULL ELSE {num} END", None))
    return cols


#: Columns left out of the comparison: instants, whose text differs by engine.
NOT_COMPARED = {"games": ["startTimeUTC"]}


def upsert_sql(name: str) -> str:
    e, cols = ENTITIES[name], _upsert_cols(name)
    load = {}
    for k, w in LOADS.items():
        stored = ", ".join(f"{c.stored} AS {_q(c.name)}" for c in cols)
        load[k] = (f"SELECT {stored} FROM (SELECT n, {UPSERT_G.format(load=k)} AS g FROM "
                   f"(SELECT o_orderkey AS n FROM orders WHERE {w})) WHERE NOT ({NULL_KEY})")
    watched = e.watched or e.update_cols
    diff = " OR ".join(f"o.{_q(c)} IS DISTINCT FROM m.{_q(c)}" for c in watched)
    out = []
    for c in cols:
        if c.name in NOT_COMPARED.get(name, ()):
            continue
        old, new = f"o.{_q(c.name)}", f"m.{_q(c.name)}"
        if c.name in e.update_cols:
            x = f"CASE WHEN st IN ('insert', 'update') THEN {new} ELSE {old} END"
        else:
            x = f"CASE WHEN st = 'insert' THEN {new} ELSE {old} END"
        out.append(f"{x} AS {_q(c.name)}")
    on = " AND ".join(f"o.{_q(k)} = m.{_q(k)}" for k in e.key)
    k0 = _q(e.key[0])
    return f"""WITH l1 AS ({load[1]}), l2 AS ({load[2]}),
j AS (SELECT o, m, CASE WHEN o.{k0} IS NULL THEN 'insert' WHEN m.{k0} IS NULL THEN 'stored'
                        WHEN {diff} THEN 'update' ELSE 'same' END AS st
      FROM l1 o FULL JOIN l2 m ON {on})
SELECT {', '.join(out)},
  CASE WHEN st = 'insert' THEN {SQL2} ELSE {SQL1} END AS created_at,
  CASE WHEN st IN ('insert', 'update') THEN {SQL2} ELSE {SQL1} END AS updated_at
FROM j"""


# -- drafts, and the chain of the team tables ----------------------------------

_PICK = "(1 + n % 120)"
DRAFT_KNOWN = {1: "n % 2 = 0", 2: "n % 4 < 3"}  # players known at each run


def _draft_staging(spark, sf, where):
    names = [c for c in ENTITIES["drafts"].columns if c not in ("ordinalPick", "playerId")]
    exprs = {"draftYear": "2000 + n % 5", "teamAbbrev": "concat('T', CAST(n % 3 AS STRING))",
             "round": "1 + n % 7", "pickInRound": "n", "overallPick": f"{_PICK}"}
    rows = (spark.read.parquet(f"{sf.rstrip('/')}/orders.parquet").where(where)
            .selectExpr("o_orderkey AS n"))
    return rows.select(*[F.expr(f"CAST({exprs[c]} AS STRING)" if c in exprs else "''").alias(c)
                         for c in names])


def _draft_players(spark, sf, run):
    # a fifth of the abbreviations are spelled otherwise: only the backfill,
    # which compares normalised texts, finds those players
    return (spark.read.parquet(f"{sf.rstrip('/')}/orders.parquet")
            .selectExpr("o_orderkey AS n").where(DRAFT_KNOWN[run])
            .selectExpr("n AS playerId", "CAST(2000 + n % 5 AS INT) AS draftYear",
                        "CASE WHEN n % 5 = 0 THEN concat(' t', CAST(n % 3 AS STRING), ' ') "
                        "ELSE concat('T', CAST(n % 3 AS STRING)) END AS draftTeamAbbrev",
                        "CAST(1 + n % 7 AS INT) AS draftRound", "CAST(n AS INT) AS draftPickInRound"))


def q_drafts(spark: SparkSession, sf: str) -> DataFrame:
    store = _store(spark)
    for load, ts in ((1, TS1), (2, TS2)):
        run_sync(spark, store, "drafts", _draft_staging(spark, sf, LOADS[load]), run_ts=_ts(ts),
                 extra_state={"players": _draft_players(spark, sf, load)})
    return store.read("drafts").select("draftYear", "teamAbbrev", "round", "pickInRound",
                                       "overallPick", "ordinalPick", "playerId", "created_at",
                                       "updated_at")


DRAFTS_SQL = f"""WITH r AS (SELECT o_orderkey AS n, {LOADS[1]} AS in1, {LOADS[2]} AS in2 FROM orders
                           WHERE {LOADS[1]} OR {LOADS[2]}),
p AS (SELECT *, {_PICK} AS pick, in1 AND {DRAFT_KNOWN[1]} AS had, {DRAFT_KNOWN[2]} AS known FROM r)
SELECT CAST(2000 + n % 5 AS INTEGER) AS "draftYear", 'T' || (n % 3) AS "teamAbbrev",
  CAST(1 + n % 7 AS INTEGER) AS round, CAST(n AS INTEGER) AS "pickInRound",
  CAST(pick AS INTEGER) AS "overallPick",
  pick || CASE WHEN pick % 100 IN (11, 12, 13) THEN 'th' WHEN pick % 10 = 1 THEN 'st'
               WHEN pick % 10 = 2 THEN 'nd' WHEN pick % 10 = 3 THEN 'rd' ELSE 'th' END AS "ordinalPick",
  CAST(CASE WHEN had OR known THEN n END AS BIGINT) AS "playerId",
  CASE WHEN in1 THEN {SQL1} ELSE {SQL2} END AS created_at,
  CASE WHEN NOT in1 OR (known AND NOT had) THEN {SQL2} ELSE {SQL1} END AS updated_at
FROM p"""


def q_drafts_backfill(spark: SparkSession, sf: str) -> DataFrame:
    """The backfill as a job of its own: drafts synced without any player,
    then the players' table, then ``backfill_drafts``."""
    from tidemark.plans.jobs import backfill_drafts
    store = _store(spark)
    run_sync(spark, store, "drafts", _draft_staging(spark, sf, WHOLE), run_ts=_ts(TS1))
    players = _draft_players(spark, sf, 2)
    store.commit({"players": store.write_version("players", players)})
    backfill_drafts(spark, store, run_ts=_ts(TS2))
    return store.read("drafts").select("pickInRound", "playerId", "updated_at")


DRAFTS_BACKFILL_SQL = f"""SELECT CAST(o_orderkey AS INTEGER) AS "pickInRound",
  CAST(CASE WHEN known THEN o_orderkey END AS BIGINT) AS "playerId",
  CASE WHEN known THEN {SQL2} ELSE {SQL1} END AS updated_at
FROM (SELECT o_orderkey, {DRAFT_KNOWN[2].replace('n ', 'o_orderkey ')} AS known
      FROM orders)"""


def q_drafts_refill(spark: SparkSession, sf: str) -> DataFrame:
    """Two backfills, players arriving before each: the second holds the
    players of the new segment alone against the drafts."""
    from tidemark.plans.jobs import backfill_drafts
    store = _store(spark)
    run_sync(spark, store, "drafts", _draft_staging(spark, sf, WHOLE), run_ts=_ts(TS1))
    players = _draft_players(spark, sf, 2)
    early = F.expr(f"playerId IS NOT NULL AND {DRAFT_KNOWN[1].replace('n ', 'playerId ')}")
    for rows, ts in ((players.where(early), TS1), (players.where(~early), TS2)):
        store.commit({"players": store.write_version("players", rows,
                                                     carry=store.segments("players"))})
        backfill_drafts(spark, store, run_ts=_ts(ts))
    return store.read("drafts").select("pickInRound", "playerId", "updated_at")


DRAFTS_REFILL_SQL = f"""SELECT CAST(n AS INTEGER) AS "pickInRound",
  CAST(CASE WHEN {DRAFT_KNOWN[2]} THEN n END AS BIGINT) AS "playerId",
  CASE WHEN {DRAFT_KNOWN[2]} AND NOT ({DRAFT_KNOWN[1]}) THEN {SQL2} ELSE {SQL1} END AS updated_at
FROM (SELECT o_orderkey AS n FROM orders)"""


def q_teams_chain(spark: SparkSession, sf: str) -> DataFrame:
    store = _store(spark)
    tables = {}
    for name in ("teams", "franchises", "team_season", "team_gametypes"):
        cols = _upsert_cols(name)
        rows = staging(spark, sf, cols, WHOLE, UPSERT_G.format(load=1))
        tables[name] = rows.drop("staged_order")
    # every code once in the franchises, so that the lookup finds one id
    tables["franchises"] = tables["franchises"].withColumn(
        "teamCommonName", F.concat(F.lit("C"), F.col("id")))
    tables["team_gametypes"] = tables["team_gametypes"].withColumn(
        "triCode", F.concat(F.lit("C"), F.col("season"))).drop("teamId")
    sync_all_teams(spark, store, tables, run_ts=_ts(TS1))
    return store.read("team_gametypes").select("season", "triCode", "teamId", "created_at")


TEAMS_CHAIN_SQL = f"""SELECT CAST(o_orderkey AS VARCHAR) AS season,
  'C' || o_orderkey AS "triCode", o_orderkey AS "teamId", {SQL1} AS created_at
FROM orders WHERE o_orderkey % 101 <> 0"""


def _ts(text: str):
    import datetime as dt
    return dt.datetime.fromisoformat(text)


def _store(spark: SparkSession) -> TableStore:
    return TableStore(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidemark-registry/"
                             f"{uuid.uuid4().hex}")


def _history_query(name: str):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        store, cols = _store(spark), _history_cols(name)
        for load, ts in ((1, TS1), (2, TS2)):
            run_sync(spark, store, name, staging(spark, sf, cols, LOADS[load]), run_ts=_ts(ts),
                     order_by="staged_order")
        return store.read(name).drop("id")
    return query


def _upsert_query(name: str):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        store, cols = _store(spark), _upsert_cols(name)
        for load, ts in ((1, TS1), (2, TS2)):
            rows = staging(spark, sf, cols, LOADS[load], UPSERT_G.format(load=load))
            if ENTITIES[name].dedupe is not None:  # repeated rows in the batch
                rows = rows.unionByName(rows.where("staged_order % 7 = 0"))
            run_sync(spark, store, name, rows, run_ts=_ts(ts))
        return store.read(name).drop("id" if ENTITIES[name].has_id else "_",
                                     *NOT_COMPARED.get(name, ()))
    return query


def q_refused_batch(spark: SparkSession, sf: str) -> DataFrame:
    """A batch that holds keys twice is refused whole: the table stays as
    the load before left it, and the log tells of no second run."""
    store, cols = _store(spark), _upsert_cols("franchises")
    loads = [staging(spark, sf, cols, WHOLE, UPSERT_G.format(load=k)) for k in (1, 2)]
    run_sync(spark, store, "franchises", loads[0], run_ts=_ts(TS1))
    twice = loads[1].unionByName(loads[1])
    refused = False
    try:
        run_sync(spark, store, "franchises", twice, run_ts=_ts(TS2))
    except ConstraintViolation:
        refused = True
    runs = store.read_log(ENTITIES["franchises"].log_name).count()
    return store.read("franchises").withColumns({"refused": F.lit(refused),
                                                 "runs": F.lit(runs).cast("bigint")})


REFUSED_BATCH_SQL = ("SELECT {stored}, {ts} AS created_at, {ts} AS updated_at, TRUE AS refused, "
                     "CAST(1 AS BIGINT) AS runs FROM (SELECT o_orderkey AS n, {g} AS g FROM "
                     "(SELECT o_orderkey, o_orderkey AS n FROM orders WHERE {load})) "
                     "WHERE NOT ({null})").format(
    stored=", ".join(f"{c.stored} AS {_q(c.name)}" for c in _upsert_cols("franchises")),
    ts=SQL1, g=UPSERT_G.format(load=1), load=WHOLE, null=NULL_KEY)


SCD2_JOBS = ("skaters", "season_skater", "season_goalie")
UPSERT_JOBS = ("games", "franchises", "team_season", "team_gametypes", "teams")
QUERIES = {
    **{f"job_{n}": _history_query(n) for n in (*SCD2_JOBS, "goalies", "players", "current_rosters")},
    **{f"job_{n}": _upsert_query(n) for n in UPSERT_JOBS},
    "job_drafts": q_drafts, "job_drafts_backfill": q_drafts_backfill,
    "job_drafts_refill": q_drafts_refill, "job_refused_batch": q_refused_batch,
    "job_teams_chain": q_teams_chain,
}
ORACLE_SQL = {
    **{f"job_{n}": scd2_sql(n) for n in SCD2_JOBS},
    "job_goalies": scd1_sql("goalies"),
    **{f"job_{n}": version_set_sql(n) for n in ("players", "current_rosters")},
    **{f"job_{n}": upsert_sql(n) for n in UPSERT_JOBS},
    "job_drafts": DRAFTS_SQL, "job_drafts_backfill": DRAFTS_BACKFILL_SQL,
    "job_drafts_refill": DRAFTS_REFILL_SQL, "job_refused_batch": REFUSED_BATCH_SQL,
    "job_teams_chain": TEAMS_CHAIN_SQL,
}
