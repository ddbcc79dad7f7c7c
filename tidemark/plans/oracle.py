"""DuckDB SQL for every query in ``registry.QUERIES``.

Tables are the driver's views (events, orders, ...).  Run timestamps are
the registry's fixed literals.  Numbers are rounded with integer
arithmetic so that both engines agree exactly.
"""

from __future__ import annotations

from tidemark.plans import job_queries
from tidemark.plans.job_queries import double_text_sql
from tidemark.plans.registry import SQL_TS0 as TS0, SQL_TS1 as TS1, SQL_TS2 as TS2, _double_sql

LOADS = """cut AS (SELECT (min(epoch_us(ts)) + max(epoch_us(ts))) // 2 AS c FROM events),
b AS (SELECT e.event_id, e.user_id, e.event_type, e.value,
             CAST(floor(e.value / 25) AS BIGINT) AS level,
             CASE WHEN epoch_us(e.ts) <= cut.c THEN 1 ELSE 2 END AS load_no
      FROM events e, cut)"""

EV = "event_id, user_id, event_type, value, level"


def _scd2(keys: str, hx: str) -> str:
    return f"""WITH {LOADS},
h AS (SELECT *, md5({hx}) AS data_hash FROM b),
s AS (SELECT *, lag(data_hash) OVER (PARTITION BY {keys} ORDER BY load_no, event_id) AS prev FROM h),
v AS (SELECT *, (prev IS NULL OR prev <> data_hash) AS chg,
             sum(CASE WHEN prev IS NULL OR prev <> data_hash THEN 1 ELSE 0 END)
               OVER (PARTITION BY {keys} ORDER BY load_no, event_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS occ
      FROM s),
ins AS (SELECT * FROM v WHERE chg),
mx AS (SELECT {keys}, max(occ) AS mx FROM ins GROUP BY {keys}),
mx1 AS (SELECT {keys}, max(occ) AS mx1 FROM ins WHERE load_no = 1 GROUP BY {keys}),
in2 AS (SELECT DISTINCT {keys}, TRUE AS seen2 FROM b WHERE load_no = 2),
state AS (
  SELECT ins.event_id, ins.user_id, ins.event_type, ins.value, ins.level,
         CAST(ins.occ AS INTEGER) AS occurrence_number, ins.data_hash,
         (ins.occ = mx.mx) AS is_active,
         CASE WHEN ins.load_no = 1 THEN {TS1} ELSE {TS2} END AS created_at,
         CASE WHEN ins.load_no = 2 OR (ins.occ = mx1.mx1 AND in2.seen2) THEN {TS2}
              ELSE {TS1} END AS updated_at
  FROM ins JOIN mx USING ({keys}) LEFT JOIN mx1 USING ({keys}) LEFT JOIN in2 USING ({keys}))
"""


SCD2 = _scd2("user_id", "coalesce(event_type, '')")
STAT = _scd2("user_id, event_type", "coalesce(CAST(level AS VARCHAR), '')")

VERSIONS = f"""WITH {LOADS},
h AS (SELECT *, md5(coalesce(event_type, '') || '|' || coalesce(CAST(level AS VARCHAR), ''))
        AS data_hash FROM b),
f AS (SELECT *, row_number() OVER (PARTITION BY user_id, data_hash ORDER BY load_no, event_id) AS rn
      FROM h),
fa AS (SELECT * FROM f WHERE rn = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY load_no, event_id) AS occ FROM fa),
seen2 AS (SELECT DISTINCT user_id, data_hash, TRUE AS hit FROM h WHERE load_no = 2),
state AS (
  SELECT o.event_id, o.user_id, o.event_type, o.value, o.level,
         CAST(o.occ AS INTEGER) AS occurrence_number, o.data_hash,
         CASE WHEN o.load_no = 1 THEN {TS1} ELSE {TS2} END AS created_at,
         CASE WHEN o.load_no = 2 OR seen2.hit THEN {TS2} ELSE {TS1} END AS updated_at,
         {TS2} AS roster_updated_at,
         coalesce(seen2.hit, FALSE) AS active
  FROM o LEFT JOIN seen2 USING (user_id, data_hash))
"""

VERSION_METRICS = """SELECT CAST(l.n AS BIGINT) AS total_processed,
       CAST(coalesce(i.nw, 0) AS BIGINT) AS new_records,
       0 AS updated_records,
       CAST(l.n - coalesce(i.ins, 0) AS BIGINT) AS unchanged_records,
       CAST(coalesce(i.oc, 0) AS BIGINT) AS new_occurrences{extra},
       l.load_no
FROM (SELECT load_no, count(*) AS n FROM b GROUP BY load_no) l
LEFT JOIN (SELECT load_no, count(*) AS ins, count(*) FILTER (WHERE occ = 1) AS nw,
                  count(*) FILTER (WHERE occ > 1) AS oc FROM o GROUP BY load_no) i
USING (load_no)"""

SCD1 = f"""WITH {LOADS},
h AS (SELECT *, md5(coalesce(event_type, '')) AS data_hash FROM b),
s AS (SELECT *, lag(data_hash) OVER (PARTITION BY user_id ORDER BY load_no, event_id) AS prev FROM h),
v AS (SELECT *, (prev IS NULL OR prev <> data_hash) AS chg FROM s),
w AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY load_no DESC, event_id DESC) AS rk
      FROM v WHERE chg),
span AS (SELECT user_id, min(load_no) AS l1, max(load_no) AS l2 FROM b GROUP BY user_id)
"""

SCD_METRICS = """SELECT CAST(count(*) AS BIGINT) AS total_processed,
       CAST(count(*) FILTER (WHERE {new}) AS BIGINT) AS new_records,
       CAST(count(*) FILTER (WHERE chg AND prev IS NOT NULL) AS BIGINT) AS updated_records,
       CAST(count(*) FILTER (WHERE NOT chg) AS BIGINT) AS unchanged_records,
       CAST(count(*) FILTER (WHERE {occ}) AS BIGINT) AS new_occurrences,
       load_no
FROM v GROUP BY load_no"""

PROG_COLS = ("user_id, event_type, occurrence_number, created_at, updated_at, level, event_id,"
             " lag(level) OVER (PARTITION BY user_id, event_type ORDER BY occurrence_number)"
             " AS prev_level,"
             " lag(event_id) OVER (PARTITION BY user_id, event_type ORDER BY occurrence_number)"
             " AS prev_event_id")

DATE_RANGE = ("CAST(CAST(min(created_at) AS DATE) AS VARCHAR) || ' to ' || "
              "CAST(CAST(max(updated_at) AS DATE) AS VARCHAR) AS date_range")


def _upsert_customer(select: str) -> str:
    return f"""WITH st AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
            FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'),
bt AS (SELECT c_custkey,
              CASE WHEN c_mktsegment = 'MACHINERY' THEN c_name || ' II' ELSE c_name END AS c_name,
              c_nationkey,
              CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal,
              c_mktsegment
       FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')),
m AS (SELECT o.c_custkey AS ok, n.c_custkey AS nk, o.c_name AS o_name, n.c_name AS n_name,
             o.c_nationkey AS o_nat, n.c_nationkey AS n_nat, o.c_acctbal AS o_bal,
             n.c_acctbal AS n_bal, o.c_mktsegment AS o_seg, n.c_mktsegment AS n_seg,
             CASE WHEN o.c_custkey IS NULL THEN 'insert'
                  WHEN n.c_custkey IS NULL THEN 'stored'
                  WHEN o.c_acctbal IS DISTINCT FROM n.c_acctbal
                    OR o.c_nationkey IS DISTINCT FROM n.c_nationkey THEN 'update'
                  ELSE 'unchanged' END AS status
      FROM st o FULL JOIN bt n ON o.c_custkey = n.c_custkey)
{select}"""


UPSERT_STATE = _upsert_customer(f"""SELECT
  CASE WHEN status = 'insert' THEN nk ELSE ok END AS c_custkey,
  CASE WHEN status = 'insert' THEN n_name ELSE o_name END AS c_name,
  CASE WHEN status IN ('insert', 'update') THEN n_nat ELSE o_nat END AS c_nationkey,
  CASE WHEN status IN ('insert', 'update') THEN n_bal ELSE o_bal END AS c_acctbal,
  CASE WHEN status = 'insert' THEN n_seg ELSE o_seg END AS c_mktsegment,
  CASE WHEN status = 'insert' THEN {TS1} ELSE {TS0} END AS created_at,
  CASE WHEN status IN ('insert', 'update') THEN {TS1} ELSE {TS0} END AS updated_at
FROM m""")

UPSERT_METRICS = _upsert_customer("""SELECT
  CAST(count(*) FILTER (WHERE status <> 'stored') AS BIGINT) AS total_processed,
  CAST(count(*) FILTER (WHERE status = 'insert') AS BIGINT) AS inserted_records,
  CAST(count(*) FILTER (WHERE status = 'update') AS BIGINT) AS updated_records,
  CAST(count(*) FILTER (WHERE status = 'unchanged') AS BIGINT) AS unchanged_records
FROM m""")


def _guarded(select: str) -> str:
    return f"""WITH st AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority
            FROM orders WHERE o_orderpriority <> '3-MEDIUM'),
bt AS (SELECT o_orderkey,
              CASE WHEN o_orderstatus = 'P' THEN NULL
                   WHEN o_orderstatus = 'F' THEN o_custkey + 1 ELSE o_custkey END AS o_custkey,
              o_orderstatus,
              CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority END
                AS o_orderpriority
       FROM orders),
m AS (SELECT o.o_orderkey AS ok, n.o_orderkey AS nk, o.o_custkey AS oc, n.o_custkey AS nc,
             o.o_orderstatus AS os, n.o_orderstatus AS ns, o.o_orderpriority AS op,
             n.o_orderpriority AS np,
             CASE WHEN o.o_orderkey IS NULL THEN 'insert'
                  WHEN n.o_orderkey IS NULL THEN 'stored'
                  WHEN (n.o_custkey IS NOT NULL AND o.o_custkey IS DISTINCT FROM n.o_custkey)
                    OR (n.o_orderpriority IS NOT NULL
                        AND o.o_orderpriority IS DISTINCT FROM n.o_orderpriority) THEN 'update'
                  ELSE 'unchanged' END AS status
      FROM st o FULL JOIN bt n ON o.o_orderkey = n.o_orderkey)
{select}"""


GUARDED_STATE = _guarded(f"""SELECT
  CASE WHEN status = 'insert' THEN nk ELSE ok END AS o_orderkey,
  CASE WHEN status = 'insert' THEN nc WHEN status = 'update' THEN coalesce(nc, oc) ELSE oc END
    AS o_custkey,
  CASE WHEN status = 'insert' THEN ns ELSE os END AS o_orderstatus,
  CASE WHEN status = 'insert' THEN np WHEN status = 'update' THEN coalesce(np, op) ELSE op END
    AS o_orderpriority,
  CASE WHEN status = 'insert' THEN {TS1} ELSE {TS0} END AS created_at,
  CASE WHEN status IN ('insert', 'update') THEN {TS1} ELSE {TS0} END AS updated_at
FROM m""")

GUARDED_METRICS = _guarded("""SELECT
  CAST(count(*) FILTER (WHERE status <> 'stored') AS BIGINT) AS total_processed,
  CAST(count(*) FILTER (WHERE status = 'insert') AS BIGINT) AS inserted_records,
  CAST(count(*) FILTER (WHERE status = 'update') AS BIGINT) AS updated_playerid_records,
  CAST(count(*) FILTER (WHERE status = 'unchanged') AS BIGINT) AS unchanged_records
FROM m""")

BACKFILL = """WITH t AS (
  SELECT o.o_orderkey,
         CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN NULL ELSE o.o_custkey END
           AS o_custkey,
         '  ' || lower(c.c_name) || ' ' AS cust_text, c.c_nationkey AS nation
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey),
src AS (SELECT upper(trim(c_name)) AS k1, c_nationkey AS k2, max(c_custkey) AS fill
        FROM customer WHERE c_custkey IS NOT NULL GROUP BY 1, 2)
"""

DAILY = """WITH d AS (
  SELECT CAST(ts AS DATE) AS day, max(ts) AS run_timestamp, count(*) AS total,
         count(*) FILTER (WHERE event_type = 'click') AS nw,
         count(*) FILTER (WHERE event_type = 'view') AS upd,
         count(*) FILTER (WHERE event_type = 'error') AS oc,
         max(epoch_us(ts)) - min(epoch_us(ts)) AS span_us
  FROM events GROUP BY 1)
"""


def _pct(num: str) -> str:
    return (f"CASE WHEN total > 0 THEN CAST(CAST((2000 * ({num}) + total) // (2 * total)"
            f" AS DECIMAL(18,0)) * 0.1 AS DECIMAL(10,1)) ELSE CAST(0 AS DECIMAL(10,1)) END"
            f" AS change_percentage")


_DUR = ("CAST(span_us * 0.000001 AS DECIMAL(18,6)) AS run_duration, "
        "CAST(CAST((span_us + 5000) // 10000 AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2))"
        " AS duration_seconds")
_ID = "CAST(date_diff('day', DATE '1970-01-01', day) AS BIGINT) AS id"

LI_ORDER = ("l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, l_linenumber DESC NULLS LAST,"
            " l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST,"
            " l_discount DESC NULLS LAST, l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST,"
            " l_linestatus DESC NULLS LAST, l_shipdate DESC NULLS LAST")

NUM_TEXT = """WITH t AS (SELECT event_id,
  CASE event_type
    WHEN 'view' THEN CAST(user_id AS VARCHAR) || ':' || regexp_extract(props, '(\\d+)', 1)
    WHEN 'error' THEN regexp_extract(props, '(\\d+)', 1) || '.' || CAST(user_id AS VARCHAR)
    WHEN 'signup' THEN NULL
    WHEN 'purchase' THEN '-' || regexp_extract(props, '(\\d+)', 1)
    ELSE regexp_extract(props, '(\\d+)', 1) END AS txt
  FROM events)
"""


def _ord(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN NULL ELSE CAST({x} AS VARCHAR) || CASE"
            f" WHEN {x} % 10 = 1 AND {x} % 100 <> 11 THEN 'st'"
            f" WHEN {x} % 10 = 2 AND {x} % 100 <> 12 THEN 'nd'"
            f" WHEN {x} % 10 = 3 AND {x} % 100 <> 13 THEN 'rd' ELSE 'th' END END")


HASH_EXPR = ("md5(coalesce(CAST(o_orderkey AS VARCHAR), '') || '|' ||"
             " coalesce(CAST(o_custkey AS VARCHAR), '') || '|' || coalesce(o_orderstatus, '')"
             " || '|' || coalesce(o_orderpriority, ''))")

JOB_HISTORY = STAT + """, ids AS (
  SELECT s.*, CAST(row_number() OVER (PARTITION BY s.created_at
                                      ORDER BY s.user_id, s.event_type, s.occurrence_number)
                   + CASE WHEN s.created_at = """ + TS2 + """
                          THEN (SELECT count(*) FROM state WHERE created_at = """ + TS1 + """)
                          ELSE 0 END AS BIGINT) AS id
  FROM state s)
"""

_RUN = f"CASE WHEN load_no = 1 THEN {TS1} ELSE {TS2} END"

# a key with many single versions, NULL in its last part for some rows; every
# event is a version of its own
SPARSE = f"""WITH {LOADS},
c AS (SELECT * EXCLUDE (level), CASE WHEN event_id % 50 <> 0 THEN level END AS level FROM b),
o AS (SELECT *, CASE WHEN level IS NULL THEN 1 ELSE row_number() OVER (
               PARTITION BY user_id, event_type, level ORDER BY load_no, event_id) END AS occ,
             level IS NULL OR row_number() OVER (
               PARTITION BY user_id, event_type, level ORDER BY load_no DESC, event_id DESC) = 1
               AS is_active,
             row_number() OVER (PARTITION BY user_id, event_type, level, load_no
                                ORDER BY event_id DESC) = 1 AS last_of_load,
             max(load_no) OVER (PARTITION BY user_id, event_type, level) AS last_load
      FROM c),
state AS (SELECT event_id, user_id, event_type, value, level, CAST(occ AS INTEGER) AS occurrence_number,
                 md5(CAST(event_id AS VARCHAR)) AS data_hash, is_active, {_RUN} AS created_at,
                 CASE WHEN load_no = 2 OR (level IS NOT NULL AND last_of_load AND last_load = 2)
                      THEN {TS2} ELSE {TS1} END AS updated_at FROM o)
"""

# load 2 meets keys without an active version
REOPENED = f"""WITH {LOADS},
h AS (SELECT *, md5(coalesce(event_type, '')) AS data_hash FROM b),
s AS (SELECT *, lag(data_hash) OVER (PARTITION BY user_id, load_no ORDER BY event_id) AS prev FROM h),
v AS (SELECT * FROM s WHERE prev IS NULL OR prev <> data_hash),
o AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY load_no, event_id) AS occ,
             row_number() OVER (PARTITION BY user_id, load_no ORDER BY event_id DESC) AS back,
             min(load_no) OVER (PARTITION BY user_id) AS first_load
      FROM v)
"""

# load 2 alone, folded into nothing
RESET = f"""WITH {LOADS},
h AS (SELECT *, md5(coalesce(CAST(level AS VARCHAR), '')) AS data_hash FROM b WHERE load_no = 2),
s AS (SELECT *, lag(data_hash) OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS prev FROM h),
o AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS occ,
             row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) AS back
      FROM s WHERE prev IS NULL OR prev <> data_hash)
SELECT event_id, user_id, event_type, value, level, CAST(occ AS INTEGER) AS occurrence_number,
  data_hash, back = 1 AS is_active, {TS2} AS created_at, {TS2} AS updated_at,
  row_number() OVER (ORDER BY user_id, event_type, occ) AS id
FROM o"""

ORACLE_SQL = {
    "blank_cast": """SELECT o_orderkey,
  CAST(NULLIF(CASE WHEN o_orderpriority = '5-LOW' THEN '' ELSE CAST(o_custkey AS VARCHAR) END, '')
       AS BIGINT) AS o_custkey,
  CAST(NULLIF(CASE WHEN o_orderstatus = 'P' THEN ''
                   ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END, '') AS DATE) AS o_orderdate,
  CAST(floor(o_totalprice) AS BIGINT) AS whole_price,
  CAST(round_even(o_totalprice, 0) AS BIGINT) AS rounded_price
FROM orders""",
    "required_keys": """SELECT * FROM (SELECT
  CAST(NULLIF(CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN ''
                   ELSE CAST(o_orderkey AS VARCHAR) END, '') AS BIGINT) AS o_orderkey,
  o_custkey, o_orderstatus FROM orders) WHERE o_orderkey IS NOT NULL""",
    "ordinal_label": f"SELECT o_orderkey, {_ord('o_orderkey')} AS ordinal FROM orders",
    "guarded_number": NUM_TEXT + """SELECT event_id, txt,
  CASE WHEN regexp_matches(txt, '^\\d+(\\.\\d+)?$') THEN CAST(txt AS DOUBLE) END AS num_or_null,
  CASE WHEN regexp_matches(txt, '^\\d+(\\.\\d+)?$') THEN CAST(txt AS DOUBLE) ELSE 0.0 END
    AS num_or_zero
FROM t""",
    "flag_date_guard": """WITH d AS (SELECT o_orderkey,
  CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS flag_num,
  CASE o_orderpriority WHEN '1-URGENT' THEN '' WHEN '2-HIGH' THEN NULL
       ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS date_text
  FROM orders)
SELECT o_orderkey, (flag_num = 1) AS is_final,
  CASE WHEN date_text IS NOT NULL AND date_text <> '' THEN CAST(date_text AS DATE) END AS order_date,
  CAST(CASE WHEN date_text IS NOT NULL AND date_text <> '' THEN CAST(date_text AS DATE) END
       AS VARCHAR) AS order_day
FROM d""",
    "dotted_rename": """SELECT c_custkey AS id, c_name AS name_default, c_acctbal AS balance,
  CAST(NULL AS DOUBLE) AS ties, CAST(NULL AS VARCHAR) AS notes FROM customer""",
    "row_hash": f"""WITH h AS (SELECT o_orderkey,
  CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey, o_orderstatus,
  CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS o_orderpriority FROM orders)
SELECT o_orderkey, {HASH_EXPR} AS row_hash, {HASH_EXPR} AS row_hash_dbl FROM h""",
    "double_text": f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, text,
  md5(concat_ws('|', coalesce(text, ''), coalesce(CAST(l_partkey AS VARCHAR), ''))) AS row_hash
FROM (SELECT *, {double_text_sql('x')} AS text FROM (
  SELECT *, {_double_sql("CAST('{}' AS DOUBLE)", "list_extract([{}], {})")} AS x FROM lineitem))""",
    "dedupe_first": f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
  l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LI_ORDER}) AS rn
      FROM lineitem) WHERE rn = 1""",
    "lookup_left": """SELECT o.o_orderkey, o.o_custkey, c.c_name, c.c_nationkey
FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment <> 'AUTOMOBILE') c
  ON o.o_custkey = c.c_custkey""",
    "lookup_multi": """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
  o.o_orderpriority, o.o_custkey
FROM lineitem l LEFT JOIN orders o
  ON l.l_orderkey = CAST(CAST(o.o_orderkey AS VARCHAR) AS BIGINT)
 AND l.l_returnflag = CASE WHEN o.o_orderstatus = 'F' THEN 'R' ELSE 'N' END""",
    "surrogate_ids": """SELECT o_orderkey, o_custkey,
  CAST(1000 + row_number() OVER (ORDER BY o_custkey ASC NULLS LAST, o_orderkey ASC NULLS LAST)
       AS BIGINT) AS id
FROM orders""",
    "null_counts": """WITH h AS (SELECT o_orderkey,
  CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey, o_orderstatus,
  CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS o_orderpriority FROM orders)
SELECT count(*) FILTER (WHERE o_orderkey IS NULL) AS o_orderkey,
  count(*) FILTER (WHERE o_custkey IS NULL) AS o_custkey,
  count(*) FILTER (WHERE o_orderstatus IS NULL) AS o_orderstatus,
  count(*) FILTER (WHERE o_orderpriority IS NULL) AS o_orderpriority FROM h""",
    "key_violations": """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "scd2_state": SCD2 + "SELECT * FROM state",
    "scd2_metrics": SCD2 + SCD_METRICS.format(new="chg AND occ = 1", occ="chg AND occ > 1"),
    "stat_history": STAT + "SELECT * FROM state",
    "current": STAT + "SELECT * FROM state WHERE is_active",
    "version_set_state": VERSIONS + f"SELECT {EV}, occurrence_number, data_hash, created_at,"
                                    " updated_at FROM state",
    "version_set_metrics": VERSIONS + VERSION_METRICS.format(extra=""),
    "latest": VERSIONS + f"""SELECT s.event_id, s.user_id, s.event_type, s.value, s.level,
  s.occurrence_number, s.data_hash, s.created_at, s.updated_at
FROM state s JOIN (SELECT user_id, max(occurrence_number) AS m FROM state GROUP BY user_id) x
  ON s.user_id = x.user_id AND s.occurrence_number = x.m""",
    "roster_state": VERSIONS + f"SELECT {EV}, occurrence_number, data_hash, active, created_at,"
                               " roster_updated_at AS updated_at FROM state",
    "roster_active": VERSIONS + f"SELECT {EV}, occurrence_number, data_hash, active, created_at,"
                                " roster_updated_at AS updated_at FROM state WHERE active",
    "roster_inactive": VERSIONS + f"SELECT {EV}, occurrence_number, data_hash, active,"
                                  " created_at, roster_updated_at AS updated_at FROM state"
                                  " WHERE NOT active",
    "roster_metrics": VERSIONS + VERSION_METRICS.format(
        extra=",\n       CAST(CASE WHEN l.load_no = 1 THEN 0 ELSE"
              " (SELECT count(*) FROM state WHERE NOT active) END AS BIGINT)"
              " AS deactivated_records"),
    "team_roster_summary": VERSIONS + """, r AS (
  SELECT event_type AS team, active,
         CASE WHEN level < 5 THEN 'forwards' WHEN level < 10 THEN 'defensemen'
              ELSE 'goalies' END AS grp
  FROM state)
SELECT team AS teamAbbreviation,
  count(*) FILTER (WHERE active) AS active_players,
  count(*) FILTER (WHERE NOT active) AS inactive_players,
  count(*) FILTER (WHERE active AND grp = 'forwards') AS active_forwards,
  count(*) FILTER (WHERE active AND grp = 'defensemen') AS active_defensemen,
  count(*) FILTER (WHERE active AND grp = 'goalies') AS active_goalies
FROM r GROUP BY team""",
    "scd1_state": SCD1 + f"""SELECT w.event_id, w.user_id, w.event_type, w.value, w.level,
  CAST(1 AS INTEGER) AS occurrence_number, w.data_hash, TRUE AS is_active,
  CASE WHEN span.l1 = 1 THEN {TS1} ELSE {TS2} END AS created_at,
  CASE WHEN span.l2 = 2 THEN {TS2} ELSE {TS1} END AS updated_at
FROM w JOIN span USING (user_id) WHERE w.rk = 1""",
    "scd1_metrics": SCD1 + SCD_METRICS.format(new="chg AND prev IS NULL", occ="FALSE"),
    "progression_player": STAT + f"""SELECT {PROG_COLS} FROM state
WHERE user_id IN (SELECT user_id FROM state GROUP BY user_id, event_type HAVING count(*) > 1)""",
    "progression_key": STAT + f"""SELECT {PROG_COLS} FROM state
WHERE EXISTS (SELECT 1 FROM (SELECT user_id, event_type FROM state
                             GROUP BY user_id, event_type HAVING count(*) > 1) r
              WHERE r.user_id = state.user_id AND r.event_type = state.event_type)""",
    "occurrence_stats": STAT + f"""SELECT user_id AS player_id, event_type AS team,
  CAST(count(*) AS INTEGER) AS total_occurrences, {DATE_RANGE},
  'Level: ' || CAST(min(level) AS VARCHAR) || '->' || CAST(max(level) AS VARCHAR) ||
  ', Value: ' || CAST(min(event_id) AS VARCHAR) || '->' || CAST(max(event_id) AS VARCHAR) ||
  ', Avg: ' || CAST(round(CAST(CAST(min(value) AS VARCHAR) AS DECIMAL(38,18)), 3) AS VARCHAR)
  || '->' || CAST(round(CAST(CAST(max(value) AS VARCHAR) AS DECIMAL(38,18)), 3) AS VARCHAR)
    AS stat_progression
FROM state GROUP BY user_id, event_type HAVING count(*) > 1""",
    "roster_occurrence_stats": VERSIONS + f"""SELECT user_id,
  CAST(count(*) AS INTEGER) AS total_occurrences,
  CAST(CAST(min(created_at) AS DATE) AS VARCHAR) || ' to ' ||
    CAST(CAST(max(roster_updated_at) AS DATE) AS VARCHAR) AS date_range,
  bool_or(active) AS is_active
FROM state GROUP BY user_id HAVING count(*) > 1""",
    "keyed_upsert_state": UPSERT_STATE,
    "keyed_upsert_metrics": UPSERT_METRICS,
    "guarded_upsert": GUARDED_STATE,
    "guarded_upsert_metrics": GUARDED_METRICS,
    "backfill": BACKFILL + f"""SELECT t.o_orderkey, coalesce(t.o_custkey, src.fill) AS o_custkey,
  t.cust_text, t.nation,
  CASE WHEN t.o_custkey IS NULL AND src.fill IS NOT NULL THEN {TS1} ELSE {TS0} END AS updated_at
FROM t LEFT JOIN src
  ON t.o_custkey IS NULL AND upper(trim(t.cust_text)) = src.k1 AND t.nation = src.k2""",
    "backfill_count": BACKFILL + """SELECT CAST(count(*) AS BIGINT) AS filled_records
FROM t JOIN src ON t.o_custkey IS NULL AND upper(trim(t.cust_text)) = src.k1 AND t.nation = src.k2""",
    "conditional_summary": """SELECT l_returnflag, l_linestatus,
  count(*) AS line_count,
  count(*) FILTER (WHERE l_discount > 0.05) AS discounted,
  count(*) FILTER (WHERE l_quantity >= 25) AS large,
  count(*) FILTER (WHERE l_discount > 0.05 AND l_quantity >= 25) AS discounted_large,
  count(*) FILTER (WHERE l_tax > 0) AS taxed
FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "dated_listing": """SELECT o_orderkey AS order_id, o_orderdate AS order_date,
  o_custkey AS customer, o_orderstatus AS status, o_orderpriority AS priority FROM orders""",
    "etl_summary": DAILY + f"""SELECT {_ID}, run_timestamp,
  CAST(total AS BIGINT) AS total_processed, CAST(nw AS BIGINT) AS new_records,
  CAST(total - nw - upd - oc AS BIGINT) AS unchanged_records,
  CAST(oc AS BIGINT) AS new_occurrences, {_DUR}, {_pct('nw + oc')}
FROM d""",
    "job_history": JOB_HISTORY + "SELECT * FROM ids",
    "job_log": STAT + f"""SELECT CAST(load_no AS BIGINT) AS id,
  CASE WHEN load_no = 1 THEN {TS1} ELSE {TS2} END AS run_timestamp,
  CAST(count(*) AS BIGINT) AS total_processed,
  CAST(count(*) FILTER (WHERE chg AND occ = 1) AS BIGINT) AS new_records,
  CAST(count(*) FILTER (WHERE chg AND prev IS NOT NULL) AS BIGINT) AS updated_records,
  CAST(count(*) FILTER (WHERE NOT chg) AS BIGINT) AS unchanged_records,
  CAST(count(*) FILTER (WHERE chg AND occ > 1) AS BIGINT) AS new_occurrences,
  CAST(NULL AS VARCHAR) AS notes
FROM v GROUP BY load_no""",
    "upsert_etl_summary": DAILY + f"""SELECT {_ID}, run_timestamp,
  CAST(total AS BIGINT) AS total_processed, CAST(nw AS BIGINT) AS inserted_records,
  CAST(upd AS BIGINT) AS updated_records,
  CAST(total - nw - upd - oc AS BIGINT) AS unchanged_records, {_DUR}, {_pct('nw + upd')}
FROM d""",
    "progression_sparse": SPARSE + """SELECT user_id, event_type, occurrence_number, created_at,
  updated_at, level, event_id,
  lag(event_id) OVER (PARTITION BY user_id, event_type, level ORDER BY occurrence_number)
    AS prev_event_id
FROM state JOIN (SELECT user_id, event_type, level FROM state WHERE level IS NOT NULL
                 GROUP BY ALL HAVING count(*) > 1) USING (user_id, event_type, level)""",
    "occurrence_stats_sparse": SPARSE + f"""SELECT user_id, event_type, level,
  CAST(count(*) AS INTEGER) AS total_occurrences, {DATE_RANGE}, bool_or(is_active) AS is_active
FROM state GROUP BY user_id, event_type, level HAVING count(*) > 1""",
    "current_sparse": SPARSE + "SELECT * FROM state WHERE is_active",
    "scd2_reopened_key": REOPENED + f"""SELECT {EV}, CAST(occ AS INTEGER) AS occurrence_number,
  data_hash, load_no = 2 AND back = 1 AS is_active, {_RUN} AS created_at, {_RUN} AS updated_at
FROM o""",
    "scd1_reopened_key": REOPENED + f"""SELECT {EV},
  CAST(CASE WHEN load_no > first_load THEN 2 ELSE 1 END AS INTEGER) AS occurrence_number,
  data_hash, load_no = 2 AS is_active, {_RUN} AS created_at, {_RUN} AS updated_at
FROM o WHERE back = 1""",
    "surrogate_ids_large_base": """SELECT o_orderkey,
  2147483653 + row_number() OVER (ORDER BY o_orderkey) AS id FROM orders""",
    "evolved_schema": "SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS added FROM customer",
    "dated_listing_order": """SELECT o_orderkey AS id, row_number() OVER (ORDER BY
  CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(o_orderdate AS DATE) END ASC NULLS LAST,
  o_orderkey) AS place FROM orders""",
    "etl_summary_order": DAILY + f"""SELECT {_ID},
  row_number() OVER (ORDER BY run_timestamp DESC) AS place FROM d""",
    "job_retry_after_crash": JOB_HISTORY + "SELECT * FROM ids",
    "job_reset": RESET,
    **job_queries.ORACLE_SQL,
}

# an order that a double cannot tell apart, in small chunks: the same history
for _name in ("scd2", "version_set", "scd1"):
    ORACLE_SQL[f"{_name}_wide_order"] = ORACLE_SQL[f"{_name}_state"]

# what the runs return is what they log
ORACLE_SQL["job_counters"] = ORACLE_SQL["job_log"]
