"""Query registry on the driver's test tables.

Every operator of the inventory is exercised here on the TPC-H-style
tables (whole tables, every row), each with an equivalent SQL text that
DuckDB runs on the same parquet files.  The sync folds run as two
staging loads: the earlier and the later half of the ``events`` time
range (cut at the midpoint of the first and last timestamp), loaded in
that order, each in ``event_id`` order.

The SQL side is written differently from the Spark side where it can be:
the folds are one window pass over the concatenated loads instead of two
folds over stored state, upserts are a FULL JOIN with CASE.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.casts import (blank_cast, canonical_text, flag_bool, guarded_date, keep_required,
                                      guarded_number, ordinal_label,
                                      rename_columns, round_half_even_cast,
                                      with_missing_columns)
from tidemark.functions.hashing import row_hash
from tidemark.operators.backfill import backfill
from tidemark.operators.common import empty_like, history_schema, ts_literal
from tidemark.operators.dedupe import first_per_key
from tidemark.operators.guards import key_violations, null_counts
from tidemark.operators.ids import assign_ids, number_rows
from tidemark.operators.keyed_upsert import keyed_upsert
from tidemark.operators.lookup import lookup_join, normalised_key
from tidemark.operators.scd1 import scd1_fold
from tidemark.operators.scd2 import scd2_fold
from tidemark.operators.sequence import ntz_micros
from tidemark.operators.version_set import version_set_fold
from tidemark.plans import job_queries, reports
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources.scratch import keep_table
from tidemark.sources.store import TableStore

# Fixed run timestamps of the two test loads (and of the seeded state).
TS0 = dt.datetime(2024, 5, 31)
TS1 = dt.datetime(2024, 6, 1)
TS2 = dt.datetime(2024, 6, 2)
SQL_TS0 = "TIMESTAMP '2024-05-31 00:00:00'"
SQL_TS1 = "TIMESTAMP '2024-06-01 00:00:00'"
SQL_TS2 = "TIMESTAMP '2024-06-02 00:00:00'"


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------
# staging loads from events
# ---------------------------------------------------------------------------

def _event_loads(spark, sf):
    """(load 1, load 2) of events with a ``level`` stat column.  Each load is
    a range of ``ts`` that reaches the scan."""
    ev = _t(spark, sf, "events")
    us = ntz_micros(F.col("ts"))
    cut = ev.select(us.alias("_us")).agg(
        F.expr("(min(_us) + max(_us)) div 2")).first()[0]
    at = F.lit((dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=cut)).isoformat(
        sep=" ", timespec="microseconds")).cast("timestamp_ntz")
    b = ev.select("event_id", "user_id", "event_type", "value",
                  F.floor(F.col("value") / 25).cast("bigint").alias("level"), "ts")
    return b.where(F.col("ts") <= at).drop("ts"), b.where(F.col("ts") > at).drop("ts")


def _two_runs(spark, sf, fold, hash_cols, state_family="scd", stored=False, prepare=None,
              close_first=False, **kw):
    """Two loads folded into empty history.  ``stored``: the final state is
    materialised too, as reports read a stored table.  ``prepare``: applied
    to both loads.  ``close_first``: every version of load 1 is inactive when
    load 2 comes."""
    l1, l2 = _event_loads(spark, sf)
    if prepare is not None:
        l1, l2 = prepare(l1), prepare(l2)
    l1 = l1.withColumn("data_hash", row_hash(l1.schema, hash_cols))
    l2 = l2.withColumn("data_hash", row_hash(l2.schema, hash_cols))
    state = empty_like(spark, history_schema(l1.drop("data_hash").schema, state_family))
    results = []
    for i, (load, ts) in enumerate(((l1, TS1), (l2, TS2))):
        if fold is not version_set_fold:  # inserts, flags and counters read it
            kw.setdefault("keep", lambda r: keep_table(r, "classified"))
        res = fold(state, load, run_ts=ts, **kw)
        results.append(res)
        state = res.state
        if i == 0 or stored:
            # stored state between runs, as a table in spark.checkpoint.dir:
            # load 1 is not run again inside load 2, and later scans read only
            # the columns and rows they need
            state = keep_table(state, "state")
        if i == 0 and close_first:
            state = state.withColumn("is_active", F.lit(False))
    return state, results


def scd2_state_df(spark, sf):
    """SCD2 on key user_id, hashed event_type."""
    return _two_runs(spark, sf, scd2_fold, ["event_type"], key=["user_id"],
                     seq="event_id")


def stat_state_df(spark, sf, stored=False):
    """SCD2 on key (user_id, event_type), hashed level (a skater-like table)."""
    return _two_runs(spark, sf, scd2_fold, ["level"], key=["user_id", "event_type"],
                     seq="event_id", stored=stored)


def version_state_df(spark, sf, roster=False, stored=False):
    return _two_runs(spark, sf, version_set_fold, ["event_type", "level"],
                     state_family="roster" if roster else "versions",
                     key=["user_id"], seq="event_id",
                     active_col="active" if roster else None, stored=stored)


def scd1_state_df(spark, sf):
    return _two_runs(spark, sf, scd1_fold, ["event_type"], key=["user_id"],
                     seq="event_id")


def _wide(load):
    """An order that a double cannot tell apart."""
    return load.withColumn("wide", F.col("event_id") + F.lit(1 << 60)).repartition(4)


def q_scd2_wide_order(spark, sf):
    return _two_runs(spark, sf, scd2_fold, ["event_type"], key=["user_id"], seq="wide",
                     prepare=_wide, rows_per_chunk=20)[0].drop("wide")


def q_version_set_wide_order(spark, sf):
    return _two_runs(spark, sf, version_set_fold, ["event_type", "level"],
                     state_family="versions", key=["user_id"], seq="wide", prepare=_wide,
                     rows_per_chunk=20)[0].drop("wide")


def q_scd1_wide_order(spark, sf):
    return _two_runs(spark, sf, scd1_fold, ["event_type"], key=["user_id"], seq="wide",
                     prepare=_wide, rows_per_chunk=20)[0].drop("wide")


def q_scd2_reopened_key(spark, sf):
    """Load 2 on keys that have inactive versions only."""
    return _two_runs(spark, sf, scd2_fold, ["event_type"], key=["user_id"], seq="event_id",
                     close_first=True)[0]


def q_scd1_reopened_key(spark, sf):
    return _two_runs(spark, sf, scd1_fold, ["event_type"], key=["user_id"], seq="event_id",
                     close_first=True)[0]


def _sparse_history(spark, sf):
    """SCD2 on a key of which many have one version only, and whose last
    part is NULL for some rows."""
    def prepare(load):
        return load.withColumn("level", F.when(F.col("event_id") % 50 != 0, F.col("level")))
    return _two_runs(spark, sf, scd2_fold, ["event_id"], stored=True, prepare=prepare,
                     key=["user_id", "event_type", "level"], seq="event_id")[0]


def q_progression_sparse(spark, sf):
    return reports.progression(_sparse_history(spark, sf), ["user_id", "event_type", "level"],
                               ["event_id"], _PROG_SELECT)


def q_occurrence_stats_sparse(spark, sf):
    return reports.occurrence_stats(_sparse_history(spark, sf),
                                    ["user_id", "event_type", "level"],
                                    flags=[("is_active", F.col("is_active"))],
                                    order_after=["user_id", "event_type", "level"])


def q_current_sparse(spark, sf):
    return reports.current(_sparse_history(spark, sf))


def _metrics_of(results):
    out = None
    for i, r in enumerate(results, start=1):
        m = r.metrics.withColumn("load_no", F.lit(i))
        out = m if out is None else out.unionByName(m)
    return out


def q_scd2_state(spark, sf):
    state, _ = scd2_state_df(spark, sf)
    return state


def q_scd2_metrics(spark, sf):
    return _metrics_of(scd2_state_df(spark, sf)[1])


def q_stat_history(spark, sf):
    return stat_state_df(spark, sf)[0]


def q_current(spark, sf):
    return reports.current(stat_state_df(spark, sf, stored=True)[0])


def q_version_set_state(spark, sf):
    return version_state_df(spark, sf)[0]


def q_version_set_metrics(spark, sf):
    return _metrics_of(version_state_df(spark, sf)[1])


def q_latest(spark, sf):
    return reports.latest(version_state_df(spark, sf, stored=True)[0], ["user_id"])


def q_roster_state(spark, sf):
    return version_state_df(spark, sf, roster=True)[0]


def q_roster_active(spark, sf):
    return reports.current(version_state_df(spark, sf, roster=True, stored=True)[0],
                           "active")


def q_roster_inactive(spark, sf):
    return reports.inactive(version_state_df(spark, sf, roster=True, stored=True)[0],
                            "active")


def q_roster_metrics(spark, sf):
    return _metrics_of(version_state_df(spark, sf, roster=True)[1])


def q_team_roster_summary(spark, sf):
    """R10 on the roster history: team = event type, position group from the
    stat level."""
    st = version_state_df(spark, sf, roster=True, stored=True)[0]
    group = (F.when(F.col("level") < 5, "forwards").when(F.col("level") < 10, "defensemen")
             .otherwise("goalies"))
    st = st.select(F.col("event_type").alias("teamAbbreviation"),
                   group.alias("positionGroup"), "active")
    return reports.roster_summary(st)


def q_scd1_state(spark, sf):
    return scd1_state_df(spark, sf)[0]


def q_scd1_metrics(spark, sf):
    return _metrics_of(scd1_state_df(spark, sf)[1])


_PROG_SELECT = ["user_id", "event_type", "occurrence_number", "created_at",
                "updated_at", "level", "event_id"]


def q_progression_player(spark, sf):
    st = stat_state_df(spark, sf, stored=True)[0]
    return reports.progression(st, ["user_id", "event_type"], ["level", "event_id"],
                               _PROG_SELECT, filter_on=["user_id"])


def q_progression_key(spark, sf):
    st = stat_state_df(spark, sf, stored=True)[0]
    return reports.progression(st, ["user_id", "event_type"], ["level", "event_id"],
                               _PROG_SELECT)


def q_occurrence_stats(spark, sf):
    st = stat_state_df(spark, sf, stored=True)[0]
    return reports.occurrence_stats(
        st, ["user_id", "event_type"],
        progress=[("Level", "level"), ("Value", "event_id"), ("Avg", "value", 3)],
        order_after=["user_id", "event_type"],
        names={"user_id": "player_id", "event_type": "team"})


def q_roster_occurrence_stats(spark, sf):
    st = version_state_df(spark, sf, roster=True, stored=True)[0]
    return reports.occurrence_stats(st, ["user_id"],
                                    flags=[("is_active", F.col("active"))],
                                    order_after=["user_id"])


# ---------------------------------------------------------------------------
# casts, hashes, ingest
# ---------------------------------------------------------------------------

def q_blank_cast(spark, sf):
    o = _t(spark, sf, "orders")
    staged = o.select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(""))
        .otherwise(F.col("o_custkey").cast("string")).alias("cust_text"),
        F.when(F.col("o_orderstatus") == "P", F.lit(""))
        .otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("date_text"),
        F.floor("o_totalprice").cast("double").alias("whole_price"),
        "o_totalprice")
    s = staged.schema
    return staged.select(
        "o_orderkey",
        blank_cast(F.col("cust_text"), "bigint", s["cust_text"].dataType).alias("o_custkey"),
        blank_cast(F.col("date_text"), "date", s["date_text"].dataType).alias("o_orderdate"),
        blank_cast(F.col("whole_price"), "bigint", s["whole_price"].dataType).alias("whole_price"),
        round_half_even_cast(F.col("o_totalprice"), "bigint",
                             s["o_totalprice"].dataType).alias("rounded_price"))


def q_required_keys(spark, sf):
    """Staged orders whose key arrives as text, blank for some rows: rows
    whose key casts to NULL are dropped before any sync."""
    o = _t(spark, sf, "orders")
    staged = o.select(
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(""))
        .otherwise(F.col("o_orderkey").cast("string")).alias("key_text"),
        "o_custkey", "o_orderstatus")
    typed = staged.select(
        blank_cast(F.col("key_text"), "bigint", staged.schema["key_text"].dataType)
        .alias("o_orderkey"), "o_custkey", "o_orderstatus")
    return keep_required(typed, ["o_orderkey"])


def q_ordinal_label(spark, sf):
    o = _t(spark, sf, "orders")
    return o.select("o_orderkey", ordinal_label(F.col("o_orderkey")).alias("ordinal"))


def _number_text(ev: DataFrame) -> DataFrame:
    k = F.regexp_extract("props", r"(\d+)", 1)
    txt = (F.when(F.col("event_type") == "view", F.concat(F.col("user_id").cast("string"), F.lit(":"), k))
           .when(F.col("event_type") == "error", F.concat(k, F.lit("."), F.col("user_id").cast("string")))
           .when(F.col("event_type") == "signup", F.lit(None).cast("string"))
           .when(F.col("event_type") == "purchase", F.concat(F.lit("-"), k))
           .otherwise(k))
    return ev.select("event_id", txt.alias("txt"))


def q_guarded_number(spark, sf):
    t = _number_text(_t(spark, sf, "events"))
    return t.select("event_id", "txt",
                    guarded_number(F.col("txt")).alias("num_or_null"),
                    guarded_number(F.col("txt"), 0.0).alias("num_or_zero"))


def q_flag_date_guard(spark, sf):
    o = _t(spark, sf, "orders")
    flag_num = (F.when(F.col("o_orderstatus") == "F", 1)
                .when(F.col("o_orderstatus") == "O", 0))
    date_text = (F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(""))
                 .when(F.col("o_orderpriority") == "2-HIGH", F.lit(None).cast("string"))
                 .otherwise(F.col("o_orderdate").cast("date").cast("string")))
    d = o.select("o_orderkey", flag_num.alias("flag_num"), date_text.alias("date_text"))
    return d.select("o_orderkey", flag_bool(F.col("flag_num")).alias("is_final"),
                    guarded_date(F.col("date_text")).alias("order_date"),
                    guarded_date(F.col("date_text")).cast("string").alias("order_day"))


def q_dotted_rename(spark, sf):
    c = _t(spark, sf, "customer")
    staged = c.select(F.col("c_custkey").alias("customer.id"),
                      F.col("c_name").alias("name.default"),
                      F.col("c_acctbal").alias("balance.value"))
    flat = rename_columns(staged, {"customer.id": "id", "name.default": "name_default",
                                   "balance.value": "balance"})
    return with_missing_columns(flat, {"ties": "double", "notes": "string"})


def _hash_input(o: DataFrame) -> DataFrame:
    return o.select("o_orderkey",
                    F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("o_custkey"),
                    "o_orderstatus",
                    F.when(F.col("o_orderpriority") != "5-LOW",
                           F.col("o_orderpriority")).alias("o_orderpriority"))


def q_row_hash(spark, sf):
    h = _hash_input(_t(spark, sf, "orders"))
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]
    return h.select("o_orderkey", row_hash(h.schema, cols).alias("row_hash"),
                    row_hash(h.schema, cols, as_double=True).alias("row_hash_dbl"))


# ---------------------------------------------------------------------------
# dedupe, lookups, ids, guards
# ---------------------------------------------------------------------------

_LI_TIE = ["l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
           "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


#: Magnitudes of the doubles whose text is compared, and values on their own.
#: They stay below 1e16, where the runtime's digits are the shortest.
DOUBLE_SCALES = (1e-6, 1e-3, 1.0, 1e3, 1e6, 1e8, 1e9, 1e10, 1e11)
DOUBLE_CASES = ("NaN", "Infinity", "-Infinity", "-0.0", "1e15", "0.0005", None, "1e-5", "0.0001",
                "1e100", "-1e16", "0.001", "12345678.5")


def _double_sql(cast: str, index: str) -> str:
    """Doubles of every magnitude over lineitem, in either engine's SQL."""
    cases = " ".join(f"WHEN {i} THEN {'NULL' if x is None else cast.format(x)}"
                     for i, x in enumerate(DOUBLE_CASES))
    scales = ", ".join(cast.format(x) for x in DOUBLE_SCALES)
    return (f"CASE l_partkey % 40 {cases} ELSE (l_extendedprice / 7) * "
            f"{index.format(scales, f'1 + l_suppkey % {len(DOUBLE_SCALES)}')} "
            f"* (CASE WHEN l_linenumber % 2 = 0 THEN -1 ELSE 1 END) END")


def q_double_text(spark, sf):
    """Doubles as the reference database prints them, alone and in a hash."""
    li = _t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.expr(_double_sql("CAST('{}' AS DOUBLE)", "element_at(array({}), CAST({} AS INT))")).alias("x"))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     canonical_text(F.col("x"), T.DoubleType()).alias("text"),
                     row_hash(li.schema, ["x", "l_partkey"]).alias("row_hash"))


def q_dedupe_first(spark, sf):
    li = _t(spark, sf, "lineitem")
    return first_per_key(li, ["l_orderkey"], ["l_partkey"], _LI_TIE)


def q_lookup_left(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = (_t(spark, sf, "customer").where(F.col("c_mktsegment") != "AUTOMOBILE")
         .select("c_custkey", "c_name", "c_nationkey"))
    j = lookup_join(o, c, o["o_custkey"] == c["c_custkey"], "left", keys=[o["o_custkey"]])
    return j.select("o_orderkey", "o_custkey", "c_name", "c_nationkey")


def q_lookup_multi(spark, sf):
    """Four-part key lookup with a cast on one side (drafts -> players)."""
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                          "l_suppkey", "l_returnflag")
    o = _t(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("k_text"), "o_orderstatus",
        "o_orderpriority", "o_custkey")
    on = [F.col("l_orderkey") == F.col("k_text").cast("bigint"),
          F.col("l_returnflag") == F.when(F.col("o_orderstatus") == "F", "R")
          .otherwise(F.lit("N"))]
    j = lookup_join(li, o, on, "left", keys=[F.col("l_orderkey"), F.col("l_returnflag")])
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    "o_orderpriority", "o_custkey")


def q_surrogate_ids(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return assign_ids(o, [F.col("o_custkey").asc_nulls_last(),
                          F.col("o_orderkey").asc_nulls_last()], base=1000)


def q_surrogate_ids_large_base(spark, sf):
    """Ids that start beyond 32 bits."""
    o = _t(spark, sf, "orders").select("o_orderkey")
    return assign_ids(o, [F.col("o_orderkey")], base=(1 << 31) + 5)


def q_evolved_schema(spark, sf):
    """A stored table read with a schema that has gained a column."""
    store = TableStore(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidemark-registry/"
                              f"{uuid.uuid4().hex}")
    old = _t(spark, sf, "customer").select("c_custkey", "c_name")
    store.commit({"customers": store.write_version("customers", old)})
    return store.read("customers", T.StructType([*old.schema.fields,
                                                 T.StructField("added", T.StringType())]))


def _positions(df, *cols):
    """Selected columns with each row's place in the sorted result: the sort's
    own ranges, and offsets from a count per range."""
    return number_rows(df.select(*cols), id_col="place")


def q_etl_summary_order(spark, sf):
    """Newest run first (descending sort)."""
    return _positions(q_etl_summary(spark, sf), "id")


def q_dated_listing_order(spark, sf):
    """Dates ascending, NULLs last, then the key."""
    o = _t(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderpriority") != "1-URGENT",
                             F.col("o_orderdate").cast("date")).alias("o_orderdate"))
    listing = reports.dated_listing(o, {"o_orderkey": "id", "o_orderdate": "day"},
                                    ["o_orderdate", "o_orderkey"])
    return _positions(listing, "id")


def q_null_counts(spark, sf):
    """The NOT NULL guard's single pass on a staged orders batch."""
    staged = _hash_input(_t(spark, sf, "orders"))
    return null_counts(staged, ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])


def q_key_violations(spark, sf):
    li = _t(spark, sf, "lineitem")
    return key_violations(li, ["l_orderkey", "l_linenumber"])


# ---------------------------------------------------------------------------
# keyed upserts and backfill
# ---------------------------------------------------------------------------

def _stamped(df, ts):
    return df.withColumn("created_at", ts_literal(ts)) \
             .withColumn("updated_at", ts_literal(ts))


def _customer_upsert(spark, sf):
    c = _t(spark, sf, "customer")
    state = _stamped(c.where(F.col("c_mktsegment") != "HOUSEHOLD"), TS0)
    seg = F.col("c_mktsegment")
    batch = c.where(seg.isin("BUILDING", "MACHINERY", "HOUSEHOLD")).select(
        "c_custkey",
        F.when(seg == "MACHINERY", F.concat("c_name", F.lit(" II")))
        .otherwise(F.col("c_name")).alias("c_name"),
        "c_nationkey",
        F.when(seg == "BUILDING", F.col("c_acctbal") + 100)
        .otherwise(F.col("c_acctbal")).alias("c_acctbal"),
        "c_mktsegment")
    return keyed_upsert(state, batch, ["c_custkey"], TS1,
                        update_cols=["c_acctbal", "c_nationkey"])


def q_keyed_upsert_state(spark, sf):
    return _customer_upsert(spark, sf).state


def q_keyed_upsert_metrics(spark, sf):
    return _customer_upsert(spark, sf).metrics


def _orders_guarded(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                       "o_orderpriority")
    state = _stamped(o.where(F.col("o_orderpriority") != "3-MEDIUM"), TS0)
    batch = o.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("bigint"))
        .when(F.col("o_orderstatus") == "F", F.col("o_custkey") + 1)
        .otherwise(F.col("o_custkey")).alias("o_custkey"),
        "o_orderstatus",
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None).cast("string"))
        .otherwise(F.col("o_orderpriority")).alias("o_orderpriority"))
    return keyed_upsert(state, batch, ["o_orderkey"], TS1,
                        update_cols=["o_custkey", "o_orderpriority"], guarded=True,
                        coalesce_updates=True, updated_name="updated_playerid_records")


def q_guarded_upsert(spark, sf):
    return _orders_guarded(spark, sf).state


def q_guarded_upsert_metrics(spark, sf):
    return _orders_guarded(spark, sf).metrics


def _backfill(spark, sf):
    o = _t(spark, sf, "orders")
    c = _t(spark, sf, "customer")
    target = o.join(c.select("c_custkey", "c_name", "c_nationkey"),
                    o["o_custkey"] == c["c_custkey"], "left").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"),
               F.lit(None).cast("bigint")).otherwise(F.col("o_custkey")).alias("o_custkey"),
        F.concat(F.lit("  "), F.lower("c_name"), F.lit(" ")).alias("cust_text"),
        F.col("c_nationkey").alias("nation"))
    target = _stamped(target, TS0)
    return backfill(target, c, "o_custkey", "c_custkey",
                    [(normalised_key(F.col("cust_text")), normalised_key(F.col("c_name"))),
                     (F.col("nation"), F.col("c_nationkey"))], TS1)


def q_backfill(spark, sf):
    return _backfill(spark, sf)[0].drop("created_at")


def q_backfill_count(spark, sf):
    return _backfill(spark, sf)[1]


# ---------------------------------------------------------------------------
# summaries and listings
# ---------------------------------------------------------------------------

def q_conditional_summary(spark, sf):
    li = _t(spark, sf, "lineitem")
    return reports.conditional_summary(li, ["l_returnflag", "l_linestatus"], {
        "line_count": F.lit(True),
        "discounted": F.col("l_discount") > 0.05,
        "large": F.col("l_quantity") >= 25,
        "discounted_large": (F.col("l_discount") > 0.05) & (F.col("l_quantity") >= 25),
        "taxed": F.col("l_tax") > 0,
    })


def q_dated_listing(spark, sf):
    o = _t(spark, sf, "orders")
    return reports.dated_listing(o, {
        "o_orderkey": "order_id", "o_orderdate": "order_date", "o_custkey": "customer",
        "o_orderstatus": "status", "o_orderpriority": "priority"},
        ["order_date", "order_id"])


def _daily_log(spark, sf):
    ev = _t(spark, sf, "events")
    us = ntz_micros(F.col("ts"))
    et = F.col("event_type")
    g = ev.groupBy(F.col("ts").cast("date").alias("day")).agg(
        F.max("ts").alias("run_timestamp"),
        F.count(F.lit(1)).cast("bigint").alias("total_processed"),
        F.count_if(et == "click").cast("bigint").alias("new_records"),
        F.count_if(et == "view").cast("bigint").alias("updated_records"),
        F.count_if(et == "error").cast("bigint").alias("new_occurrences"),
        ((F.max(us) - F.min(us)).cast("decimal(20,0)") / 1000000)
        .cast("decimal(18,6)").alias("run_duration"))
    return g.select(F.unix_date("day").cast("bigint").alias("id"), "run_timestamp",
                    "total_processed", "new_records", "updated_records",
                    (F.col("total_processed") - F.col("new_records") - F.col("updated_records")
                     - F.col("new_occurrences")).cast("bigint").alias("unchanged_records"),
                    "new_occurrences", "run_duration")


def q_etl_summary(spark, sf):
    log = _daily_log(spark, sf)
    return reports.etl_summary(log, shown=["id", "run_timestamp", "total_processed",
                                           "new_records", "unchanged_records",
                                           "new_occurrences", "run_duration"])


def q_upsert_etl_summary(spark, sf):
    log = _daily_log(spark, sf).withColumnRenamed("new_records", "inserted_records")
    return reports.etl_summary(log, changed=("inserted_records", "updated_records"),
                               shown=["id", "run_timestamp", "total_processed",
                                      "inserted_records", "updated_records",
                                      "unchanged_records", "run_duration"])


# ---------------------------------------------------------------------------
# the job layer end to end: store, ids, segments, run log
# ---------------------------------------------------------------------------

def _event_history_entity():
    from tidemark.plans.entities import Entity, _typed_hash
    return Entity("event_history", "scd2", ["user_id", "event_type"],
                  {"event_id": "bigint", "user_id": "bigint", "event_type": "string",
                   "value": "double", "level": "bigint"},
                  hash_fn=_typed_hash([("level", "bigint")]), log="event_history_etl_log")


def _job_runs(spark, sf):
    """Two loads synced with run_sync into a fresh store under the cluster's
    checkpoint folder; returns the store."""
    from tidemark.plans.jobs import run_sync
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidemark-registry/{uuid.uuid4().hex}"
    store = TableStore(spark, root)
    entity = _event_history_entity()
    l1, l2 = _event_loads(spark, sf)
    run_sync(spark, store, entity, l1, run_ts=TS1, order_by="event_id")
    run_sync(spark, store, entity, l2, run_ts=TS2, order_by="event_id")
    return store


def q_job_history(spark, sf):
    return _job_runs(spark, sf).read("event_history")


def _crashed(store, entity):
    """A run that wrote its version and its log row and died before its
    commit."""
    store.write_version(entity.table, store.read(entity.table).limit(5),
                        partition_by=[entity.active_col])
    store._write_log(entity.log_name, store.read_log(entity.log_name))


def q_job_retry_after_crash(spark, sf):
    """Load 2 runs again, with a new store object, after a crashed run."""
    from tidemark.plans.jobs import run_sync
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidemark-registry/{uuid.uuid4().hex}"
    entity = _event_history_entity()
    l1, l2 = _event_loads(spark, sf)
    store = TableStore(spark, root)
    run_sync(spark, store, entity, l1, run_ts=TS1, order_by="event_id")
    _crashed(store, entity)
    run_sync(spark, TableStore(spark, root), entity, l2, run_ts=TS2, order_by="event_id")
    return TableStore(spark, root).read("event_history")


def q_job_reset(spark, sf):
    """Load 2 in reset mode: nothing of load 1 is left, ids start again."""
    from tidemark.plans.jobs import run_sync
    store = _job_runs(spark, sf)
    run_sync(spark, store, _event_history_entity(), _event_loads(spark, sf)[1], run_ts=TS2,
             order_by="event_id", mode="reset")
    return store.read("event_history")


def q_job_log(spark, sf):
    # run_duration is wall-clock time: left out of the comparison
    return _job_runs(spark, sf).read_log("event_history_etl_log").drop("run_duration")


def q_job_counters(spark, sf):
    """The counters rows that two runs return to their caller."""
    from tidemark.plans.jobs import run_sync
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidemark-registry/{uuid.uuid4().hex}"
    store, entity = TableStore(spark, root), _event_history_entity()
    rows = [run_sync(spark, store, entity, load, run_ts=ts, order_by="event_id")[0]
            for load, ts in zip(_event_loads(spark, sf), (TS1, TS2))]
    return rows[0].unionByName(rows[1]).drop("run_duration")


QUERIES = {
    "blank_cast": q_blank_cast,
    "required_keys": q_required_keys,
    "ordinal_label": q_ordinal_label,
    "guarded_number": q_guarded_number,
    "flag_date_guard": q_flag_date_guard,
    "dotted_rename": q_dotted_rename,
    "row_hash": q_row_hash,
    "double_text": q_double_text,
    "dedupe_first": q_dedupe_first,
    "lookup_left": q_lookup_left,
    "lookup_multi": q_lookup_multi,
    "surrogate_ids": q_surrogate_ids,
    "key_violations": q_key_violations,
    "null_counts": q_null_counts,
    "scd2_state": q_scd2_state,
    "scd2_metrics": q_scd2_metrics,
    "stat_history": q_stat_history,
    "current": q_current,
    "version_set_state": q_version_set_state,
    "version_set_metrics": q_version_set_metrics,
    "latest": q_latest,
    "roster_state": q_roster_state,
    "roster_active": q_roster_active,
    "roster_inactive": q_roster_inactive,
    "roster_metrics": q_roster_metrics,
    "team_roster_summary": q_team_roster_summary,
    "scd1_state": q_scd1_state,
    "scd1_metrics": q_scd1_metrics,
    "progression_player": q_progression_player,
    "progression_key": q_progression_key,
    "occurrence_stats": q_occurrence_stats,
    "roster_occurrence_stats": q_roster_occurrence_stats,
    "keyed_upsert_state": q_keyed_upsert_state,
    "keyed_upsert_metrics": q_keyed_upsert_metrics,
    "guarded_upsert": q_guarded_upsert,
    "guarded_upsert_metrics": q_guarded_upsert_metrics,
    "backfill": q_backfill,
    "backfill_count": q_backfill_count,
    "conditional_summary": q_conditional_summary,
    "dated_listing": q_dated_listing,
    "etl_summary": q_etl_summary,
    "upsert_etl_summary": q_upsert_etl_summary,
    "job_history": q_job_history,
    "job_log": q_job_log,
    "job_counters": q_job_counters,
    "scd2_wide_order": q_scd2_wide_order,
    "version_set_wide_order": q_version_set_wide_order,
    "scd1_wide_order": q_scd1_wide_order,
    "scd2_reopened_key": q_scd2_reopened_key,
    "scd1_reopened_key": q_scd1_reopened_key,
    "progression_sparse": q_progression_sparse,
    "occurrence_stats_sparse": q_occurrence_stats_sparse,
    "current_sparse": q_current_sparse,
    "surrogate_ids_large_base": q_surrogate_ids_large_base,
    "evolved_schema": q_evolved_schema,
    "etl_summary_order": q_etl_summary_order,
    "dated_listing_order": q_dated_listing_order,
    "job_retry_after_crash": q_job_retry_after_crash,
    "job_reset": q_job_reset,
    **job_queries.QUERIES,
}
