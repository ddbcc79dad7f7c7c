"""History reports: the views and set-returning functions of the reference,
as functions ``DataFrame -> DataFrame``.

Sorting follows the reference's defaults: ascending puts NULL last,
descending puts NULL first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.casts import canonical_text, rounded_text
from tidemark.operators.common import ACTIVE, CREATED, OCC, UPDATED
from tidemark.operators.guards import key_violations
from tidemark.operators.sequence import qcols, complete_key, keyed_lag


def _asc(cols) -> list[Column]:
    return [F.col(f"`{c}`").asc_nulls_last() for c in cols]


def current(state: DataFrame, active_col: str = ACTIVE) -> DataFrame:
    """Active versions (``WHERE is_active = TRUE``)."""
    return state.where(F.col(active_col) == F.lit(True))


def inactive(state: DataFrame, active_col: str = "active") -> DataFrame:
    """Rows no longer active (``WHERE active = FALSE``)."""
    return state.where(F.col(active_col) == F.lit(False))


def latest(state: DataFrame, key, occ: str = OCC) -> DataFrame:
    """Rows carrying the highest occurrence of their key (join on the group
    maximum; NULL keys do not join, ties are all kept).  A semi-join on
    (key, max) keeps the shuffle per (key, occurrence), not per key."""
    key = list(key)
    top = (state.where(complete_key(key)).groupBy(*qcols(key))
           .agg(F.max(occ).alias(occ)))
    return state.join(top, key + [occ], "left_semi")


def repeated_keys(state: DataFrame, key) -> DataFrame:
    """Keys with more than one row (``GROUP BY key HAVING COUNT(*) > 1``)."""
    return key_violations(state, key).drop("row_count")


def progression(state: DataFrame, key, lag_cols, select_cols, filter_on=None,
                occ: str = OCC, names: dict | None = None,
                sort: bool = True) -> DataFrame:
    """Multi-version progression (``*_multiple_stints``).

    Rows are kept when ``filter_on`` (default: the whole key) belongs to a
    key with more than one version (semi-join, NULLs never match), then
    each ``lag_cols`` column gets the previous version's value.
    """
    key = list(key)
    filter_on = list(filter_on or key)
    reps = repeated_keys(state, key).select(*qcols(filter_on)).distinct()
    rows = state.join(reps, filter_on, "left_semi").select(
        *qcols(dict.fromkeys(list(select_cols) + key + [occ] + list(lag_cols))))
    out = keyed_lag(rows, key, occ, lag_cols, names=names)
    final = list(dict.fromkeys(list(select_cols) +
                               [(names or {}).get(c, "prev_" + c) for c in lag_cols]))
    out = out.select(*qcols(final))
    return out.orderBy(*_asc(key + [occ])) if sort else out


def _text(c: Column, dtype) -> Column:
    return canonical_text(c, dtype)


def occurrence_stats(state: DataFrame, group_cols, progress=(), flags=(),
                     order_after=(), created: str = CREATED, updated: str = UPDATED,
                     names: dict | None = None, sort: bool = True) -> DataFrame:
    """Occurrence statistics (``get_*_occurrence_stats``).

    Groups with more than one row; ``total_occurrences`` as int,
    ``date_range`` = first created date ' to ' last updated date,
    ``stat_progression`` = 'Label: min->max, ...' over ``progress``
    ``(label, column)`` pairs or ``(label, column, decimals)`` for a
    ``ROUND(x::NUMERIC, d)`` part (NULL when any part is NULL, as ``||``
    does), ``flags`` = ``BOOL_OR`` columns ``(name, column)``.
    """
    names = names or {}
    types = {f.name: f.dataType for f in state.schema.fields}
    aggs = [F.count(F.lit(1)).cast("int").alias("total_occurrences"),
            F.concat(F.min(created).cast("date").cast("string"), F.lit(" to "),
                     F.max(updated).cast("date").cast("string")).alias("date_range")]
    for name, col in flags:
        col = F.col(f"`{col}`") if isinstance(col, str) else col
        aggs.append(F.bool_or(col).alias(name))
    if progress:
        parts = []
        for i, item in enumerate(progress):
            label, col = item[0], item[1]
            decimals = item[2] if len(item) > 2 else None
            c = F.col(f"`{col}`")
            if decimals is None:
                lo, hi = _text(F.min(c), types[col]), _text(F.max(c), types[col])
            else:
                lo, hi = rounded_text(F.min(c), decimals), rounded_text(F.max(c), decimals)
            parts += [F.lit((", " if i else "") + f"{label}: "), lo, F.lit("->"), hi]
        aggs.append(F.concat(*parts).alias("stat_progression"))
    g = state.groupBy(*[F.col(f"`{c}`") for c in group_cols]).agg(*aggs)
    g = g.where(F.col("total_occurrences") > 1)
    g = g.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in group_cols],
                 *[c for c in g.columns if c not in group_cols])
    if sort:
        g = g.orderBy(F.col("total_occurrences").desc_nulls_first(),
                      *_asc([names.get(c, c) for c in order_after]))
    return g


def conditional_summary(df: DataFrame, group_col, counts: dict,
                        sort: bool = True) -> DataFrame:
    """Per-group ``COUNT(*) FILTER (WHERE p)`` columns."""
    groups = [group_col] if isinstance(group_col, str) else list(group_col)
    g = df.groupBy(*qcols(groups)).agg(*[F.count_if(p).alias(n) for n, p in counts.items()])
    return g.orderBy(*_asc(groups)) if sort else g


def roster_summary(rosters: DataFrame, team: str = "teamAbbreviation",
                   group: str = "positionGroup", active_col: str = "active") -> DataFrame:
    """``team_roster_summary``."""
    a = F.col(active_col)
    return conditional_summary(rosters, team, {
        "active_players": a == True,  # noqa: E712
        "inactive_players": a == False,  # noqa: E712
        "active_forwards": (a == True) & (F.col(group) == "forwards"),  # noqa: E712
        "active_defensemen": (a == True) & (F.col(group) == "defensemen"),  # noqa: E712
        "active_goalies": (a == True) & (F.col(group) == "goalies"),  # noqa: E712
    })


def dated_listing(df: DataFrame, columns: dict, order, sort: bool = True) -> DataFrame:
    """Renaming projection ordered by date columns (``games_by_date``)."""
    out = df.select(*[F.col(f"`{src}`").alias(dst) for src, dst in columns.items()])
    return out.orderBy(*_asc(order)) if sort else out


def etl_summary(log: DataFrame, changed=("new_records", "new_occurrences"),
                shown=None, sort: bool = True) -> DataFrame:
    """``*_etl_summary``: the run log with ``duration_seconds`` (2 places)
    and ``change_percentage`` = changed / total * 100 (1 place, 0 when no
    rows were processed), newest run first.  ``run_duration`` is stored as
    seconds."""
    shown = list(shown or [c for c in log.columns if c not in ("notes",)])
    total = F.col("total_processed")
    num = sum((F.coalesce(F.col(c), F.lit(0)) for c in changed), F.lit(0))
    pct = F.when(total > 0, F.round(num.cast("decimal(20,0)") / total * 100, 1)) \
        .otherwise(F.lit(0)).cast("decimal(10,1)")
    out = log.select(*shown,
                     F.round(F.col("run_duration").cast("decimal(18,6)"), 2)
                     .cast("decimal(18,2)").alias("duration_seconds"),
                     pct.alias("change_percentage"))
    return out.orderBy(F.col("run_timestamp").desc_nulls_first()) if sort else out
