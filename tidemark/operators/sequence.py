"""Ordered scans within a key that stay parallel when one key is huge.

The folds need, per key and in batch order, the previous row's value
(``lag``) and a running count of changes.  A plain window partitioned by
key puts every row of a key into one task, which fails when one key holds
a large share of the batch.  ``KeyedOrder`` splits such hot keys into
chunks of consecutive ``seq`` ranges, runs the window per (key, chunk)
and carries values and counts across chunk boundaries through small
per-chunk tables:

* rows are ordered by the ``seq`` column itself; a number that keeps its
  order (``seq_numeric``) serves only to place chunk boundaries;
* keys with at most ``rows_per_chunk`` rows keep a single chunk 0, so the
  common case is one window over (key, 0); whether any key is larger is
  found with pre-aggregated counts;
* hot keys get chunk boundaries from ``percentile_approx`` (a mergeable
  aggregate, so the hot key itself is aggregated in parallel); the number
  of boundaries per key is ``ceil(n / rows_per_chunk)``.  The boundaries
  are checkpointed before use, so every recomputation sees the same;
* per-chunk tables (last value, change totals) have one row per chunk,
  the carried values reach the rows through a join on (key, chunk) whose
  hash partitioning is the one the window needs, so the rows are
  shuffled once.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import ensure_checkpoint_dir

CHUNK = "_chunk"
SEQN = "_seqn"

# Rows one window group may hold before its key is split.
DEFAULT_ROWS_PER_CHUNK = 1 << 22
# Upper bound on chunks of one key (the percentile list is a literal):
# beyond MAX_CHUNKS * rows_per_chunk rows of one key, chunks grow.
MAX_CHUNKS = 4096


def qcols(names) -> list[Column]:
    """Columns by exact name (back-quoted: staging names may contain dots)."""
    return [F.col(f"`{n}`") for n in names]


def complete_key(keys) -> Column:
    """True when no key part is NULL (``=`` lookups never match NULL)."""
    return reduce(and_, [F.col(f"`{k}`").isNotNull() for k in keys])


def ntz_micros(c: Column) -> Column:
    """Microseconds since 1970-01-01 of a timestamp_ntz, independent of the
    session time zone (no local-time conversion, no DST folds)."""
    days = F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    return (days * F.lit(86_400_000_000) + F.hour(c).cast("long") * F.lit(3_600_000_000)
            + F.minute(c).cast("long") * F.lit(60_000_000)
            + (F.date_part(F.lit("SECOND"), c) * F.lit(1_000_000)).cast("long"))


def seq_numeric(df: DataFrame, seq: str) -> Column:
    """A number that keeps the order of ``seq`` (values may fall together);
    used for chunk boundaries only."""
    dtype = df.schema[seq].dataType
    c = F.col(f"`{seq}`")
    if isinstance(dtype, T.TimestampNTZType):
        return ntz_micros(c).cast("double")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(dtype, T.StringType):
        # the first six bytes, in byte order
        return F.conv(F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 6)), 12, "0"),
                      16, 10).cast("double")
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return c.cast("double")
    return F.lit(0.0)  # any other orderable type: one chunk


def checked_order(seq: str, window, value: Column) -> Column:
    """``value``; fails the run where ``seq`` is NULL or ties with the row
    before it in ``window`` (the order of a key's rows would be arbitrary)."""
    c = F.col(f"`{seq}`")
    return (F.when(c.isNull(), F.raise_error(F.lit(f"NULL in the order column {seq}"))
                   .cast("int"))
            .when(F.lag(c).over(window) == c,
                  F.raise_error(F.lit(f"rows of one key tie in the order column {seq}"))
                  .cast("int"))
            .otherwise(value))


def join_on(left: DataFrame, right: DataFrame, cols, how: str,
            null_safe: bool = False) -> DataFrame:
    """Equi-join on same-named columns; ``null_safe`` matches NULL to NULL
    (``<=>``), for keys that may hold NULL parts."""
    cols = list(cols)
    if not null_safe:
        return left.join(right, cols, how)
    tmp = [f"_j{i}" for i in range(len(cols))]
    r = right.select(*[F.col(f"`{c}`").alias(t) for c, t in zip(cols, tmp)],
                     *[F.col(f"`{c}`") for c in right.columns if c not in cols])
    cond = reduce(and_, [left[f"`{c}`"].eqNullSafe(r[t]) for c, t in zip(cols, tmp)])
    return left.join(r, cond, how).drop(*tmp)


class KeyedOrder:
    """Rows of one batch, ordered by ``seq`` within ``keys``, in chunks."""

    def __init__(self, rows: DataFrame, keys, seq: str,
                 rows_per_chunk: int | None = None, null_keys: bool = False):
        """``null_keys``: key parts may be NULL and NULLs form one group (as
        ``PARTITION BY`` does); the folds split such rows off beforehand and
        keep plain equi-joins, whose partitioning the window reuses."""
        self.keys = list(keys)
        self.seq = seq
        self.null_keys = null_keys
        self.rows_per_chunk = rows_per_chunk or DEFAULT_ROWS_PER_CHUNK
        rows = rows.withColumn(SEQN, seq_numeric(rows, seq))
        self.hot_chunks = 0
        self.rows = self._assign_chunks(rows)

    # -- chunk assignment -------------------------------------------------
    def _assign_chunks(self, rows: DataFrame) -> DataFrame:
        t = self.rows_per_chunk
        # a batch of at most t rows holds no hot key
        if rows.select(*qcols(self.keys)).count() <= t:
            return rows.withColumn(CHUNK, F.lit(0))
        counts = rows.groupBy(*qcols(self.keys)).agg(F.count(F.lit(1)).alias("_n"))
        hot = counts.where(F.col("_n") > t)
        n_hot, max_n, chunks = hot.agg(
            F.count(F.lit(1)), F.max("_n"),
            F.sum(F.ceil(F.col("_n") / F.lit(t)))).first()
        if not n_hot:
            return rows.withColumn(CHUNK, F.lit(0))
        parts = min(int(math.ceil(max_n / t)), MAX_CHUNKS)
        self.hot_chunks = int(chunks)
        pcts = [i / parts for i in range(1, parts)]
        hot_rows = join_on(rows, hot.select(*qcols(self.keys)),
                           self.keys, "left_semi", self.null_keys)
        bounds = (hot_rows.groupBy(*qcols(self.keys))
                  .agg(F.percentile_approx(SEQN, pcts, max(10000, parts * 100))
                       .alias("_q"), F.count(F.lit(1)).alias("_n")))
        # keep ceil(n / t) - 1 evenly spaced boundaries of this key
        step = F.greatest(F.lit(1), F.floor(F.lit(parts) /
                                            F.ceil(F.col("_n") / F.lit(t))))
        bounds = bounds.select(
            *self.keys,
            F.array_distinct(F.filter("_q", lambda b, i: (i + 1) % step == 0))
            .alias("_bounds"))
        # fixed once: percentile_approx may answer differently when recomputed,
        # and rows must meet the chunk tables built from the same boundaries
        ensure_checkpoint_dir(rows.sparkSession)
        bounds = bounds.checkpoint(eager=True)
        rows = join_on(rows, bounds, self.keys, "left", self.null_keys)
        chunk = F.coalesce(F.size(F.filter("_bounds", lambda b: b < F.col(SEQN))),
                           F.lit(0))
        return rows.withColumn(CHUNK, chunk.cast("int")).drop("_bounds")

    # -- per-chunk tables -------------------------------------------------
    def window(self) -> Window:
        return Window.partitionBy(*qcols(self.keys), CHUNK).orderBy(F.col(f"`{self.seq}`"))

    def chunk_table(self, *aggs: Column) -> DataFrame:
        """One row per (key, chunk) with the given aggregates."""
        if not aggs:
            aggs = (F.count(F.lit(1)).alias("_rows"),)
        return self.rows.groupBy(*qcols(self.keys), CHUNK).agg(*aggs)

    @staticmethod
    def carry(table: DataFrame, keys, value: str, out: str) -> DataFrame:
        """``out`` = ``value`` of the previous chunk of the same key."""
        w = Window.partitionBy(*qcols(keys)).orderBy(CHUNK)
        return table.withColumn(out, F.lag(value).over(w))

    def attach(self, table: DataFrame) -> DataFrame:
        """Rows joined to their (key, chunk) row; shuffles rows once, on the
        partitioning the window needs."""
        return join_on(self.rows, table, self.keys + [CHUNK], "inner", self.null_keys)

    def offsets(self, rows: DataFrame, local_total: str, run: str,
                total: str, local_run: str) -> DataFrame:
        """Turn per-chunk running counts into per-key ones.

        ``rows`` carry ``local_run`` (inclusive count inside the chunk) and
        ``local_total`` (count of the whole chunk).  Adds ``run`` and
        ``total`` for the whole key.  Only hot keys have more than one
        chunk, so only their chunk totals are gathered; that table has at
        most ``hot_chunks`` rows.
        """
        if not self.hot_chunks:
            return rows.withColumn(run, F.col(local_run)) \
                .withColumn(total, F.col(local_total))
        per_chunk = (rows.where(F.col("_nchunks") > 1)
                     .groupBy(*qcols(self.keys), CHUNK)
                     .agg(F.max(local_total).alias("_ct")))
        w = Window.partitionBy(*qcols(self.keys)).orderBy(CHUNK)
        per_chunk = per_chunk.select(
            *self.keys, CHUNK,
            F.coalesce(F.sum("_ct").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                       F.lit(0)).alias("_off"),
            F.sum("_ct").over(w.rowsBetween(Window.unboundedPreceding,
                                            Window.unboundedFollowing)).alias("_kt"))
        joined = join_on(rows, per_chunk, self.keys + [CHUNK], "left", self.null_keys)
        return (joined
                .withColumn(run, F.coalesce(F.col("_off"), F.lit(0)) + F.col(local_run))
                .withColumn(total, F.coalesce(F.col("_kt"), F.col(local_total)))
                .drop("_off", "_kt"))

    def with_key_info(self, key_info: DataFrame | None, carry: str | None = None,
                      carry_out: str = "_carry") -> DataFrame:
        """Rows with per-key columns of ``key_info`` (left join on key), the
        carried ``carry`` value of the previous chunk in ``carry_out`` and the
        key's chunk count in ``_nchunks``.

        Without hot keys every key is one chunk: the rows join ``key_info``
        on the key directly and the window partitions by key.  With hot keys
        the per-chunk table is built and the rows join it on (key, chunk).
        """
        if not self.hot_chunks:
            r = self.rows
            if key_info is not None:
                r = join_on(r, key_info, self.keys, "left", self.null_keys)
            if carry:
                r = r.withColumn(carry_out, F.lit(None).cast(
                    self.rows.schema[carry].dataType))
            return r.withColumn("_nchunks", F.lit(1))
        aggs = [F.max_by(F.col(f"`{carry}`"), F.col(f"`{self.seq}`")).alias("_last")] if carry else []
        wk = Window.partitionBy(*qcols(self.keys)).orderBy(CHUNK)
        info = self.chunk_table(*aggs)
        cols = [*qcols(self.keys), CHUNK,
                F.count(F.lit(1)).over(wk.rowsBetween(Window.unboundedPreceding,
                                                      Window.unboundedFollowing))
                .alias("_nchunks")]
        if carry:
            cols.append(F.lag("_last").over(wk).alias(carry_out))
        info = info.select(*cols)
        if key_info is not None:
            info = join_on(info, key_info, self.keys, "left", self.null_keys)
        return self.attach(info)


def keyed_lag(df: DataFrame, keys, seq: str, cols, prefix: str = "prev_",
              names: dict | None = None, rows_per_chunk: int | None = None) -> DataFrame:
    """``LAG(c) OVER (PARTITION BY keys ORDER BY seq)`` for several columns,
    split into chunks for keys with very many rows.  A NULL value is a
    real previous value, so the first row of a chunk takes the carried
    value and the others take the in-chunk lag."""
    keys = list(keys)
    names = names or {}
    out_names = [names.get(c, prefix + c) for c in cols]
    ko = KeyedOrder(df.withColumn("_vals", F.struct(*[F.col(f"`{c}`") for c in cols])),
                    keys, seq, rows_per_chunk, null_keys=True)
    w = ko.window()
    r = ko.with_key_info(None, carry="_vals").withColumn("_rn", F.row_number().over(w))
    for c, o in zip(cols, out_names):
        r = r.withColumn(o, F.when(F.col("_rn") == 1, F.col(f"_carry.`{c}`"))
                         .otherwise(F.lag(F.col(f"`{c}`")).over(w)))
    return r.drop("_rn", "_carry", "_vals", "_nchunks", CHUNK, SEQN)
