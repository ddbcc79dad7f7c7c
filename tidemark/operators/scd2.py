"""SCD2 fold: a changed row closes the active version and opens the next.

Sequential meaning (one staging row at a time, in ``seq`` order): look up
the active version of the key; equal hash -> touch it; different hash ->
deactivate it and insert the row as occurrence ``max + 1``; no active
version -> insert.  Set form (proved equal by the replay tests):

    prev  = lag(hash) in batch order, for the first row the active hash
    chg   = prev is NULL or prev <> hash
    occ   = max stored occurrence + running count of chg
    insert rows with chg; the last one of a key is active
    the stored active version is touched when its key is in the batch and
    closed when any row of the key changed

Rows with a NULL key part never match (``=`` lookups), so each is inserted
as occurrence 1.  A batch whose rows of one key tie in ``seq``, or hold a NULL
there, is refused.

``keys`` is the stored summary of the batch's keys (``common.key_summary``);
with it the fold reads no inactive version.

Flags, counters and the new summary come from one row per key
(``per_key``; persist it when several of them are used).  ``keep`` (for
example ``sources.scratch.keep_table``) materialises the classified batch,
which the inserts and ``per_key`` read; without it each of them runs the
join, sort and window, ``per_key`` on a few columns only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.common import (ACTIVE, CREATED, HASH, OCC, SCD_METRICS, UPDATED,
                                       FoldResult, key_summary, project_like, shuffled,
                                       ts_literal)
from tidemark.operators.sequence import KeyedOrder, checked_order, complete_key, qcols

UNB = Window.unboundedPreceding
UNF = Window.unboundedFollowing


def scd2_fold(state: DataFrame, batch: DataFrame, key, run_ts, seq: str = "seq",
              hash_col: str = HASH, active_col: str = ACTIVE,
              rows_per_chunk: int | None = None, keep=None, keys: DataFrame | None = None) -> FoldResult:
    key = list(key)
    ts = ts_literal(run_ts)
    ok = complete_key(key)
    h = F.col(hash_col)
    rows, loose = batch.where(ok), batch.where(~ok)

    # per stored key: the summary kept beside the history, or else four
    # narrow columns of the whole history
    st_keys = keys if keys is not None else key_summary(state, key, hash_col, active_col)
    is_act = F.col(active_col)

    ko = KeyedOrder(rows, key, seq, rows_per_chunk)
    w = ko.window()
    r = ko.with_key_info(st_keys, carry=hash_col)
    r = r.withColumn("_prev", F.coalesce(F.lag(h).over(w), F.col("_carry"), F.col("_act")))
    r = r.withColumn("_chg", checked_order(
        seq, w, (F.col("_prev").isNull() | (F.col("_prev") != h)).cast("int")))
    r = (r.withColumn("_lrun", F.sum("_chg").over(w.rowsBetween(UNB, 0)))
          .withColumn("_ltot", F.sum("_chg").over(w.rowsBetween(UNB, UNF))))
    r = ko.offsets(r, "_ltot", "_run", "_tot", "_lrun")
    r = r.withColumn(OCC, (F.coalesce(F.col("_base"), F.lit(0)) + F.col("_run")).cast("int"))

    if keep is not None:
        r = keep(r)
    # a row per key of the batch: its counters and what its rows change.  A
    # few columns of the rows give all of it, so whole rows pass once, to
    # where they are inserted
    had, changed = F.col("_prev").isNotNull(), F.col("_chg") == 1
    per_key = r.groupBy(*qcols(key)).agg(
        F.max(F.coalesce(F.col("_base"), F.lit(0))).alias("_old"), F.sum("_chg").alias("_new"),
        F.max_by(h, F.col(f"`{seq}`")).alias("_act"),
        *[c.alias(n) for n, c in _counters(changed, had).items()])
    ins = project_like(r.where(changed), state.schema, {
        OCC: F.col(OCC), hash_col: h,
        active_col: F.col("_run") == F.col("_tot"),
        CREATED: ts, UPDATED: ts})
    ins_loose = project_like(loose, state.schema, {
        OCC: F.lit(1), hash_col: h, active_col: F.lit(True),
        CREATED: ts, UPDATED: ts})

    # stored active versions: touched when the key is in the batch,
    # closed when any row of the key changed
    flags = per_key.select(*qcols(key), F.col("_new").alias("_any"))
    # (rows whose flag is NULL are neither: they are written as they are)
    act = state.where(is_act)
    rest = state.where(~is_act)
    upd = act.join(shuffled(flags), key, "left")
    upd = project_like(upd, state.schema, {
        active_col: F.coalesce(F.col("_any") == 0, F.lit(True)),
        UPDATED: F.when(F.col("_any").isNotNull(), ts).otherwise(F.col(UPDATED))})
    upd = upd.unionByName(state.where(is_act.isNull()))
    kept = rest.unionByName(upd)

    # rows without a whole key are all new
    loose_counts = loose.select(F.lit(1).alias(OCC)).agg(
        *[c.alias(n) for n, c in _counters(F.lit(True), F.lit(False)).items()])
    metrics = (per_key.select(*SCD_METRICS).unionByName(loose_counts)
               .agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in SCD_METRICS]))
    # the last batch row of a key has the hash that is active afterwards
    after = per_key.select(*qcols(key), (F.col("_old") + F.col("_new")).cast("int").alias("_base"),
                           "_act")
    return FoldResult(keys=after, kept=kept, inserted=ins.unionByName(ins_loose),
                      metrics=metrics, classified=per_key, untouched=rest, touched=upd,
                      inserted_parts=(ins, ins_loose), per_key=per_key)


def _counters(chg: Column, had: Column) -> dict[str, Column]:
    """Counters of the loop jobs: a row changed its key, the key had a row."""
    return dict(zip(SCD_METRICS, (
        F.count(F.lit(1)), F.count_if(chg & (F.col(OCC) == 1)), F.count_if(chg & had),
        F.count_if(~chg), F.count_if(chg & (F.col(OCC) > 1)))))


def scd_metrics(classified: DataFrame) -> DataFrame:
    """Counters of the loop jobs from per-row flags ``_chg``, ``_had``, occ."""
    return classified.agg(*[c.cast("bigint").alias(n) for n, c in
                            _counters(F.col("_chg") == 1, F.col("_had")).items()])
