"""VERSION-SET fold: a row is compared with *all* stored versions of its key.

Sequential meaning: scan the key's versions by occurrence, the first with
an equal hash is matched (touched; for rosters reactivated); if none
matches the row is inserted as occurrence ``max + 1``.  Set form:

    first = per (key, hash) in the batch: earliest row (its columns win)
    new   = first rows whose (key, hash) is not stored (anti-join)
    occ   = max stored occurrence + rank of ``new`` rows in batch order

With ``active_col`` (rosters) every stored active row is first switched
off; versions whose (key, hash) is in the batch and every inserted row
are active afterwards.  NULL-key rows never match and are inserted as
occurrence 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.common import (CREATED, HASH, OCC, UPDATED,
                                       FoldResult, project_like, ts_literal)
from tidemark.operators.sequence import KeyedOrder, checked_order, complete_key, qcols

UNB = Window.unboundedPreceding
UNF = Window.unboundedFollowing


def version_set_fold(state: DataFrame, batch: DataFrame, key, run_ts,
                     seq: str = "seq", hash_col: str = HASH,
                     active_col: str | None = None,
                     rows_per_chunk: int | None = None, keep=None) -> FoldResult:
    key = list(key)
    kh = key + [hash_col]
    ts = ts_literal(run_ts)
    ok = complete_key(key)
    rows = batch.where(ok)
    loose = batch.where(~ok)
    data_cols = [c for c in batch.columns]

    # earliest batch row per (key, hash), of equal ones the least; later equal
    # rows are "unchanged".  A NULL in the order column is carried along, to
    # be refused below
    order = F.col(f"`{seq}`")
    first = (rows.groupBy(*qcols(kh))
             .agg(F.min(F.struct(order.alias("seq"), F.struct(
                 *[F.col(f"`{c}`") for c in data_cols if c not in kh]).alias("row"))).alias("_f"),
                  F.max(order.isNull()).alias("_null"))
             .select(*qcols(kh), F.when(~F.col("_null"), F.col("_f.seq")).alias("_first"),
                     F.col("_f.row").alias("_row")))
    stored = state.where(ok)
    unseen = first.join(stored.select(*qcols(kh)), kh, "left_anti")

    st_base = stored.groupBy(*qcols(key)).agg(F.max(OCC).alias("_base"))
    ko = KeyedOrder(unseen, key, "_first", rows_per_chunk)
    w = ko.window()
    r = ko.with_key_info(st_base)
    r = (r.withColumn("_lrun", checked_order("_first", w, F.row_number().over(w)))
          .withColumn("_ltot", F.count(F.lit(1)).over(w.rowsBetween(UNB, UNF))))
    r = ko.offsets(r, "_ltot", "_run", "_tot", "_lrun")
    r = r.withColumn(OCC, (F.coalesce(F.col("_base"), F.lit(0)) + F.col("_run")).cast("int"))
    r = r.select("*", "_row.*").drop("_row")
    if keep is not None:
        r = keep(r)

    computed = {OCC: F.col(OCC), hash_col: F.col(hash_col), CREATED: ts, UPDATED: ts}
    if active_col:
        computed[active_col] = F.lit(True)
    ins = project_like(r, state.schema, computed)
    loose_computed = dict(computed, **{OCC: F.lit(1)})
    ins_loose = project_like(loose, state.schema, loose_computed)

    # stored versions: the first version (lowest occurrence) with a hash
    # present in the batch is matched
    # (the lowest occurrence comes from key, hash and occurrence alone; the
    # wide rows are joined with it, not sorted)
    lowest = (stored.select(*qcols(kh), OCC).join(first.select(*qcols(kh)), kh, "left_semi")
              .groupBy(*qcols(kh)).agg(F.min(OCC).alias("_min_occ")))
    m = stored.join(lowest, kh, "left")
    matched = F.coalesce(F.col(OCC) == F.col("_min_occ"), F.lit(False))
    upd = {UPDATED: F.when(matched, ts).otherwise(F.col(UPDATED))}
    if active_col:
        was = F.coalesce(F.col(active_col), F.lit(False))
        upd = {active_col: matched,
               UPDATED: F.when(matched | was, ts).otherwise(F.col(UPDATED))}
    kept = project_like(m, state.schema, upd)
    loose_state = state.where(~ok)
    if active_col:
        was = F.coalesce(F.col(active_col), F.lit(False))
        loose_state = project_like(loose_state, state.schema, {
            active_col: F.lit(False),
            UPDATED: F.when(was, ts).otherwise(F.col(UPDATED))})
    kept = kept.unionByName(loose_state)

    inserted = ins.unionByName(ins_loose)

    # all counters in one aggregate over tagged rows: batch rows (_p),
    # inserted rows with their occurrence (_i), stored rows left inactive (_d)
    def tag(df, p, i, occ, d):
        return df.select(F.lit(p).alias("_p"), F.lit(i).alias("_i"),
                         occ.cast("int").alias(OCC), d.cast("int").alias("_d"))
    parts = (tag(batch, 1, 0, F.lit(None), F.lit(0))
             .unionByName(tag(r, 0, 1, F.col(OCC), F.lit(0)))
             .unionByName(tag(loose, 0, 1, F.lit(1), F.lit(0))))
    if active_col:
        # inserted rows are all active: the inactive rows after the run are
        # the stored ones left unmatched
        parts = parts.unionByName(tag(kept, 0, 0, F.lit(None),
                                      ~F.coalesce(F.col(active_col), F.lit(False))))
    def total(c):                       # 0, not NULL, for an empty batch
        return F.coalesce(F.sum(c), F.lit(0))
    aggs = [total("_p").cast("bigint").alias("total_processed"),
            F.count_if((F.col("_i") == 1) & (F.col(OCC) == 1)).cast("bigint").alias("new_records"),
            F.lit(0).cast("bigint").alias("updated_records"),
            (total("_p") - total("_i")).cast("bigint").alias("unchanged_records"),
            F.count_if((F.col("_i") == 1) & (F.col(OCC) > 1)).cast("bigint")
            .alias("new_occurrences")]
    if active_col:
        aggs.append(total("_d").cast("bigint").alias("deactivated_records"))
    metrics = parts.agg(*aggs)
    return FoldResult(kept=kept, inserted=inserted, metrics=metrics, classified=r,
                      seen=m.where(matched))
