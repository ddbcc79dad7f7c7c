"""SCD1-HASH fold: a changed row overwrites the active version in place.

Sequential meaning: look up the active version; equal hash -> touch it;
different hash -> overwrite all data columns and the hash; no active
version -> insert.  Set form:

    prev, chg   as in the SCD2 fold
    w           = the last changed row of the key (batch order)
    stored row  = data columns from ``w`` when the key changed; updated_at
                  = run time when the key is in the batch at all
    unknown key = one insert carrying ``w``'s columns

A later row with an equal hash does not refresh non-hashed columns, as in
the reference.  NULL-key rows never match: each is inserted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.common import (ACTIVE, CREATED, HASH, ID, OCC, UPDATED, FoldResult,
                                       key_summary, project_like, ts_literal)
from tidemark.operators.sequence import KeyedOrder, checked_order, complete_key, qcols

UNB = Window.unboundedPreceding
UNF = Window.unboundedFollowing

# stored columns an in-place overwrite keeps
_KEEP = (ID, OCC, CREATED, ACTIVE)


def scd1_fold(state: DataFrame, batch: DataFrame, key, run_ts, seq: str = "seq",
              hash_col: str = HASH, active_col: str = ACTIVE,
              rows_per_chunk: int | None = None, keep=None, keys: DataFrame | None = None) -> FoldResult:
    key = list(key)
    ts = ts_literal(run_ts)
    ok = complete_key(key)
    h = F.col(hash_col)
    rows, loose = batch.where(ok), batch.where(~ok)
    is_act = F.col(active_col)

    # highest occurrence over all stored versions, hash of the active one
    st_keys = keys if keys is not None else key_summary(state, key, hash_col, active_col)
    ko = KeyedOrder(rows, key, seq, rows_per_chunk)
    w = ko.window()
    r = ko.with_key_info(st_keys, carry=hash_col)
    r = r.withColumn("_prev", F.coalesce(F.lag(h).over(w), F.col("_carry"), F.col("_act")))
    r = r.withColumn("_chg", checked_order(
        seq, w, (F.col("_prev").isNull() | (F.col("_prev") != h)).cast("int")))

    if keep is not None:
        r = keep(r)

    data_cols = [c for c in batch.columns if c not in key]
    last = (r.groupBy(*qcols(key))
            .agg(F.max_by(F.when(F.col("_chg") == 1,
                                 F.struct(*[F.col(f"`{c}`") for c in data_cols])),
                          F.when(F.col("_chg") == 1, F.col(f"`{seq}`"))).alias("_w"),
                 F.max(F.col("_act").isNull().cast("int")).alias("_unknown"),
                 F.max("_base").alias("_base")))

    # stored active rows: overwrite from _w, touch when the key is present
    act = state.where(is_act)
    rest = state.where(~is_act)
    upd = act.join(last, key, "left")
    changed = F.col("_w").isNotNull()
    computed = {c: F.when(changed, F.col(f"_w.`{c}`")).otherwise(F.col(f"`{c}`"))
                for c in data_cols if c in state.columns and c not in _KEEP}
    computed[UPDATED] = F.when(F.col("_unknown").isNotNull(), ts).otherwise(F.col(UPDATED))
    upd = project_like(upd, state.schema, computed)
    upd = upd.unionByName(state.where(is_act.isNull()))  # written as they are
    kept = rest.unionByName(upd)

    new_keys = last.where(F.col("_unknown") == 1).select(*qcols(key), "_w.*", "_base")
    ins = project_like(new_keys, state.schema, {
        OCC: F.coalesce(F.col("_base"), F.lit(0)) + 1, active_col: F.lit(True),
        CREATED: ts, UPDATED: ts})
    ins_loose = project_like(loose, state.schema, {
        OCC: F.lit(1), active_col: F.lit(True), CREATED: ts, UPDATED: ts})

    chg = F.col("_chg") == 1
    first_ins = chg & F.col("_prev").isNull()
    cls = (r.select(chg.alias("_c"), F.col("_prev").isNotNull().alias("_had"),
                    first_ins.alias("_i"), F.col("_base").isNull().alias("_fresh"))
           .unionByName(loose.select(F.lit(True).alias("_c"), F.lit(False).alias("_had"),
                                     F.lit(True).alias("_i"), F.lit(True).alias("_fresh"))))
    metrics = cls.agg(
        F.count(F.lit(1)).cast("bigint").alias("total_processed"),
        F.count_if(F.col("_i") & F.col("_fresh")).cast("bigint").alias("new_records"),
        F.count_if(F.col("_c") & F.col("_had")).cast("bigint").alias("updated_records"),
        F.count_if(~F.col("_c")).cast("bigint").alias("unchanged_records"),
        F.count_if(F.col("_i") & ~F.col("_fresh")).cast("bigint").alias("new_occurrences"))
    # a key without an active version gains an occurrence; the last batch
    # row's hash is the active one
    after = r.groupBy(*qcols(key)).agg(
        (F.coalesce(F.max("_base"), F.lit(0)) + F.max(F.col("_act").isNull().cast("int")))
        .cast("int").alias("_base"), F.max_by(h, F.col(f"`{seq}`")).alias("_new"))
    after = after.withColumnRenamed("_new", "_act")
    return FoldResult(keys=after, kept=kept, inserted=ins.unionByName(ins_loose),
                      metrics=metrics, classified=r, untouched=rest, touched=upd)
