"""Column names and the result type shared by the folds."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OCC = "occurrence_number"
HASH = "data_hash"
ACTIVE = "is_active"
CREATED = "created_at"
UPDATED = "updated_at"
ID = "id"

# Columns a fold maintains itself; everything else is data.
HISTORY_COLUMNS = (ID, OCC, HASH, ACTIVE, "active", CREATED, UPDATED)

SCD_METRICS = ("total_processed", "new_records", "updated_records",
               "unchanged_records", "new_occurrences")


def ts_literal(run_ts) -> Column:
    """One literal per run for created_at/updated_at (the reference reads
    the transaction timestamp, which is constant inside a run)."""
    if isinstance(run_ts, str):
        run_ts = _dt.datetime.fromisoformat(run_ts)
    # from text: a wall-clock value, untouched by any time zone
    return F.lit(run_ts.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")


def project_like(df: DataFrame, schema: T.StructType,
                 computed: dict[str, Column] | None = None) -> DataFrame:
    """Select ``schema``'s columns from ``df`` in order: computed ones first,
    then same-named columns, else typed NULLs."""
    computed = computed or {}
    have = set(df.columns)
    out = []
    for f in schema.fields:
        if f.name in computed:
            c = computed[f.name]
        elif f.name in have:
            c = F.col(f"`{f.name}`")
        else:
            c = F.lit(None)
        out.append(c.cast(f.dataType).alias(f.name))
    return df.select(out)


def history_schema(data: T.StructType, family: str = "scd") -> T.StructType:
    """State schema: data columns plus the history columns of a family.

    ``scd`` (SCD2 and SCD1-HASH): occurrence, hash, is_active, stamps.
    ``versions`` (version set): no active flag.  ``roster``: ``active``.
    ``upsert``: stamps only.
    """
    # an upsert table keeps its own key (often ``id``); only the stamps are
    # maintained by the job
    reserved = (CREATED, UPDATED) if family == "upsert" else HISTORY_COLUMNS
    fields = [f for f in data.fields if f.name not in reserved]
    extra = []
    if family in ("scd", "versions", "roster"):
        extra += [T.StructField(OCC, T.IntegerType()), T.StructField(HASH, T.StringType())]
    if family == "scd":
        extra.append(T.StructField(ACTIVE, T.BooleanType()))
    if family == "roster":
        extra.append(T.StructField("active", T.BooleanType()))
    extra += [T.StructField(CREATED, T.TimestampNTZType()),
              T.StructField(UPDATED, T.TimestampNTZType())]
    return T.StructType(fields + extra)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a join side that grows with the tables: both sides are
    shuffled, neither is collected on the driver.  The engine estimates rows
    from compressed files and cached blocks, where constant and consecutive
    values take next to nothing, and would broadcast millions of them."""
    return df.hint("merge")


def empty_like(spark, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def key_summary(state: DataFrame, key, hash_col: str = HASH, active_col: str = ACTIVE) -> DataFrame:
    """What the SCD folds need to know of a whole key: ``_base``, its highest
    occurrence over all versions (there may be inactive ones only), and
    ``_act``, the hash of its active version."""
    active = F.col(active_col)
    whole = reduce(and_, [F.col(f"`{k}`").isNotNull() for k in key])
    return (state.where(whole).groupBy(*[F.col(f"`{k}`") for k in key])
            .agg(F.max(OCC).alias("_base"),
                 F.max_by(F.when(active, F.col(hash_col)), F.when(active, F.col(OCC))).alias("_act")))


@dataclass
class FoldResult:
    """What one sync run produces.

    ``kept``: stored rows after the run's in-place changes; ``inserted``:
    new rows; ``metrics``: one row of counters; ``classified``: batch rows
    with their flags (persist it when state and metrics are both used).
    """
    kept: DataFrame
    inserted: DataFrame
    metrics: DataFrame
    classified: DataFrame | None = None
    extra: dict = field(default_factory=dict)
    # Optional split of ``kept``: stored rows the run cannot change (for the
    # SCD folds: inactive versions) and the rest.  A store may keep the
    # untouched rows where they are and write only touched + inserted.
    untouched: DataFrame | None = None
    touched: DataFrame | None = None
    # stored rows that the batch holds again (version sets)
    seen: DataFrame | None = None
    # the ``key_summary`` after the run of the keys that the batch holds
    keys: DataFrame | None = None
    # ``inserted`` as rows with and without a whole key, and what numbers the
    # former by key: ``_new`` occurrences beyond ``_old`` (for the SCD2 fold)
    inserted_parts: tuple[DataFrame, DataFrame] | None = None
    per_key: DataFrame | None = None

    @property
    def state(self) -> DataFrame:
        return self.kept.unionByName(self.inserted)
