"""Staging scans: a full snapshot of what the loader wrote, read with any
Spark reader and projected to the columns a job uses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_staging(spark: SparkSession, path: str, fmt: str = "parquet",
                 schema: T.StructType | str | None = None, options: dict | None = None,
                 columns=None) -> DataFrame:
    """Read one staging table (parquet, csv, json, orc, ...).

    ``schema`` avoids inference on text formats; ``columns`` projects early
    so that only those columns are read (pruned at the scan); a requested
    column that is absent raises.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    if columns:
        absent = [c for c in columns if c not in df.columns]
        if absent:
            raise ValueError(f"staging at {path} has no column {', '.join(absent)}")
        df = df.select(*[f"`{c}`" for c in columns])
    return df
