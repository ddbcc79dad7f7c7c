"""Run a sync job per micro-batch of a file stream.

Not a capability of the reference (its runs are whole staging snapshots);
this lets a streaming source feed the same ``run_sync`` with Structured
Streaming's ``foreachBatch``.  Each micro-batch is one run; its batch id
goes into the run log's ``notes`` and, in the same commit as its changes,
into the manifest; a batch already applied is skipped, so a micro-batch
retried after a failure is not applied twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.plans.entities import ENTITIES
from tidemark.plans.jobs import run_sync
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources.store import TableStore


def _already_applied(store: TableStore, log: str, tag: str) -> bool:
    # the tag is published in the same commit as the batch's changes, and
    # only the newest batch can be retried
    return store.snapshot().applied.get(log) == tag


def start_sync_stream(spark: SparkSession, store: TableStore, name: str, source: str,
                      schema: T.StructType, fmt: str = "parquet",
                      order_by: str | None = None, checkpoint: str | None = None,
                      available_now: bool = True, options: dict | None = None):
    """Start a stream over ``source`` that syncs ``name`` once per micro-batch.

    ``checkpoint`` defaults to a folder under the cluster's
    ``spark.checkpoint.dir``.  Returns the ``StreamingQuery``.
    """
    entity = ENTITIES[name]
    checkpoint = checkpoint or f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{name}"
    stream = spark.readStream.format(fmt).schema(schema).options(**(options or {})).load(source)

    def apply(batch: DataFrame, batch_id: int) -> None:
        tag = f"stream batch {batch_id}"
        if _already_applied(store, entity.log_name, tag):
            return
        run_sync(spark, store, name, batch, order_by=order_by, notes=tag)

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
