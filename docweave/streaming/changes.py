"""The change feed as a stream of bounded micro-batches.

A batch is planned, applied and checked as a whole. Only the rows of the files it names are read and
written; they are published under the batch id when its gate passes. Otherwise the batch fails, the offset
stays where it was and the same rows come again. Parked files do not fail a batch, unknown scopes and
failures do.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docweave import schemas
from docweave.options import SyncOptions
from docweave.plans import sync
from docweave.session import cut_lineage
from docweave.sources import readers
from docweave.sources.store import FILE_TABLES as TABLES
from docweave.sources.store import TableStore

COMPACT_EVERY = 32


class BatchRefused(RuntimeError):
    """The gate of a micro-batch did not pass."""


def read_feed(spark: SparkSession, folder: str, max_files: int = 1) -> DataFrame:
    """Feed files in the order they appear, at most ``max_files`` in a micro-batch."""
    return (
        spark.readStream.schema(schemas.CHANGE)
        .option("maxFilesPerTrigger", max_files)
        .parquet(folder)
    )


def apply_batch(
    changes: DataFrame, batch_id: int, store: TableStore, folders: DataFrame,
    measure: Callable[[DataFrame], DataFrame], bucket: str, opts: SyncOptions, now: Column,
    closure: DataFrame | None = None,
) -> None:
    """Plan and apply one batch, then publish it if every drive's counts agree."""
    current = store.version()
    if current is not None and current >= batch_id + 1:
        return  # published before the offset was committed
    named = cut_lineage(readers.has_file_id(changes).select("file_id").distinct())
    tables = store.read_all(TABLES, named, current)
    planned = sync.plan_changes(changes, tables["state"], folders, measure(changes), opts, closure)
    store.stage(batch_id + 1, sync.apply_changes(planned, tables, bucket, now, opts), named)
    # The gate counts what was written, not what was meant to be.
    indexed = sync.indexed_counts(planned, store.staged(batch_id + 1, "staff_index"), bucket)
    ends = changes.groupBy("drive_id").agg(F.max("seq").alias("token")).withColumn("has_more", F.lit(False))
    report = sync.run_report(planned, indexed, ends, opts)
    refused = report.filter(~F.col("commit")).select("drive_id", "failed", "unaccounted").head(1)
    if refused:
        raise BatchRefused(f"batch {batch_id} refused: {refused[0].asDict()}")
    store.publish(batch_id + 1)
    if (batch_id + 1) % COMPACT_EVERY == 0:
        store.compact()


def run_changes(
    feed: DataFrame, store: TableStore, folders: DataFrame, measure: Callable[[DataFrame], DataFrame],
    bucket: str, opts: SyncOptions, checkpoint: str, now: Column | None = None, closure: DataFrame | None = None,
) -> StreamingQuery:
    """Take all files that are there, batch by batch, and stop. Version 0 must be published."""
    def step(changes: DataFrame, batch_id: int) -> None:
        # One time for all tables of a batch.
        stamp = now if now is not None else F.lit(dt.datetime.now(dt.timezone.utc))
        apply_batch(changes, batch_id, store, folders, measure, bucket, opts, stamp, closure)

    return (
        feed.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
