"""Merging rows into keyed tables where a row may write only some of its fields.

A left join rewrites the met rows, and new keys are added. Updates are few against the table they
meet; the planner broadcasts them where its byte limit allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions import values
from docweave.operators import sizes

# Fields of a state row that each kind of update writes; the rest survive.
FAILED_FIELDS = ("status", "error", "last_synced_at")
DELETED_FIELDS = ("status", "error", "last_synced_at")
TOUCHED_FIELDS = ("modified_time", "last_synced_at")
INDEXED_FIELDS = ("status", "last_synced_at")
FIELDS = "__fields"


def writes(df: DataFrame, *fields: str) -> DataFrame:
    """Mark updates as writing only ``fields``; none means every field, NULLs included."""
    marked = F.array(*[F.lit(f) for f in fields]) if fields else F.lit(None).cast("array<string>")
    return df.withColumn(FIELDS, marked)


def merge_rows(target: DataFrame, updates: DataFrame, key: str = "file_id") -> DataFrame:
    """``target`` after ``updates`` (one row per key), in the columns of ``target``."""
    if FIELDS not in updates.columns:
        updates = writes(updates)
    columns = [c for c in target.columns if c != key]

    def field(c: str) -> Column:
        kind = target.schema[c].dataType
        return (F.col(c) if c in updates.columns else F.lit(None)).cast(kind).alias(f"__new_{c}")

    renamed = updates.select(key, FIELDS, F.lit(True).alias("__met"), *[field(c) for c in columns])

    def written(c: str) -> Column:
        named = F.col(FIELDS).isNull() | F.array_contains(FIELDS, c)
        return F.when(F.col("__met") & named, F.col(f"__new_{c}"))

    met = target.join(renamed, key, "left").select(
        key, *[written(c).otherwise(F.col(c)).alias(c) for c in columns]
    )
    added = renamed.join(target.select(key), key, "left_anti").select(key, *[written(c).alias(c) for c in columns])
    return met.unionByName(added)


def stub_defaults(state: DataFrame) -> DataFrame:
    """Defaults that a reader gives to fields a partial row did not write."""
    return (
        state.withColumn("drive_id", F.coalesce("drive_id", F.lit("")))
        .withColumn("name", F.coalesce("name", F.lit("")))
        .withColumn("mime_type", F.coalesce("mime_type", F.lit("")))
        .withColumn("status", values.status(F.col("status")))
        .withColumn("parse_route", values.parse_route(F.col("parse_route")))
        .withColumn("audience", values.audience(F.col("audience")))
    )


def failed_rows(rows: DataFrame, now: Column) -> DataFrame:
    """Updates of documents that failed: ``reason`` becomes the error, in full."""
    update = rows.withColumn("status", F.lit("FAILED")).withColumn("error", F.col("reason")).withColumn(
        "last_synced_at", now
    )
    named = [f for f in ("drive_id", "name", "mime_type", "modified_time", "source_uri") if f in rows.columns]
    return writes(update, *FAILED_FIELDS, *named)


def deleted_rows(ids: DataFrame, now: Column) -> DataFrame:
    update = ids.select(
        "file_id", F.lit("DELETED").alias("status"), F.lit(None).cast("string").alias("error"),
        now.alias("last_synced_at"),
    )
    return writes(update, *DELETED_FIELDS)


def touched_rows(rows: DataFrame, now: Column, with_audience: bool) -> DataFrame:
    """Updates of unchanged documents: only the change time moves, never the status."""
    update = rows.filter(F.coalesce("modified_time", F.lit("")) != "").withColumn("last_synced_at", now)
    return writes(update, *TOUCHED_FIELDS, *(("audience",) if with_audience else ()))


def mark_indexed(
    state: DataFrame, queues: list[DataFrame], ids: DataFrame, now: Column
) -> tuple[DataFrame, list[DataFrame]]:
    """State and queues after a set of ids was indexed.

    An id without a state row gets a stub; one that had failed leaves the queues, the one of retries
    and the one of splits alike.
    """
    update = ids.select("file_id").distinct().select(
        "file_id", F.lit("INDEXED").alias("status"), now.alias("last_synced_at")
    )
    recovered = state.filter(F.col("status") == "FAILED").join(update, "file_id", "left_semi")
    merged = merge_rows(state, writes(update, *INDEXED_FIELDS))
    return merged, [clear(queue, recovered) for queue in queues]


def enqueue(queue: DataFrame, rows: DataFrame, now: Column) -> DataFrame:
    """Queue after ``rows`` with a reason entered it; an earlier attempt count survives."""
    entry = rows.withColumn("enqueued_at", now)
    named = [c for c in entry.columns if c in queue.columns and c != "file_id"]
    return merge_rows(queue, writes(entry, *named))


def clear(queue: DataFrame, ids: DataFrame) -> DataFrame:
    return sizes.rows_without(queue, ids)


def record_attempts(queue: DataFrame, ids: DataFrame, now: Column) -> DataFrame:
    """Attempt counts raised by one, before the attempts are made."""
    old = queue.select("file_id", "retry_count")
    update = ids.select("file_id").distinct().join(old, "file_id", "left").select(
        "file_id", (F.coalesce("retry_count", F.lit(0)) + 1).alias("retry_count"), now.alias("last_retry_at")
    )
    return merge_rows(queue, writes(update, "retry_count", "last_retry_at"))
