"""Run totals, the reconciliation of a run and the gates of its commit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COUNTERS = (
    "listed", "gcs_uploaded", "uris", "failed", "skipped", "deleted", "unchanged", "dlq",
    "split_queued", "parked", "excluded",
)


def run_totals(outcomes: DataFrame, keys: tuple[str, ...] = ("drive_id",)) -> DataFrame:
    """One row of counters per run from rows of (disposition, uri_count).

    A ready file without objects has failed; parked files do not count as failures; any outcome
    that is not known has failed.
    """
    d, uris = F.col("disposition"), F.coalesce("uri_count", F.lit(0))
    ready = d == "GCS_READY"
    known = {
        "gcs_uploaded": ready & (uris > 0),
        "unchanged": d.isin("UNCHANGED", "HASH_UNCHANGED"),
        "skipped": F.upper(d) == "SKIPPED",
        "deleted": d == "DELETE_PENDING",
        "excluded": d == "EXCLUDED",
        "dlq": d == "DLQ",
        "split_queued": d == "SPLIT_QUEUED",
    }
    other = F.lit(True)
    for condition in known.values():
        other = other & ~F.coalesce(condition, F.lit(False))
    return outcomes.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("listed"),
        F.count_if(known["gcs_uploaded"]).alias("gcs_uploaded"),
        F.coalesce(F.sum(F.when(known["gcs_uploaded"], uris)), F.lit(0)).alias("uris"),
        F.count_if(other).alias("failed"),
        *[F.count_if(known[c]).alias(c) for c in ("skipped", "deleted", "unchanged", "dlq", "split_queued")],
        F.count_if(known["dlq"] | known["split_queued"]).alias("parked"),
        F.count_if(known["excluded"]).alias("excluded"),
    )


def reconcile(totals: DataFrame) -> DataFrame:
    """Check that every listed file in scope is accounted for and every object indexed.

    ``totals`` has the counters and ``indexed``.
    """
    c = F.col
    accounted = c("gcs_uploaded") + c("failed") + c("parked") + c("skipped") + c("deleted") + c("unchanged")
    in_scope = c("listed") - c("excluded")
    baseline = F.when(c("uris") > 0, c("uris")).otherwise(c("gcs_uploaded"))
    return (
        totals.withColumn("listed_in_scope", in_scope)
        .withColumn("unaccounted", in_scope - accounted)
        .withColumn("index_consistent", c("indexed") == baseline)
        .withColumn("ok", (c("unaccounted") == 0) & c("index_consistent"))
    )


def import_outcome(requested: Column, imported: Column, failed: Column, skipped: Column) -> Column:
    """True if all that was sent is in the index; a missing import count is taken as success."""
    done = F.coalesce(imported, requested) + F.coalesce(skipped, F.lit(0))
    return (F.coalesce(failed, F.lit(0)) == 0) & (done >= requested)


def import_totals(batches: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Roll import calls (requested, imported, failed, skipped) up to their runs."""
    imported = F.coalesce("imported", "requested")
    sums = batches.groupBy(*keys).agg(
        F.sum("requested").alias("requested"), F.sum(imported).alias("imported"),
        F.sum(F.coalesce("failed", F.lit(0))).alias("failed"),
        F.sum(F.coalesce("skipped", F.lit(0))).alias("skipped"),
    )
    ok = import_outcome(*(F.col(c) for c in ("requested", "imported", "failed", "skipped")))
    return sums.withColumn("ok", ok).withColumn(
        "index_failed", F.greatest(F.lit(0), F.col("requested") - F.col("imported"))
    )


def may_commit(token: Column, failed: Column, index_failed: Column, indexed: Column, uris: Column, ok: Column) -> Column:
    """The token may move: nothing failed, everything indexed, the counts agree."""
    return (
        (F.coalesce(token, F.lit("")) != "") & (failed == 0) & (index_failed == 0)
        & (indexed == uris) & F.coalesce(ok, F.lit(False))
    )


def backfill_ok(totals: DataFrame) -> DataFrame:
    return totals.withColumn(
        "ok", (F.col("failed") == 0) & (F.col("index_failed") == 0) & (F.col("indexed") == F.col("uris"))
    )


def commit_gates(runs: DataFrame, max_pages: int) -> DataFrame:
    """Add ``commit`` and ``next_page`` to reconciled runs with token, has_more and page."""
    commit = may_commit(*(F.col(c) for c in ("token", "failed", "index_failed", "indexed", "uris", "ok")))
    return runs.withColumn("commit", commit).withColumn(
        "next_page", F.col("has_more") & F.col("commit") & (F.col("page") < max_pages)
    )


def commit_tokens(control: DataFrame, runs: DataFrame) -> DataFrame:
    """Control rows (drive_id, token) after the runs that may commit."""
    new = runs.filter(F.col("commit")).select("drive_id", "token")
    return control.join(new, "drive_id", "left_anti").unionByName(new)
