"""Ingest planning and state keeping for pages of changes and for full loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.operators import corpus, merge, reconcile, routing, scope, sizes
from docweave.operators.postprocess import CLEANUP_FAILED
from docweave.options import SyncOptions
from docweave.session import cut_lineage
from docweave.sources import readers

# Measures of what was read; NULL where nothing was.
MEASURES = {
    "raw_bytes": "bigint", "md_bytes": "bigint", "parts": "int", "content_hash": "string",
    "rejection": "string", "sheet_error": "string", "body": "string",
}


def with_prefixed_state(changes: DataFrame, state: DataFrame) -> DataFrame:
    fields = [c for c in state.columns if c != "file_id"]
    stored = sizes.rows_of(state, changes).select("file_id", F.lit(True).alias("has_state"), *[F.col(c).alias(f"state_{c}") for c in fields])
    return changes.join(stored, "file_id", "left").withColumn("has_state", F.coalesce("has_state", F.lit(False)))


def file_parents(changes: DataFrame) -> DataFrame:
    """A row for each parent of a change's file; a file without parents has one NULL."""
    if "parent_id" in changes.columns:
        return changes.select("file_id", "parent_id")
    return changes.select("file_id", F.explode_outer("parents").alias("parent_id"))


def plan_changes(
    changes: DataFrame, state: DataFrame, folders: DataFrame, measures: DataFrame, opts: SyncOptions,
    closure: DataFrame | None = None,
) -> DataFrame:
    """The outcome of each file's last change: route, scope, audience, path, disposition, reason.

    ``closure`` is the stored one of ``folders``, built here where none is given. The plan, one row per changed file, is written to the checkpoint folder: everything that
    applies it reads it, so it must be computed once and stay the same.
    """
    latest = cut_lineage(routing.latest_changes(readers.has_file_id(changes)))
    closure = scope.folder_closure(folders) if closure is None else closure
    scopes = scope.resolve_scope(file_parents(latest), folders, opts.sync_roots, opts.student_roots, closure)
    routed = routing.route_changes(latest, scopes.drop("audience"))
    placed = routed.join(scopes.select("file_id", "audience"), "file_id", "left")
    if "parent_id" not in placed.columns:
        placed = placed.withColumn("parent_id", F.get("parents", F.lit(0)))
    placed = scope.file_paths(placed, folders, closure)
    known = [c for c in MEASURES if c in measures.columns]
    measured = placed.join(measures.select("file_id", *known), "file_id", "left")
    for name, kind in MEASURES.items():
        if name not in known:
            measured = measured.withColumn(name, F.lit(None).cast(kind))
    return cut_lineage(routing.dispose(with_prefixed_state(measured, state), opts))


def snapshot_plan(
    files: DataFrame, state: DataFrame, folders: DataFrame, measures: DataFrame, opts: SyncOptions,
    closure: DataFrame | None = None,
) -> DataFrame:
    """The same plan for a full load: files in place and in scope, unsupported ones left out."""
    listed = readers.snapshot(files).withColumn("seq", F.lit(0).cast("bigint")).withColumn("removed", F.lit(False))
    if "web_view_link" not in listed.columns:
        listed = listed.withColumn("web_view_link", F.lit(None).cast("string"))
    return routing.snapshot_rows(plan_changes(listed, state, folders, measures, opts, closure))


def with_cleanup(planned: DataFrame) -> DataFrame:
    """``cleanup_error``, NULL where the plan has none: why an eviction did not succeed."""
    if "cleanup_error" in planned.columns:
        return planned
    return planned.withColumn("cleanup_error", F.lit(None).cast("string"))


def state_updates(planned: DataFrame, bucket: str, now: Column, opts: SyncOptions) -> DataFrame:
    """State rows to merge: one for each planned file that writes any."""
    d = F.col("disposition")
    fields = [c for c in (
        "file_id", "drive_id", "name", "mime_type", "modified_time", "content_hash", "status", "parse_route",
        "last_synced_at", "error", "source_uri", "rag_file_id", "path", "bundle", "audience", merge.FIELDS,
    )]

    def shaped(df: DataFrame) -> DataFrame:
        for c in fields:
            if c not in df.columns:
                kind = "array<string>" if c == merge.FIELDS else "timestamp" if c == "last_synced_at" else "string"
                df = df.withColumn(c, F.lit(None).cast(kind))
        return df.select(*fields)

    ready = corpus.parsed_state_rows(planned.filter(d == "GCS_READY"), bucket, now)
    skipped = planned.filter(d == "SKIPPED").select(
        "file_id", "drive_id", "name", "mime_type", "modified_time", F.lit("SKIPPED").alias("status"),
        F.lit("NONE").alias("parse_route"), F.col("web_view_link").alias("source_uri"),
        now.alias("last_synced_at"), F.lit("STAFF").alias("audience"),
    )
    excluded = corpus.evicted_rows(with_cleanup(planned).filter(d == "EXCLUDED"), now)
    deleted = merge.deleted_rows(planned.filter(d == "DELETE_PENDING"), now)
    failed = merge.failed_rows(
        planned.filter(d.isin("DLQ", "SPLIT_QUEUED", "FAILED")).select(
            "file_id", "drive_id", "name", "mime_type", "modified_time", "reason"
        ), now,
    )
    same = planned.filter(d == "HASH_UNCHANGED").select("file_id", "modified_time", "audience", "route")
    moves = (F.col("route") == "HWP_PARSE") if opts.legacy_audience else F.lit(True)
    touched = merge.touched_rows(same.filter(moves), now, True)
    if opts.legacy_audience:
        touched = touched.unionByName(merge.touched_rows(same.filter(~moves), now, False))
    out = shaped(ready)
    for part in (skipped, excluded, deleted, failed, touched):
        out = out.unionByName(shaped(part))
    return out


def apply_changes(
    planned: DataFrame, tables: dict[str, DataFrame], bucket: str, now: Column, opts: SyncOptions
) -> dict[str, DataFrame]:
    """All tables after a plan: state, retry queue, split queue, objects, staff and student index.

    ``tables`` has state, retry_queue, split_queue, objects, staff_index and student_index, the
    indexes as (file_id, uri). Ready files enter the staff index with all their objects, and
    the student index if they are open to students; both change in the same step. They are then
    INDEXED, so that an equal page finds them unchanged, and leave the queues. A file whose
    eviction failed (``cleanup_error`` in the plan) keeps its objects and waits in the retry queue.
    """
    planned = with_cleanup(planned)
    d = F.col("disposition")
    ready = planned.filter(d == "GCS_READY")
    stuck = (d == "EXCLUDED") & F.col("cleanup_error").isNotNull()
    gone = planned.filter(d.isin("DELETE_PENDING", "EXCLUDED") & ~stuck)
    made = corpus.source_objects(ready).select(
        "file_id", F.lit(bucket).alias("bucket"), F.col("object_name").alias("name")
    )
    uris = made.select("file_id", F.concat(F.lit("gs://"), "bucket", F.lit("/"), "name").alias("uri"))
    open_files = ready.filter(F.col("audience") == "STUDENT").select("file_id")
    # A queue row keeps what a later run needs to try again: the link, the path and the route.
    linked = planned.withColumn("source_uri", F.col("web_view_link")).withColumn("parse_route", F.col("route"))
    evicted = F.concat(F.lit(f"{CLEANUP_FAILED}: "), "cleanup_error")
    parked = linked.filter(d.isin("DLQ", "FAILED") | stuck).withColumn(
        "reason", F.when(stuck, evicted).otherwise(F.col("reason"))
    )
    split = linked.filter(d == "SPLIT_QUEUED").withColumn(
        "size_bytes", F.coalesce("md_bytes", "raw_bytes", "size_bytes")
    )
    touched = ready.select("file_id").unionByName(gone.select("file_id"))
    objects = corpus.delete_objects(tables["objects"], gone)
    body_names = made.filter(F.col("name").endswith(".md"))
    objects = objects.join(body_names.select("bucket", "name"), ["bucket", "name"], "left_anti").unionByName(
        made.select("bucket", "name")
    ).dropDuplicates(["bucket", "name"])
    indexed = uris.select("file_id").distinct()
    retries, splits = (
        merge.clear(merge.enqueue(tables[name], rows, now), indexed.unionByName(gone.select("file_id")))
        for name, rows in (("retry_queue", parked), ("split_queue", split))
    )
    merged = merge.merge_rows(tables["state"], state_updates(planned, bucket, now, opts))
    state, _ = merge.mark_indexed(merged, [], indexed, now)
    return {
        "state": state,
        "retry_queue": retries,
        "split_queue": splits,
        "objects": corpus.drop_stale_sidecars(objects, bucket),
        "staff_index": corpus.delete_files(tables["staff_index"], touched).unionByName(uris),
        "student_index": corpus.delete_files(tables["student_index"], touched).unionByName(
            uris.join(open_files, "file_id", "left_semi")
        ),
    }


def indexed_counts(planned: DataFrame, index: DataFrame, bucket: str) -> DataFrame:
    """(drive_id, indexed): how many of the plan's objects an index really holds."""
    ready = planned.filter(F.col("disposition") == "GCS_READY")
    wanted = corpus.source_objects(ready).select(
        "file_id", F.concat(F.lit(f"gs://{bucket}/"), "object_name").alias("uri")
    )
    held = wanted.join(index.select("file_id", "uri").distinct(), ["file_id", "uri"], "left_semi")
    return held.join(ready.select("file_id", "drive_id"), "file_id").groupBy("drive_id").agg(
        F.count(F.lit(1)).alias("indexed")
    )


def outcomes(planned: DataFrame) -> DataFrame:
    """(file_id, drive_id, disposition, uri_count) of a plan, for its totals."""
    counts = corpus.source_objects(planned.filter(F.col("disposition") == "GCS_READY")).groupBy("file_id").agg(
        F.count(F.lit(1)).alias("uri_count")
    )
    return planned.select("file_id", "drive_id", "disposition").join(counts, "file_id", "left")


def run_report(planned: DataFrame, indexed: DataFrame, tokens: DataFrame, opts: SyncOptions, page: int = 1) -> DataFrame:
    """Totals, reconciliation and gates of each drive's page.

    ``indexed`` has (drive_id, indexed); ``tokens`` comes from the page scan.
    """
    totals = reconcile.run_totals(outcomes(planned)).join(indexed, "drive_id", "left").withColumn(
        "indexed", F.coalesce("indexed", F.lit(0))
    )
    checked = reconcile.reconcile(totals).withColumn(
        "index_failed", F.greatest(F.lit(0), F.col("uris") - F.col("indexed"))
    )
    token = tokens.select("drive_id", F.col("token").cast("string").alias("token"), "has_more")
    return reconcile.commit_gates(
        checked.join(token, "drive_id", "left").withColumn("page", F.lit(page)), opts.max_pages
    )
