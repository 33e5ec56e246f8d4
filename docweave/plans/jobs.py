"""Jobs over the keyed tables: the paged daily run, retries of failed files, reindexing.

A job goes on where its last commit stands. Tokens and cursors lie in the table ``control`` and move in the
same published page as the rows they stand for, so a job that is stopped anywhere, and started again,
neither loses nor repeats a page. Every page is planned by the planner of the feed.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave import schemas
from docweave.operators import merge, recover, sizes
from docweave.options import SyncOptions
from docweave.plans import sync
from docweave.session import cut_lineage
from docweave.sources import readers
from docweave.sources.store import FILE_TABLES, TableStore

RETRY, REINDEX = "retry-failed", "reindex:"
_TOKEN = "token:"


def _control(store: TableStore, values: dict[str, str | None]) -> DataFrame:
    rows = [(name, value) for name, value in values.items() if value is not None]
    return store.spark.createDataFrame(rows, schemas.CONTROL)


def cursors(store: TableStore) -> dict[str, str]:
    """Tokens and cursors by name: one short row for each drive and job."""
    return {r.file_id: r.value for r in store.read("control").collect()}


def _indexed_by_file(store: TableStore, version: int) -> DataFrame:
    return store.staged(version, "staff_index").groupBy("file_id").agg(F.count_distinct("uri").alias("indexed_count"))


# --- The daily run


def daily_pages(
    store: TableStore, changes: DataFrame, folders: DataFrame, measure: Callable[[DataFrame], DataFrame], bucket: str,
    opts: SyncOptions, now: Column, closure: DataFrame | None = None,
) -> DataFrame:
    """Take the feed page by page, a page of each drive at a time; the reports of all pages.

    A drive's page is committed with its token if its gate passes. A drive that is refused keeps its token
    and rests until the next run; the others go on.
    """
    drives = [r.drive_id for r in changes.select("drive_id").distinct().collect()]
    resting: set[str] = set()
    reports = []
    for page_no in range(1, opts.max_pages + 1):
        version, known = store.version(), cursors(store)
        open_drives = [d for d in drives if d not in resting]
        if not open_drives:
            break
        tokens = store.spark.createDataFrame(
            [(d, int(known.get(_TOKEN + d, -1))) for d in open_drives], "drive_id string, token long"
        )
        feed = changes.filter(F.col("drive_id").isin(open_drives))
        ends = cut_lineage(readers.page_tokens(feed, opts.max_changes, tokens))
        page = cut_lineage(readers.change_page(feed, opts.max_changes, tokens).drop("page_row"))
        files = page.select("file_id").distinct()
        tables = store.read_all(FILE_TABLES, files, version)
        planned = sync.plan_changes(page, tables["state"], folders, measure(page), opts, closure)
        after = sync.apply_changes(planned, tables, bucket, now, opts)
        store.stage(version + 1, after, files)
        indexed = sync.indexed_counts(planned, store.staged(version + 1, "staff_index"), bucket)
        report = cut_lineage(sync.run_report(planned, indexed, ends, opts, page_no))
        reports.append(report)
        verdicts = report.select("drive_id", "commit", "next_page").collect()  # a row for each drive
        refused = {r.drive_id for r in verdicts if not r.commit}
        moved = {r.drive_id: str(r.token) for r in ends.select("drive_id", "token").collect() if r.drive_id not in refused}
        if refused:
            good = cut_lineage(planned.filter(~F.col("drive_id").isin(list(refused))))
            files = good.select("file_id")
            tables = {name: _among(rows, files, store, name) for name, rows in tables.items()}
            after = sync.apply_changes(good, tables, bucket, now, opts)
        control = _control(store, {_TOKEN + d: token for d, token in moved.items()})
        store.stage(version + 1, after | {"control": control}, files, control=control)
        store.publish(version + 1)
        # A page that is over, or refused, ends the drive's run; one without rows has no verdict.
        resting |= refused | {r.drive_id for r in ends.select("drive_id", "has_more").collect() if not r.has_more}
    if not reports:
        return store.spark.createDataFrame([], "drive_id string, page int, commit boolean")
    return reduce(DataFrame.unionByName, reports)


def _among(rows: DataFrame, files: DataFrame, store: TableStore, name: str) -> DataFrame:
    keyed = rows.withColumn("__owner", store.owners[name]() if name in store.owners else F.col("file_id"))
    return sizes.rows_of(keyed, files.withColumnRenamed("file_id", "__owner"), "__owner").drop("__owner")


# --- Retries


def retry_failed(
    store: TableStore, lookup: DataFrame, folders: DataFrame, measure: Callable[[DataFrame], DataFrame], bucket: str,
    opts: SyncOptions, now: Column, limit: int | None = None, closure: DataFrame | None = None,
) -> DataFrame:
    """Plan failed files anew, index those that are ready, and clear them from the queue; one row of totals.

    ``lookup`` is what the drive says of a file now: file_id, and where known seq, parent_id, size_bytes. The attempts of a
    page, of all failed files without a limit, are published before they are made, with the cursor.
    """
    version, known = store.version(), cursors(store)
    failed = store.read("state").filter(F.col("status") == "FAILED")
    page = cut_lineage(recover.round_robin_page(failed, limit, known.get(RETRY)) if limit else failed)
    queue = cut_lineage(store.read("retry_queue", page, version))
    candidates = cut_lineage(recover.retry_candidates(page, queue, opts.max_attempts))
    tried = candidates.filter(~F.col("exhausted")).select("file_id")
    if limit:
        cursor = recover.page_cursor(page, known.get(RETRY)).first()[0]
        control = _control(store, {RETRY: cursor})
        store.stage(version + 1, {
            "retry_queue": sizes.rows_of(merge.record_attempts(queue, tried, now), tried), "control": control,
        }, tried, control=control)
    else:
        store.stage(version + 1, {"retry_queue": sizes.rows_of(merge.record_attempts(queue, tried, now), tried)}, tried)
    store.publish(version + 1)
    version += 1
    told = [c for c in ("seq", "parent_id", "parents", "size_bytes") if c in lookup.columns]
    changes = candidates.filter(~F.col("exhausted")).select(
        "file_id", "drive_id", "name", "mime_type", "modified_time", F.lit(False).alias("removed"),
        F.col("link").alias("web_view_link"),
    ).join(lookup.select("file_id", *told), "file_id", "left")
    for name, kind in (("seq", "long"), ("size_bytes", "long"), *([] if "parents" in told else [("parent_id", "string")])):
        if name not in told:
            changes = changes.withColumn(name, F.lit(None).cast(kind))
    changes = cut_lineage(changes)
    tables = store.read_all(FILE_TABLES, tried, version)
    planned = sync.plan_changes(changes, tables["state"], folders, measure(changes), opts, closure)
    after = sync.apply_changes(planned, tables, bucket, now, opts)
    store.stage(version + 1, after, tried)
    results = sync.outcomes(planned).drop("drive_id").join(_indexed_by_file(store, version + 1), "file_id", "left")
    outcomes = cut_lineage(recover.retry_outcomes(candidates, results))
    recovered = outcomes.filter(F.col("outcome") == "recovered")
    waiting = cut_lineage(merge.clear(store.staged(version + 1, "retry_queue"), recovered))
    store.stage(version + 1, after | {"retry_queue": waiting}, tried)
    store.publish(version + 1)
    return recover.retry_totals(outcomes)


# --- Reindexing


def reindex_pending(
    store: TableStore, bucket: str, opts: SyncOptions, now: Column, limit: int | None = None, force: bool = False,
    imported: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Index all objects of parsed files again, with ``force`` of indexed ones too; one row of totals.

    ``imported`` tells which of the sent (file_id, uri) the index took; all where it is not given. A file
    is INDEXED once all its objects are; else it stays, or becomes, PARSED. One without objects is queued.
    """
    version, known = store.version(), cursors(store)
    state = store.read("state")
    statuses = ("PARSED", "INDEXED") if force else ("PARSED",)
    places = {s: known[REINDEX + s] for s in statuses if REINDEX + s in known}
    page = state.filter(F.col("status").isin(*statuses))
    if limit:
        page = recover.reindex_page(state, limit, force, places)
    page = cut_lineage(page)
    sources = cut_lineage(recover.reindex_sources(page, store.read("objects", page, version), bucket))
    sent = sources.select("file_id", F.explode("uris").alias("uri"))
    taken = cut_lineage(imported(sent) if imported else sent)
    counts = taken.groupBy("file_id").agg(F.count(F.lit(1)).alias("indexed_count"))
    met = sources.join(counts, "file_id", "left").withColumn("indexed_count", F.coalesce("indexed_count", F.lit(0)))
    met = cut_lineage(met.drop("uris"))
    whole = met.filter((F.col("uri_count") > 0) & (F.col("indexed_count") == F.col("uri_count")))
    part = met.filter((F.col("uri_count") > 0) & (F.col("indexed_count") < F.col("uri_count")))
    lost = met.filter(F.col("uri_count") == 0)
    tables = store.read_all(FILE_TABLES, page, version)
    merged, _ = merge.mark_indexed(tables["state"], [], whole, now)
    again = part.select("file_id", F.lit("PARSED").alias("status"), now.alias("last_synced_at"))
    merged = merge.merge_rows(merged, merge.writes(again, *merge.INDEXED_FIELDS))
    queue = merge.enqueue(merge.clear(tables["retry_queue"], whole), lost.select(
        "file_id", "drive_id", "name", "mime_type", "modified_time", "source_uri", "reason"
    ), now)
    kept = sizes.rows_of(tables["staff_index"], lost)
    students = page.filter(F.col("audience") == "STUDENT")
    after = {
        "state": merged, "retry_queue": queue, "staff_index": kept.unionByName(taken.select("file_id", "uri")),
        "student_index": sizes.rows_of(tables["student_index"], lost).unionByName(sizes.rows_of(taken, students).select("file_id", "uri")),
    }
    moved = {
        REINDEX + s: recover.page_cursor(page.filter(F.col("status") == s), places.get(s)).first()[0] for s in statuses
    } if limit else {}
    control = _control(store, moved)
    store.stage(version + 1, after | ({"control": control} if limit else {}), page, control=control)
    store.publish(version + 1)
    return recover.reindex_totals(sources, met.select("file_id", "indexed_count"))
