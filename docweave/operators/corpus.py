"""Index membership, objects and deletions as joins on the file id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions import ids, paths
from docweave.functions.text import blank_to_null
from docweave.operators import merge, sizes
from docweave.operators.routing import (
    EXPORTS, OUT_OF_SCOPE, SHEET_MIMES, SIDECAR_ONLY_MIMES, TEXT_MIMES, _lookup, _lower, source_suffix,
)
from docweave.operators.postprocess import CLEANUP_FAILED


def replace_files(index: DataFrame, batch: DataFrame) -> DataFrame:
    """Index after a batch: its files' old rows go, exactly those, and its rows come in."""
    return delete_files(index, batch).unionByName(batch)


def delete_files(index: DataFrame, files: DataFrame) -> DataFrame:
    return sizes.rows_without(index, files)


def batch_mismatch(deleted: DataFrame, imported: DataFrame) -> DataFrame:
    """Ids on one side only; empty when a batch deletes exactly what it imports."""
    left, right = deleted.select("file_id").distinct(), imported.select("file_id").distinct()
    return (
        left.join(right, "file_id", "left_anti").withColumn("side", F.lit("deleted only"))
        .unionByName(right.join(left, "file_id", "left_anti").withColumn("side", F.lit("imported only")))
    )


def touched_ids(uris: DataFrame, given: DataFrame) -> DataFrame:
    """Ids given with a batch and ids its URIs lead back to, each once."""
    from_uris = uris.select(ids.extract_file_id(F.col("uri")).alias("file_id")).filter(
        ids.is_clean_file_id(F.col("file_id"))
    )
    stated = given.select("file_id").filter(blank_to_null(F.col("file_id")).isNotNull())
    return stated.unionByName(from_uris).distinct()


def student_imports(uris: DataFrame, state: DataFrame) -> DataFrame:
    """URIs whose file is open to students. A URI that leads to no file id is left out."""
    owned = uris.withColumn("file_id", ids.extract_file_id(F.col("uri"))).filter(
        ids.is_clean_file_id(F.col("file_id"))
    )
    students = state.filter(F.col("audience") == "STUDENT").select("file_id")
    return owned.join(students, "file_id", "left_semi")


def sync_audience(student_index: DataFrame, uris: DataFrame, given: DataFrame, state: DataFrame) -> DataFrame:
    """Student index (file_id, uri) after a batch: all touched files go, open ones come back."""
    kept = delete_files(student_index, touched_ids(uris, given))
    return kept.unionByName(student_imports(uris, state).select(*student_index.columns))


def audience_moves(student_index: DataFrame, state: DataFrame) -> DataFrame:
    """Files whose audience and membership differ: to add to the student index or to remove."""
    inside = student_index.select("file_id").distinct()
    open_ = state.filter((F.col("audience") == "STUDENT") & (F.col("status") == "INDEXED")).select("file_id")
    closed = state.filter(F.col("audience") != "STUDENT").select("file_id")
    return (
        open_.join(inside, "file_id", "left_anti").withColumn("move", F.lit("add"))
        .unionByName(closed.join(inside, "file_id", "left_semi").withColumn("move", F.lit("remove")))
    )


def outside_staff(student_index: DataFrame, staff_index: DataFrame) -> DataFrame:
    """Files of the student index that the staff index lacks; must be empty."""
    return student_index.select("file_id").distinct().join(
        staff_index.select("file_id").distinct(), "file_id", "left_anti"
    )


def delete_counts(
    files: DataFrame, staff_index: DataFrame, student_index: DataFrame, objects: DataFrame,
    source_bucket: str, original_bucket: str,
) -> DataFrame:
    """For each file, what a delete everywhere removes from each target.

    Every target is counted by file before it is joined, so a file with very many objects
    brings one row.
    """
    wanted = files.select("file_id").distinct()

    def counted(rows: DataFrame, name: str) -> DataFrame:
        met = rows.join(wanted, "file_id", "left_semi")
        return met.groupBy("file_id").agg(F.count(F.lit(1)).alias(name))

    owned = objects.withColumn("file_id", ids.object_owner(F.col("name")))
    parts = [
        counted(staff_index, "staff"), counted(student_index, "student"),
        counted(owned.filter(F.col("bucket") == source_bucket), "source_deleted"),
        counted(owned.filter(F.col("bucket") == original_bucket), "original_deleted"),
    ]
    out = wanted
    for part in parts:
        out = out.join(part, "file_id", "left")
    zero = F.lit(0)
    return out.select(
        "file_id",
        ((F.coalesce("staff", zero) + F.coalesce("student", zero)) > 0).alias("deleted"),
        F.coalesce("source_deleted", zero).alias("source_deleted"),
        F.coalesce("original_deleted", zero).alias("original_deleted"),
        (F.coalesce("source_deleted", zero) + F.coalesce("original_deleted", zero)).alias("objects_deleted"),
    )


def delete_objects(objects: DataFrame, files: DataFrame) -> DataFrame:
    """Objects left after all objects of the given files are gone, in any bucket."""
    owned = objects.withColumn("file_id", ids.object_owner(F.col("name")))
    return sizes.rows_without(owned, files).select(*objects.columns)


def delete_everywhere(
    files: DataFrame, staff_index: DataFrame, student_index: DataFrame, objects: DataFrame,
    state: DataFrame, now: Column,
) -> dict[str, DataFrame]:
    """All targets after a delete, the state rows marked DELETED."""
    wanted = files.select("file_id").distinct()
    return {
        "staff_index": delete_files(staff_index, wanted),
        "student_index": delete_files(student_index, wanted),
        "objects": delete_objects(objects, wanted),
        "state": merge.merge_rows(state, merge.deleted_rows(wanted, now)),
    }


def evicted_rows(changes: DataFrame, now: Column) -> DataFrame:
    """State updates of files cleaned up as out of scope, or of failed clean-ups.

    ``changes`` has the change fields, cleanup_skipped and cleanup_error (NULL on success).
    """
    failed = F.col("cleanup_error").isNotNull()
    reason = F.concat(F.lit(f"{CLEANUP_FAILED}: "), F.col("cleanup_error"))
    return changes.filter(~F.col("cleanup_skipped")).select(
        "file_id", "drive_id", "name", "mime_type", "modified_time",
        F.when(failed, "FAILED").otherwise("EXCLUDED").alias("status"),
        F.lit("NONE").alias("parse_route"),
        F.col("web_view_link").alias("source_uri"),
        F.when(failed, reason).otherwise(OUT_OF_SCOPE).alias("error"),
        now.alias("last_synced_at"),
        F.lit("STAFF").alias("audience"),
        F.when(failed, F.array(*[F.lit(f) for f in (
            "drive_id", "name", "mime_type", "modified_time", "status", "source_uri", "error", "last_synced_at",
        )])).alias(merge.FIELDS),
    )


def drop_stale_sidecars(objects: DataFrame, source_bucket: str) -> DataFrame:
    """Objects without the side files of files that now have a body of their own."""
    rows = objects.withColumn("file_id", ids.object_owner(F.col("name")))
    bodies = rows.filter(
        (F.col("bucket") == source_bucket) & (F.col("name") == F.concat("file_id", F.lit(".md")))
    ).select("file_id", F.lit(True).alias("__body")).distinct()
    side = (F.col("bucket") == source_bucket) & (F.col("name") == F.concat("file_id", F.lit(ids.SIDECAR_SUFFIX)))
    return (
        rows.join(bodies, "file_id", "left")
        .filter(~(side & F.coalesce("__body", F.lit(False))))
        .select(*objects.columns)
    )


def source_objects(ready: DataFrame) -> DataFrame:
    """Objects written for each file that is ready: (file_id, uri_no from 1, object_name, kind).

    Texts, readable sheets and parsed documents give one body; other originals give themselves
    and a side file, split ones their parts and a side file; the rest only a side file.
    ``ready`` has route, mime_type, name, parts and sheet_error.
    """
    low = _lower(F.col("mime_type"))
    route = F.col("route")
    suffix = F.when(
        route == "GOOGLE_EXPORT", _lookup({m: ext for m, (_, ext) in EXPORTS.items()}, low)
    ).otherwise(source_suffix(F.col("mime_type"), F.col("name"), F.col("file_id")))
    file_id = F.col("file_id")

    def item(name: Column, kind: str) -> Column:
        return F.struct(name.alias("object_name"), F.lit(kind).alias("kind"))

    body = F.array(item(F.concat(file_id, F.lit(".md")), "body"))
    side = F.array(item(F.concat(file_id, F.lit(ids.SIDECAR_SUFFIX)), "sidecar"))
    original = F.array(item(F.concat(file_id, suffix), "original"))
    parts = F.transform(
        F.sequence(F.lit(1), F.greatest(F.coalesce("parts", F.lit(0)), F.lit(1))),
        lambda i: item(F.concat(file_id, F.lit(".part"), i.cast("string"), suffix), "part"),
    )
    sheet = low.isin(*SHEET_MIMES)
    copy = route == "FILE_COPY"
    made = (
        F.when(route == "HWP_PARSE", body)
        .when(copy & low.isin(*SIDECAR_ONLY_MIMES), side)
        .when(copy & (low.isin(*TEXT_MIMES) | (sheet & F.col("sheet_error").isNull())), body)
        .when(copy & sheet, side)
        .when(copy & (F.coalesce("parts", F.lit(0)) > 1), F.concat(parts, side))
        .otherwise(F.concat(original, side))
    )
    return ready.select("file_id", F.posexplode(made).alias("__pos", "__item")).select(
        "file_id", (F.col("__pos") + 1).alias("uri_no"), "__item.*"
    )


def parsed_state_rows(ready: DataFrame, bucket: str, now: Column) -> DataFrame:
    """State rows of files that are ready: PARSED, linked, with path, bundle, audience and note."""
    first = source_objects(ready).filter(F.col("uri_no") == 1).select(
        "file_id", ids.gs_uri(F.lit(bucket), F.col("object_name")).alias("__first")
    )
    route, low = F.col("route"), _lower(F.col("mime_type"))
    hwpx = F.contains(low, F.lit("hwpx")) | F.lower("name").endswith(".hwpx")
    parse_route = (
        F.when(route == "HWP_PARSE", F.when(hwpx, "HWPX").otherwise("RHWP"))
        .when(route == "GOOGLE_EXPORT", "GCS_EXPORT")
        .otherwise("GCS_COPY")
    )
    note = F.when(
        low.isin(*SIDECAR_ONLY_MIMES), F.concat(F.lit("NO_BODY_EXTRACTOR:"), "mime_type")
    ).otherwise(F.concat(F.lit("XLSX_UNREADABLE:"), "sheet_error"))
    return ready.join(first, "file_id", "left").select(
        "file_id", "drive_id", "name", "mime_type", "modified_time", "content_hash",
        F.lit("PARSED").alias("status"), parse_route.alias("parse_route"), now.alias("last_synced_at"),
        note.alias("error"),
        F.coalesce(blank_to_null(F.col("web_view_link")), F.col("__first")).alias("source_uri"),
        F.lit(None).cast("string").alias("rag_file_id"),
        "path", "bundle", "audience",
    )


def indexed_texts(ready: DataFrame) -> DataFrame:
    """Heading and body, or side text, of each ready file."""
    return ready.withColumn(
        "markdown",
        paths.breadcrumb_markdown(
            F.col("path"), F.col("bundle"), F.coalesce(blank_to_null(F.col("name")), F.col("file_id")), F.col("body")
        ),
    )
