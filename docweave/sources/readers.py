"""Readers of the change feed, the state table, objects, documents and golden sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docweave import schemas
from docweave.functions import ids, values
from docweave.functions.text import blank_to_null, is_blank

FOLDER_MIME = "application/vnd.google-apps.folder"
DOCUMENT_GLOBS = ("*.md", "*.hwp", "*.hwpx", "*.xlsx")


def map_wire_changes(raw: DataFrame) -> DataFrame:
    """Feed records to change rows: a trashed file counts as removed, sizes are parsed."""
    meta = F.col("file")
    return raw.select(
        "seq",
        F.coalesce(blank_to_null(F.col("fileId")), blank_to_null(meta["id"]), F.lit("")).alias("file_id"),
        F.coalesce(blank_to_null(meta["driveId"]), F.col("driveId")).alias("drive_id"),
        F.coalesce(meta["name"], F.lit("")).alias("name"),
        F.coalesce(meta["mimeType"], F.lit("")).alias("mime_type"),
        meta["modifiedTime"].alias("modified_time"),
        (F.coalesce("removed", F.lit(False)) | F.coalesce(meta["trashed"], F.lit(False))).alias("removed"),
        F.coalesce(meta["trashed"], F.lit(False)).alias("trashed"),
        meta["webViewLink"].alias("web_view_link"),
        meta["md5Checksum"].alias("md5_checksum"),
        ids.drive_size(meta["size"]).alias("size_bytes"),
        F.coalesce(meta["parents"], F.array().cast("array<string>")).alias("parents"),
    )


def has_file_id(changes: DataFrame) -> DataFrame:
    return changes.filter(~is_blank(F.col("file_id")))


def change_page(changes: DataFrame, max_changes: int, tokens: DataFrame | None = None) -> DataFrame:
    """The next ``max_changes`` rows of each drive's feed, after its token.

    Rows without a file id are passed over and do not count. The rank window keeps at most
    ``max_changes`` rows of a drive in any task.
    """
    feed = has_file_id(_after_token(changes, tokens))
    order = Window.partitionBy("drive_id").orderBy("seq")
    return feed.withColumn("page_row", F.row_number().over(order)).filter(F.col("page_row") <= max_changes)


def _after_token(changes: DataFrame, tokens: DataFrame | None) -> DataFrame:
    if tokens is None:
        return changes
    token = tokens.select("drive_id", F.col("token").alias("__token"))
    return (
        changes.join(token, "drive_id", "left")
        .filter(F.coalesce(F.col("seq") > F.col("__token"), F.lit(True)))
        .drop("__token")
    )


def page_tokens(changes: DataFrame, max_changes: int, tokens: DataFrame | None = None) -> DataFrame:
    """For each drive: rows kept on the page, the token to resume from and whether more follow.

    A full page resumes at its last kept row, and rows after it (also ones without an id) mean
    more; a page that is not full has read the feed to its end.
    """
    raw = _after_token(changes, tokens)
    page = change_page(changes, max_changes, tokens).groupBy("drive_id").agg(
        F.count(F.lit(1)).alias("kept"), F.max("seq").alias("last_kept")
    )
    end = raw.groupBy("drive_id").agg(F.max("seq").alias("last_raw"))
    kept = F.coalesce("kept", F.lit(0))
    full = kept >= max_changes
    out = end.join(page, "drive_id", "left").select(
        "drive_id",
        kept.alias("kept"),
        F.when(full, F.col("last_kept")).otherwise(F.col("last_raw")).alias("token"),
        (full & (F.col("last_raw") > F.col("last_kept"))).alias("has_more"),
    )
    if tokens is None:
        return out
    # A drive without changes keeps its token.
    unchanged = tokens.join(out, "drive_id", "left_anti").select(
        "drive_id", F.lit(0).cast("bigint").alias("kept"), "token", F.lit(False).alias("has_more")
    )
    return out.unionByName(unchanged)


def baseline_tokens(changes: DataFrame, tokens: DataFrame, baseline_only: bool) -> DataFrame:
    """Existing tokens; a drive without one gets the end of its feed only on explicit request."""
    existing = tokens.select("drive_id", "token", F.lit("exists").alias("token_status"))
    missing = (
        changes.groupBy("drive_id").agg(F.max("seq").alias("token"))
        .join(tokens.select("drive_id"), "drive_id", "left_anti")
    )
    created = missing.select("drive_id", "token", F.lit("created_baseline_only").alias("token_status"))
    refused = missing.select(
        "drive_id", F.lit(None).cast("bigint").alias("token"), F.lit("backfill_required").alias("token_status")
    )
    return existing.unionByName(created if baseline_only else refused)


def snapshot(files: DataFrame) -> DataFrame:
    """All files in place: not trashed and not folders."""
    return files.filter(~F.col("trashed") & (F.coalesce("mime_type", F.lit("")) != FOLDER_MIME))


def read_state(wire: DataFrame) -> DataFrame:
    """State rows with either spelling of a field, defaults filled and unknown values replaced."""

    def either(camel: str, snake: str, default: str | None = None):
        value = F.coalesce(blank_to_null(F.col(camel)), blank_to_null(F.col(snake)))
        return (F.coalesce(value, F.lit(default)) if default is not None else value).alias(snake)

    return wire.select(
        either("fileId", "file_id", ""),
        either("driveId", "drive_id", ""),
        F.coalesce("name", F.lit("")).alias("name"),
        either("mimeType", "mime_type", ""),
        either("modifiedTime", "modified_time"),
        either("contentHash", "content_hash"),
        values.status(F.col("status")).alias("status"),
        values.parse_route(F.col("parseRoute")).alias("parse_route"),
        F.coalesce("lastSyncedAt", "last_synced_at").alias("last_synced_at"),
        "error",
        either("sourceUri", "source_uri"),
        either("ragFileId", "rag_file_id"),
        "path",
        "bundle",
        values.audience(F.col("audience")).alias("audience"),
    )


def scan_documents(spark: SparkSession, root: str, globs: tuple[str, ...] = DOCUMENT_GLOBS) -> DataFrame:
    """Files under a folder tree with their bytes; sizes can be filtered before bytes are read."""
    pattern = "{" + ",".join(g.removeprefix("*.") for g in globs) + "}"
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*.{pattern}")
        .load(root)
    )


def list_objects(objects: DataFrame, bucket: str, prefix: str = "") -> DataFrame:
    rows = objects.filter(F.col("bucket") == bucket)
    return rows.filter(F.col("name").startswith(prefix)) if prefix else rows


def objects_of_files(objects: DataFrame, files: DataFrame) -> DataFrame:
    """Objects of the given ids: the id itself or the id and a dot. An equi-join on the part
    before the first dot replaces one prefix listing per file."""
    owned = objects.withColumn("file_id", ids.object_owner(F.col("name")))
    return owned.join(files.select("file_id").distinct(), "file_id", "left_semi")


def read_golden(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.GOLDEN).option("multiLine", True).json(path)
