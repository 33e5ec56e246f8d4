"""Routes, size limits and the disposition of a change, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions import ids
from docweave.functions.text import blank_to_null, is_blank, strip
from docweave.options import MB, SyncOptions

# Media types by the way they are taken in.
HWP_MIMES = (
    "application/x-hwp", "application/haansofthwp", "application/vnd.hancom.hwp", "application/hwp",
    "application/x-hwp+zip", "application/hwp+zip", "application/haansofthwpx",
    "application/vnd.hancom.hwpx", "application/hwpx",
)
DOCX = "application/vnd.openxmlformats-officedocument.wordprocessingml.document"
PPTX = "application/vnd.openxmlformats-officedocument.presentationml.presentation"
XLSX = "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet"
XLSM = "application/vnd.ms-excel.sheet.macroenabled.12"
EXPORTS = {
    "application/vnd.google-apps.document": (DOCX, ".docx"),
    "application/vnd.google-apps.presentation": (PPTX, ".pptx"),
    "application/vnd.google-apps.spreadsheet": (XLSX, ".xlsx"),
}
SIDECAR_ONLY_MIMES = ("application/zip", "application/x-zip-compressed", "application/vnd.ms-excel")
TEXT_MIMES = ("text/plain", "text/markdown", "text/html", "text/csv")
SHEET_MIMES = (XLSX, XLSM)
COPY_MIMES = (
    "application/pdf", DOCX, "application/msword", *TEXT_MIMES, PPTX, XLSX, XLSM, "application/rtf",
    *SIDECAR_ONLY_MIMES,
)
MIME_SUFFIXES = {
    "application/pdf": ".pdf", "text/plain": ".txt", "text/markdown": ".md", "text/html": ".html",
    "text/csv": ".csv", "application/rtf": ".rtf", "application/msword": ".doc", DOCX: ".docx",
    PPTX: ".pptx", XLSX: ".xlsx",
}
LIMITS = {".pdf": 50 * MB, ".docx": 50 * MB}
DEFAULT_LIMIT = 10 * MB
OUT_OF_SCOPE = "out_of_folder_scope"


def _lower(col: Column) -> Column:
    return F.lower(F.coalesce(col, F.lit("")))


def _lookup(table: dict[str, str], key: Column) -> Column:
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.create_map(*entries)[key]


def classify_route(mime: Column, name: Column, removed: Column) -> Column:
    low, low_name = _lower(mime), _lower(name)
    hwp = strip(low).isin(*HWP_MIMES) | low_name.endswith(".hwp") | low_name.endswith(".hwpx")
    return (
        F.when(F.coalesce(removed, F.lit(False)), "DELETE")
        .when(hwp, "HWP_PARSE")
        .when(low.isin(*EXPORTS), "GOOGLE_EXPORT")
        .when(low.isin(*COPY_MIMES), "FILE_COPY")
        .otherwise("SKIP")
    )


def is_hwpx(mime: Column, name: Column) -> Column:
    low = _lower(mime)
    marked = F.contains(low, F.lit("hwpx")) | F.contains(low, F.lit("hwp+zip"))
    return marked | _lower(name).endswith(".hwpx")


def parse_engine(file_name: Column) -> Column:
    """Engine of a document file, chosen by its name alone."""
    return F.when(_lower(file_name).endswith(".hwpx"), "python-hwpx").otherwise("rhwp")


def source_suffix(mime: Column, name: Column, file_id: Column) -> Column:
    """Suffix of the name, else the one of the media type, else ``.bin``."""
    shown = F.coalesce(blank_to_null(name), file_id)
    return F.coalesce(
        blank_to_null(ids.file_suffix(shown)), _lookup(MIME_SUFFIXES, _lower(mime)), F.lit(".bin")
    )


def type_limit(suffix: Column) -> Column:
    limits = F.lit(DEFAULT_LIMIT)
    for ext, limit in LIMITS.items():
        limits = F.when(_lower(suffix) == ext, limit).otherwise(limits)
    return limits.cast("bigint")


def effective_limit(suffix: Column, cap: int) -> Column:
    return F.least(F.lit(cap).cast("bigint"), type_limit(suffix))


def size_reason(size: Column, limit: Column, suffix: Column) -> Column:
    """Reason of a size over its limit, else NULL; an unknown size passes."""
    text = F.concat(
        F.lit("SIZE_EXCEEDED:"), size.cast("string"), F.lit(">"), limit.cast("string"),
        F.lit("("), suffix, F.lit(")"),
    )
    return F.when(size > limit, text)


def parked_status(splittable: bool = True) -> str:
    return "SPLIT_QUEUED" if splittable else "DLQ"


def size_gates(
    route: Column, mime: Column, name: Column, file_id: Column, listed: Column, raw: Column,
    markdown: Column, parts: Column, cap: int,
) -> dict[str, Column]:
    """Reasons of the three size checks, each on what it is meant to measure.

    ``before`` looks at the listed size before anything is read, ``original`` at the bytes read,
    ``product`` at what will be indexed. A split PDF and a side-file-only type are not measured.
    """
    low = _lower(mime)
    suffix = source_suffix(mime, name, file_id)
    copy = (route == "FILE_COPY") & ~low.isin(*SIDECAR_ONLY_MIMES)
    hwp, export = route == "HWP_PARSE", route == "GOOGLE_EXPORT"
    hwp_suffix = F.when(is_hwpx(mime, name), ".hwpx").otherwise(".hwp")
    export_suffix = _lookup({m: ext for m, (_, ext) in EXPORTS.items()}, low)
    sheet, text = low.isin(*SHEET_MIMES), low.isin(*TEXT_MIMES)
    split = F.coalesce(parts, F.lit(0)) > 0
    capped = F.lit(cap).cast("bigint")
    by_cap = sheet | (F.lower(suffix) == ".pdf")
    upload = F.when(text, F.lit(".md")).otherwise(suffix)
    md = F.lit(".md")
    before = (
        F.when(hwp, size_reason(listed, capped, hwp_suffix))
        .when(copy & by_cap, size_reason(listed, capped, suffix))
        .when(copy, size_reason(listed, effective_limit(upload, cap), upload))
    )
    original = (
        F.when(export, size_reason(raw, effective_limit(export_suffix, cap), export_suffix))
        .when(copy & ~split & sheet, size_reason(raw, capped, suffix))
        .when(copy & ~split, size_reason(raw, effective_limit(suffix, cap), suffix))
    )
    has_body = hwp | (copy & (text | (sheet & markdown.isNotNull())))
    product = F.when(has_body, size_reason(markdown, effective_limit(md, cap), md)).when(
        copy & ~split, size_reason(raw, effective_limit(suffix, cap), suffix)
    )
    return {"before": before, "original": original, "product": product}


def should_reparse(change_time: Column, known: Column, stored_time: Column, status: Column) -> Column:
    """True unless a stored time at least as new shows that the change is not one."""
    return (
        blank_to_null(change_time).isNull()
        | ~known
        | blank_to_null(stored_time).isNull()
        | F.coalesce(status.isin("FAILED", "PENDING"), F.lit(False))
        | F.coalesce(change_time > stored_time, F.lit(False))
    )


def is_unchanged(reparse: Column, path: Column, status: Column) -> Column:
    """Not newer, with a path and indexed; a document that is only parsed is taken again."""
    return ~reparse & ~is_blank(path) & F.coalesce(status == "INDEXED", F.lit(False))


def hash_unchanged(stored_hash: Column, new_hash: Column, status: Column) -> Column:
    return F.coalesce((stored_hash == new_hash) & (status == "INDEXED"), F.lit(False))


def already_evicted(status: Column, error: Column) -> Column:
    return F.coalesce(
        status.isin("EXCLUDED", "SKIPPED") & (F.coalesce(error, F.lit("")) == OUT_OF_SCOPE), F.lit(False)
    )


def apply_scope(routed: DataFrame) -> DataFrame:
    """Out-of-scope changes become EXCLUDE with a reason; removals keep their route."""
    outside = (F.col("scope") == "OUT") & (F.col("route") != "DELETE")
    return routed.withColumn("skip_reason", F.when(outside, OUT_OF_SCOPE)).withColumn(
        "route", F.when(outside, "EXCLUDE").otherwise(F.col("route"))
    )


def route_changes(changes: DataFrame, scope: DataFrame) -> DataFrame:
    """Changes with route and skip_reason, by type first and folder scope second."""
    kind = classify_route(F.col("mime_type"), F.col("name"), F.col("removed"))
    joined = changes.withColumn("route", kind).join(scope.select("file_id", "scope"), "file_id", "left")
    return apply_scope(joined)


def snapshot_rows(routed: DataFrame) -> DataFrame:
    """Rows of a full load: excluded and unsupported files are left out."""
    return routed.filter(~F.col("route").isin("EXCLUDE", "SKIP"))


def snapshot_counts(routed: DataFrame) -> DataFrame:
    return routed.agg(
        F.count_if(~F.col("route").isin("EXCLUDE", "SKIP")).alias("listed"),
        F.count_if(F.col("skip_reason") == OUT_OF_SCOPE).alias("excluded"),
    )


def latest_changes(changes: DataFrame) -> DataFrame:
    """The last change of each file. Partial maxima are taken before the shuffle, so a file with
    very many changes sends one row from each task."""
    fields = [c for c in changes.columns if c != "file_id"]
    last = changes.groupBy("file_id").agg(F.max_by(F.struct(*fields), "seq").alias("__last"))
    return last.select("file_id", "__last.*")


def dispose(planned: DataFrame, opts: SyncOptions) -> DataFrame:
    """Add ``disposition``, ``reason`` and ``cleanup_skipped``, the outcome of every change.

    Expects a change with route and scope, the state columns with a ``state_`` prefix and
    has_state, and the measures raw_bytes, md_bytes, parts, content_hash, rejection; a measure
    is NULL where the route does not need it or nothing was read.
    """
    c = F.col
    route = c("route")
    gates = size_gates(
        route, c("mime_type"), c("name"), c("file_id"), c("size_bytes"), c("raw_bytes"),
        c("md_bytes"), c("parts"), opts.storage_cap_bytes,
    )
    reparse = should_reparse(c("modified_time"), c("has_state"), c("state_modified_time"), c("state_status"))
    # Flags first, each once, so that the decision below stays a short chain.
    flagged = planned.withColumns({
        "__before": gates["before"],
        "__after": F.coalesce(gates["original"], gates["product"]),
        "__unchanged": is_unchanged(reparse, c("state_path"), c("state_status")),
        "__same": hash_unchanged(c("state_content_hash"), c("content_hash"), c("state_status")),
        "__evicted": already_evicted(c("state_status"), c("state_error")),
        "__present": ~F.coalesce(c("removed"), F.lit(False)),
    })
    present = c("__present")
    disposition = (
        F.when(is_blank(c("file_id")), "REJECTED")
        .when(present & (c("scope") == "UNKNOWN"), "FAILED")
        .when(present & (route == "EXCLUDE"), "EXCLUDED")
        .when((route == "DELETE") | ~present, "DELETE_PENDING")
        .when(route == "SKIP", "SKIPPED")
        .when(c("__unchanged"), "UNCHANGED")
        .when(c("__before").isNotNull(), parked_status())
        .when(c("rejection").isNotNull() & (route == "HWP_PARSE"), "DLQ")
        .when(c("__after").isNotNull(), parked_status())
        .when(c("__same"), "HASH_UNCHANGED")
        .otherwise("GCS_READY")
    )
    decided = c("disposition")
    reason = (
        F.when(decided == "REJECTED", "fileId is required")
        .when(decided == "FAILED", "folder_scope_unknown")
        .when(decided == "EXCLUDED", OUT_OF_SCOPE)
        .when(decided == "DLQ", c("rejection"))
        .when(decided == parked_status(), F.coalesce("__before", "__after"))
    )
    return (
        flagged.withColumn("disposition", disposition)
        .withColumn("reason", reason)
        .withColumn("cleanup_skipped", (decided == "EXCLUDED") & c("__evicted"))
        .drop("__before", "__after", "__unchanged", "__same", "__evicted", "__present")
    )
