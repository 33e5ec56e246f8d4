"""Queries of ingest planning, state, indexes and recovery."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.functions import ids
from docweave import schemas
from docweave.operators import corpus, gates, merge, reconcile, recover, routing, scope
from docweave.options import GateOptions, SyncOptions
from docweave.plans import sync
from docweave.plans.catalog_text import file_id_sql
from docweave.plans.registry import query
from docweave.sources import readers
from docweave.sources.views import Tables, _padded

OPTS = SyncOptions(sync_roots=("R1", "R2"), student_roots=("N3", "N5"))
NOW = "2024-06-01 00:00:00"
BUCKET, ORIGINALS = "source", "original"


def now():
    return F.lit(NOW).cast("timestamp")


# --- Shared inputs -------------------------------------------------------------------

STATE = """
st AS (SELECT file_id, drive_id, name, '' AS mime_type, modified_time, 'h' || CAST(f % 5 AS VARCHAR) AS content_hash, status,
         'GCS_COPY' AS parse_route, error,
         CASE f % 4 WHEN 0 THEN 'https://drive/' || file_id WHEN 1 THEN 'gs://source/' || file_id WHEN 2 THEN ' http://x ' END AS source_uri,
         path, bundle, coalesce(audience, 'STAFF') AS audience
       FROM (SELECT *, CAST(right(file_id, 8) AS BIGINT) AS f FROM v_state) x)"""


def full_state(t: Tables) -> DataFrame:
    f = F.right("file_id", F.lit(8)).cast("bigint")
    none = F.lit(None)
    return t.v_state.select(
        "file_id", "drive_id", "name", F.lit("").alias("mime_type"), "modified_time",
        F.concat(F.lit("h"), (f % 5).cast("string")).alias("content_hash"), "status",
        F.lit("GCS_COPY").alias("parse_route"), none.cast("timestamp").alias("last_synced_at"), "error",
        F.when(f % 4 == 0, F.concat(F.lit("https://drive/"), "file_id"))
        .when(f % 4 == 1, F.concat(F.lit("gs://source/"), "file_id"))
        .when(f % 4 == 2, F.lit(" http://x ")).alias("source_uri"),
        none.cast("string").alias("rag_file_id"), "path", "bundle",
        F.coalesce("audience", F.lit("STAFF")).alias("audience"),
    )


OBJECTS = """
objs AS (SELECT DISTINCT 'source' AS bucket, display_name AS name FROM v_chunks
         UNION ALL SELECT 'original', file_id || '.hwp' FROM v_state WHERE CAST(right(file_id, 8) AS BIGINT) % 4 = 1)"""


def objects(t: Tables) -> DataFrame:
    source = t.v_chunks.select(F.lit(BUCKET).alias("bucket"), F.col("display_name").alias("name")).distinct()
    hwp = t.v_state.filter(F.right("file_id", F.lit(8)).cast("bigint") % 4 == 1)
    originals = hwp.select(F.lit(ORIGINALS).alias("bucket"), F.concat("file_id", F.lit(".hwp")).alias("name"))
    return source.unionByName(originals)


INDEXES = f"""{OBJECTS},
staff AS (SELECT split_part(name, '.', 1) AS file_id, 'gs://source/' || name AS uri FROM objs WHERE bucket = 'source'),
student AS (SELECT s.* FROM staff s JOIN v_state v USING (file_id) WHERE v.audience = 'STUDENT' OR v.drive_id = 'drive_2')"""


def staff_index(t: Tables) -> DataFrame:
    rows = objects(t).filter(F.col("bucket") == BUCKET)
    return rows.select(ids.object_owner(F.col("name")).alias("file_id"), ids.gs_uri(F.col("bucket"), F.col("name")).alias("uri"))


def student_index(t: Tables) -> DataFrame:
    inside = t.v_state.filter((F.col("audience") == "STUDENT") | (F.col("drive_id") == "drive_2"))
    return staff_index(t).join(inside.select("file_id"), "file_id", "left_semi")


# Files named by the feed: the ids of its removals.
REMOVED = "removed AS (SELECT DISTINCT file_id FROM v_changes WHERE removed AND file_id <> '' AND seq % 3 = 0)"


def removed_files(t: Tables) -> DataFrame:
    gone = F.col("removed") & (F.col("file_id") != "") & (F.col("seq") % 3 == 0)
    return t.v_changes.filter(gone).select("file_id").distinct()


CHANGES = """
feed AS (SELECT seq, file_id, drive_id, parent_id, CASE WHEN seq % 6 = 5 THEN 'a.xlsx' ELSE 'name ' || CAST(seq AS VARCHAR) END AS name,
           CASE WHEN seq % 6 = 5 THEN 'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet' ELSE mime_type END AS mime_type,
           CASE WHEN seq % 4 = 0 THEN '2023-12-31 00:00:00' ELSE strftime(event_ts, '%Y-%m-%d %H:%M:%S') END AS modified_time, removed,
           CASE WHEN seq % 5 = 1 THEN 'https://drive/' || file_id END AS web_view_link, CAST(size AS BIGINT) AS size_bytes FROM v_changes)"""


def feed(t: Tables) -> DataFrame:
    seq = F.col("seq")
    sheet = seq % 6 == 5
    return t.v_changes.select(
        "seq", "file_id", "drive_id", "parent_id",
        F.when(sheet, "a.xlsx").otherwise(F.concat(F.lit("name "), seq.cast("string"))).alias("name"),
        F.when(sheet, routing.XLSX).otherwise(F.col("mime_type")).alias("mime_type"),
        F.when(seq % 4 == 0, "2023-12-31 00:00:00")
        .otherwise(F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss")).alias("modified_time"),
        "removed",
        F.when(seq % 5 == 1, F.concat(F.lit("https://drive/"), "file_id")).alias("web_view_link"),
        ids.drive_size(F.col("size")).alias("size_bytes"),
    )


SCOPES = """
folder_flags AS (
  SELECT 'C' || CAST(c_custkey AS VARCHAR) AS parent_id, n_regionkey IN (1, 2) AS in_sync, c_nationkey IN (3, 5) AS in_student,
         r_name || '/' || n_name || '/' || c_name AS folder_path, c_name AS folder_name
  FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey)"""
PLANNED = f"""{STATE}, {CHANGES}, {SCOPES},
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY seq DESC) AS nth FROM feed WHERE file_id <> '') x WHERE nth = 1),
measures AS (SELECT file_id, size_bytes * (seq % 3 + 1) AS raw_bytes, CASE WHEN seq % 2 = 0 THEN size_bytes // 2 END AS md_bytes,
    CASE WHEN mime_type = 'application/pdf' AND size_bytes * (seq % 3 + 1) > 52428800 AND seq % 9 <> 0 THEN 2 END AS parts,
    'h' || CAST(seq % 5 AS VARCHAR) AS content_hash, CASE WHEN seq % 7 = 0 THEN 'EMPTY_TEXT:' || CAST(seq AS VARCHAR) END AS rejection,
    CASE WHEN seq % 2 = 1 THEN 'locked' END AS sheet_error FROM latest),
routed AS (SELECT l.*, CASE WHEN f.parent_id IS NULL THEN 'UNKNOWN' WHEN f.in_sync THEN 'IN' ELSE 'OUT' END AS scope,
    CASE WHEN f.in_student THEN 'STUDENT' ELSE 'STAFF' END AS audience,
    coalesce(f.folder_path || '/', '') || l.name AS path, coalesce(f.folder_name, '') AS bundle,
    CASE WHEN l.removed THEN 'DELETE' WHEN l.mime_type = 'application/haansofthwp' THEN 'HWP_PARSE'
      WHEN l.mime_type = 'application/vnd.google-apps.spreadsheet' THEN 'GOOGLE_EXPORT'
      WHEN l.mime_type IN ('application/pdf', 'text/html', 'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet') THEN 'FILE_COPY'
      ELSE 'SKIP' END AS by_type
  FROM latest l LEFT JOIN folder_flags f USING (parent_id)),
scoped AS (SELECT *, CASE WHEN scope = 'OUT' AND by_type <> 'DELETE' THEN 'EXCLUDE' ELSE by_type END AS route FROM routed),
joined AS (SELECT s.*, m.raw_bytes, m.md_bytes, m.parts, m.content_hash AS new_hash, m.rejection, m.sheet_error, st.status, st.error AS st_error,
    st.modified_time AS st_time, st.path AS st_path, st.content_hash AS st_hash, st.file_id IS NOT NULL AS has_state,
    s.mime_type LIKE '%spreadsheetml.sheet' AS sheet, s.mime_type = 'text/html' AS html, s.mime_type = 'application/pdf' AS pdf
  FROM scoped s JOIN measures m USING (file_id) LEFT JOIN st USING (file_id)),
gated AS (SELECT *,
    CASE WHEN route = 'HWP_PARSE' AND size_bytes > 157286400 THEN 'SIZE_EXCEEDED:' || size_bytes || '>157286400(.hwp)'
      WHEN route = 'FILE_COPY' AND (sheet OR pdf) AND size_bytes > 157286400
        THEN 'SIZE_EXCEEDED:' || size_bytes || '>157286400(' || CASE WHEN pdf THEN '.pdf' ELSE '.xlsx' END || ')'
      WHEN route = 'FILE_COPY' AND html AND size_bytes > 10485760 THEN 'SIZE_EXCEEDED:' || size_bytes || '>10485760(.md)' END AS before_reason,
    CASE WHEN route = 'GOOGLE_EXPORT' AND raw_bytes > 10485760 THEN 'SIZE_EXCEEDED:' || raw_bytes || '>10485760(.xlsx)'
      WHEN route = 'FILE_COPY' AND sheet AND raw_bytes > 157286400 THEN 'SIZE_EXCEEDED:' || raw_bytes || '>157286400(.xlsx)'
      WHEN route = 'FILE_COPY' AND html AND raw_bytes > 10485760 THEN 'SIZE_EXCEEDED:' || raw_bytes || '>10485760(.html)'
      WHEN route = 'FILE_COPY' AND pdf AND parts IS NULL AND raw_bytes > 52428800 THEN 'SIZE_EXCEEDED:' || raw_bytes || '>52428800(.pdf)'
      END AS original_reason,
    CASE WHEN (route = 'HWP_PARSE' OR route = 'FILE_COPY' AND (html OR sheet AND md_bytes IS NOT NULL)) THEN
        CASE WHEN md_bytes > 10485760 THEN 'SIZE_EXCEEDED:' || md_bytes || '>10485760(.md)' END
      WHEN route = 'FILE_COPY' AND sheet AND raw_bytes > 10485760 THEN 'SIZE_EXCEEDED:' || raw_bytes || '>10485760(.xlsx)'
      WHEN route = 'FILE_COPY' AND pdf AND parts IS NULL AND raw_bytes > 52428800 THEN 'SIZE_EXCEEDED:' || raw_bytes || '>52428800(.pdf)'
      END AS product_reason FROM joined),
disposed AS (SELECT *, CASE WHEN NOT removed AND scope = 'UNKNOWN' THEN 'FAILED' WHEN NOT removed AND route = 'EXCLUDE' THEN 'EXCLUDED'
    WHEN route = 'DELETE' OR removed THEN 'DELETE_PENDING' WHEN route = 'SKIP' THEN 'SKIPPED'
    WHEN has_state AND status NOT IN ('FAILED', 'PENDING') AND modified_time <= st_time AND coalesce(st_path, '') <> '' AND status = 'INDEXED' THEN 'UNCHANGED'
    WHEN before_reason IS NOT NULL THEN 'SPLIT_QUEUED' WHEN rejection IS NOT NULL AND route = 'HWP_PARSE' THEN 'DLQ'
    WHEN coalesce(original_reason, product_reason) IS NOT NULL THEN 'SPLIT_QUEUED'
    WHEN st_hash = new_hash AND status = 'INDEXED' THEN 'HASH_UNCHANGED' ELSE 'GCS_READY' END AS disposition FROM gated),
planned AS (SELECT *, CASE disposition WHEN 'FAILED' THEN 'folder_scope_unknown' WHEN 'EXCLUDED' THEN 'out_of_folder_scope' WHEN 'DLQ' THEN rejection
    WHEN 'SPLIT_QUEUED' THEN coalesce(before_reason, original_reason, product_reason) END AS reason,
    disposition = 'EXCLUDED' AND coalesce(status IN ('EXCLUDED', 'SKIPPED') AND coalesce(st_error, '') = 'out_of_folder_scope', FALSE) AS cleanup_skipped
  FROM disposed),
made AS (SELECT file_id, drive_id, unnest(CASE WHEN route = 'HWP_PARSE' OR html OR (sheet AND sheet_error IS NULL) THEN [file_id || '.md']
      WHEN sheet AND route = 'FILE_COPY' THEN [file_id || '.meta.md']
      WHEN route = 'GOOGLE_EXPORT' THEN [file_id || '.xlsx', file_id || '.meta.md']
      WHEN parts > 1 THEN [file_id || '.part1.pdf', file_id || '.part2.pdf', file_id || '.meta.md']
      ELSE [file_id || '.pdf', file_id || '.meta.md'] END) AS object_name FROM planned WHERE disposition = 'GCS_READY')"""


def measures(changes: DataFrame) -> DataFrame:
    seq = F.col("seq")
    raw = F.col("size_bytes") * (seq % 3 + 1)
    return changes.select(
        "file_id", raw.alias("raw_bytes"),
        F.when(seq % 2 == 0, F.floor(F.col("size_bytes") / 2).cast("bigint")).alias("md_bytes"),
        F.when((F.col("mime_type") == "application/pdf") & (raw > 52428800) & (seq % 9 != 0), 2).alias("parts"),
        F.concat(F.lit("h"), (seq % 5).cast("string")).alias("content_hash"),
        F.when(seq % 7 == 0, F.concat(F.lit("EMPTY_TEXT:"), seq.cast("string"))).alias("rejection"),
        F.when(seq % 2 == 1, "locked").alias("sheet_error"),
    )


def planned(t: Tables) -> DataFrame:
    latest = routing.latest_changes(readers.has_file_id(feed(t)))
    return sync.plan_changes(feed(t), full_state(t), t.v_folders, measures(latest), OPTS)


# --- Feed, files, objects ------------------------------------------------------------

@query("change_page", "S1 L3 P4", """
WITH kept AS (SELECT seq, drive_id, file_id, row_number() OVER (PARTITION BY drive_id ORDER BY seq) AS page_row FROM v_changes WHERE file_id <> '')
SELECT drive_id, seq, file_id, page_row FROM kept WHERE page_row <= 200
""")
def _(t: Tables):
    return readers.change_page(t.v_changes, 200).select("drive_id", "seq", "file_id", "page_row")


@query("page_tokens", "S1 L3", """
WITH raw AS (SELECT seq, drive_id, file_id FROM v_changes WHERE seq > 20),
kept AS (SELECT *, row_number() OVER (PARTITION BY drive_id ORDER BY seq) AS i FROM raw WHERE file_id <> ''),
page AS (SELECT drive_id, count(*) AS kept, max(seq) AS last_kept FROM kept WHERE i <= 120 GROUP BY 1)
SELECT r.drive_id, any_value(p.kept) AS kept, CASE WHEN any_value(p.kept) >= 120 THEN any_value(last_kept) ELSE max(r.seq) END AS token,
       any_value(p.kept) >= 120 AND max(r.seq) > any_value(last_kept) AS has_more
FROM raw r LEFT JOIN page p USING (drive_id) GROUP BY r.drive_id
UNION ALL SELECT 'drive_9', 0, 20, FALSE
""")
def _(t: Tables):
    drives = t.v_changes.select("drive_id").distinct()
    idle = drives.select(F.regexp_replace("drive_id", "[0-9]+", "9").alias("drive_id")).distinct()
    tokens = drives.unionByName(idle).withColumn("token", F.lit(20).cast("bigint"))
    return readers.page_tokens(t.v_changes, 120, tokens)


@query("wire_changes", "S2 C22", """
SELECT seq, CASE WHEN seq % 10 = 0 OR file_id = '' THEN 'm' || CAST(seq AS VARCHAR) ELSE file_id END AS file_id,
       CASE WHEN seq % 4 = 0 THEN 'own' ELSE drive_id END AS drive_id, mime_type, removed OR seq % 8 = 0 AS removed, seq % 8 = 0 AS trashed,
       CAST(size AS BIGINT) AS size_bytes, 1 AS parent_count FROM v_changes
""")
def _(t: Tables):
    seq = F.col("seq")
    none = F.lit(None).cast("string")
    meta = F.struct(
        F.concat(F.lit("m"), seq.cast("string")).alias("id"), F.lit("n").alias("name"),
        F.col("mime_type").alias("mimeType"), none.alias("modifiedTime"), (seq % 8 == 0).alias("trashed"),
        none.alias("md5Checksum"), F.col("size"), none.alias("webViewLink"), F.array("parent_id").alias("parents"),
        F.when(seq % 4 == 0, "own").alias("driveId"),
    )
    raw = t.v_changes.select(
        "seq", F.col("drive_id").alias("driveId"),
        F.when(seq % 10 == 0, "").otherwise(F.col("file_id")).alias("fileId"),
        "removed", meta.alias("file"),
    )
    return readers.map_wire_changes(raw).select(
        "seq", "file_id", "drive_id", "mime_type", "removed", "trashed", "size_bytes",
        F.size("parents").alias("parent_count"),
    )


@query("snapshot_scan", "S3", "SELECT file_id, name FROM v_files WHERE NOT trashed")
def _(t: Tables):
    return readers.snapshot(t.v_files).select("file_id", "name")


@query("files_under_roots", "S4", f"""
WITH {SCOPES} SELECT file_id FROM v_files JOIN folder_flags USING (parent_id) WHERE in_sync
""")
def _(t: Tables):
    return scope.files_under(t.v_files, t.v_folders, OPTS.sync_roots).select("file_id")


@query("object_listing", "S6 U2", f"""
WITH {OBJECTS} SELECT bucket, name FROM objs WHERE bucket = 'original' AND name LIKE 'doc_%'
UNION ALL SELECT bucket, name FROM objs WHERE bucket = 'source'
""")
def _(t: Tables):
    rows = objects(t)
    return readers.list_objects(rows, ORIGINALS, "doc_").unionByName(readers.list_objects(rows, BUCKET))


@query("objects_of_files", "S7", f"""
WITH {OBJECTS}, {REMOVED}
SELECT r.file_id, o.bucket, o.name FROM objs o JOIN removed r ON o.name = r.file_id OR starts_with(o.name, r.file_id || '.')
""")
def _(t: Tables):
    return readers.objects_of_files(objects(t), removed_files(t)).select("file_id", "bucket", "name")


@query("state_rows", "S8 P14", """
SELECT file_id, drive_id, name, modified_time, CASE WHEN status = 'NEW_VALUE' THEN 'PENDING' ELSE status END AS status, error, path, bundle,
       coalesce(audience, 'STAFF') AS audience, 'NONE' AS parse_route FROM v_state
""")
def _(t: Tables):
    none = F.lit(None).cast("string")
    even = F.right("file_id", F.lit(1)).cast("int") % 2 == 0
    wire = t.v_state.select(
        F.when(even, F.col("file_id")).alias("fileId"), F.when(~even, F.col("file_id")).alias("file_id"),
        F.when(even, F.col("drive_id")).alias("driveId"), F.when(~even, F.col("drive_id")).alias("drive_id"),
        "name", none.alias("mimeType"), none.alias("mime_type"), F.col("modified_time").alias("modifiedTime"),
        none.alias("modified_time"), none.alias("contentHash"), none.alias("content_hash"), "status",
        F.lit("???").alias("parseRoute"), F.lit(None).cast("timestamp").alias("lastSyncedAt"),
        F.lit(None).cast("timestamp").alias("last_synced_at"), "error", none.alias("sourceUri"),
        none.alias("source_uri"), none.alias("ragFileId"), none.alias("rag_file_id"), "path", "bundle", "audience",
    )
    return readers.read_state(wire).select(
        "file_id", "drive_id", "name", "modified_time", "status", "error", "path", "bundle", "audience", "parse_route"
    )


@query("baseline_tokens", "S21", """
SELECT drive_id, CASE WHEN drive_id = 'drive_0' THEN 7 ELSE max(seq) END AS token,
       CASE WHEN drive_id = 'drive_0' THEN 'exists' ELSE 'created_baseline_only' END AS token_status FROM v_changes GROUP BY drive_id
""")
def _(t: Tables):
    known = t.v_changes.filter(F.col("drive_id") == "drive_0").select("drive_id").distinct().withColumn("token", F.lit(7).cast("bigint"))
    return readers.baseline_tokens(t.v_changes, known, baseline_only=True)


# --- Scope and routing ---------------------------------------------------------------

@query("file_scope", "J1 J3", f"""
WITH {SCOPES} SELECT file_id, CASE WHEN parent_id IS NULL OR in_sync IS NULL THEN 'UNKNOWN' WHEN in_sync THEN 'IN' ELSE 'OUT' END AS scope,
  CASE WHEN in_student THEN 'STUDENT' ELSE 'STAFF' END AS audience FROM v_files LEFT JOIN folder_flags USING (parent_id)
""")
def _(t: Tables):
    return scope.resolve_scope(t.v_files, t.v_folders, OPTS.sync_roots, OPTS.student_roots)


@query("file_paths", "J2 C18", f"""
WITH {SCOPES} SELECT file_id, coalesce(folder_path || '/', '') || trim(name) AS path, coalesce(folder_name, '') AS bundle
FROM v_files LEFT JOIN folder_flags USING (parent_id)
""")
def _(t: Tables):
    return scope.file_paths(t.v_files, t.v_folders).select("file_id", "path", "bundle")


@query("route_classes", "P1 P2 P11 J14", """
SELECT file_id, CASE o % 8 WHEN 1 THEN 'HWP_PARSE' WHEN 2 THEN 'HWP_PARSE' WHEN 6 THEN 'GOOGLE_EXPORT' WHEN 7 THEN 'SKIP' ELSE 'FILE_COPY' END AS route,
       o % 8 = 2 AS hwpx, CASE WHEN o % 8 = 2 THEN 'python-hwpx' ELSE 'rhwp' END AS engine,
       CASE o % 8 WHEN 0 THEN '.pdf' WHEN 1 THEN '.hwp' WHEN 2 THEN '.HWPX' WHEN 3 THEN '.xlsx' WHEN 4 THEN '.txt' WHEN 5 THEN '.zip' WHEN 6 THEN '.bin' ELSE '.png' END AS suffix
FROM (SELECT file_id, CAST(right(file_id, 8) AS BIGINT) AS o FROM v_files) x
""")
def _(t: Tables):
    mime, name = F.col("mime_type"), F.col("name")
    return t.v_files.select(
        "file_id", routing.classify_route(mime, name, F.lit(False)).alias("route"),
        routing.is_hwpx(mime, name).alias("hwpx"), routing.parse_engine(name).alias("engine"),
        routing.source_suffix(mime, name, F.col("file_id")).alias("suffix"),
    )


@query("routed_changes", "P3", f"WITH {PLANNED} SELECT file_id, scope, route, CASE WHEN route = 'EXCLUDE' THEN 'out_of_folder_scope' END AS skip_reason FROM scoped")
def _(t: Tables):
    latest = routing.latest_changes(readers.has_file_id(feed(t)))
    scopes = scope.resolve_scope(latest, t.v_folders, OPTS.sync_roots)
    return routing.route_changes(latest, scopes).select("file_id", "scope", "route", "skip_reason")


@query("snapshot_counts", "P3 S3", f"""
WITH {SCOPES} SELECT count(*) FILTER (in_sync AND o % 8 <> 7) AS listed, count(*) FILTER (NOT in_sync) AS excluded
FROM (SELECT *, CAST(right(file_id, 8) AS BIGINT) AS o FROM v_files WHERE NOT trashed) f LEFT JOIN folder_flags USING (parent_id)
""")
def _(t: Tables):
    files = readers.snapshot(t.v_files).withColumn("removed", F.lit(False))
    scopes = scope.resolve_scope(files, t.v_folders, OPTS.sync_roots)
    return routing.snapshot_counts(routing.route_changes(files, scopes))


@query("snapshot_plan", "S3 P3 P15 snapshot_plan", f"""
WITH {SCOPES} SELECT file_id, CASE o % 8 WHEN 1 THEN 'HWP_PARSE' WHEN 2 THEN 'HWP_PARSE' WHEN 6 THEN 'GOOGLE_EXPORT' ELSE 'FILE_COPY' END AS route,
  CASE WHEN in_student THEN 'STUDENT' ELSE 'STAFF' END AS audience, folder_path || '/' || trim(name) AS path,
  CASE WHEN o % 8 = 4 AND size_bytes > 10485760 THEN 'SPLIT_QUEUED' ELSE 'GCS_READY' END AS disposition
FROM (SELECT *, CAST(right(file_id, 8) AS BIGINT) AS o FROM v_files WHERE NOT trashed) f JOIN folder_flags USING (parent_id) WHERE in_sync AND o % 8 <> 7
""")
def _(t: Tables):
    nothing_read = t.v_files.select("file_id").withColumn("parts", F.lit(None).cast("int"))
    plan = sync.snapshot_plan(t.v_files, full_state(t), t.v_folders, nothing_read, OPTS)
    return plan.select("file_id", "route", "audience", "path", "disposition")


@query("size_limits", "P8 P9", """
SELECT file_id, CASE WHEN o % 8 = 0 THEN 20971520 ELSE 10485760 END AS size_limit,
  CASE WHEN size_bytes > CASE WHEN o % 8 = 0 THEN 20971520 ELSE 10485760 END THEN 'SIZE_EXCEEDED:' || size_bytes || '>'
    || CASE WHEN o % 8 = 0 THEN '20971520' ELSE '10485760' END || '(' || CASE o % 8 WHEN 0 THEN '.pdf' WHEN 1 THEN '.hwp' WHEN 2 THEN '.HWPX' WHEN 3 THEN '.xlsx'
      WHEN 4 THEN '.txt' WHEN 5 THEN '.zip' WHEN 6 THEN '.bin' ELSE '.png' END || ')' END AS reason
FROM (SELECT *, CAST(right(file_id, 8) AS BIGINT) AS o FROM v_files) x
""")
def _(t: Tables):
    suffix = routing.source_suffix(F.col("mime_type"), F.col("name"), F.col("file_id"))
    limit = routing.effective_limit(suffix, 20 * 1024 * 1024)
    return t.v_files.select(
        "file_id", limit.alias("size_limit"), routing.size_reason(F.col("size_bytes"), limit, suffix).alias("reason")
    )


@query("size_gates", "P10", f"WITH {PLANNED} SELECT file_id, before_reason, original_reason, product_reason FROM gated")
def _(t: Tables):
    rows = planned(t)
    checks = routing.size_gates(
        *(F.col(c) for c in ("route", "mime_type", "name", "file_id", "size_bytes", "raw_bytes", "md_bytes", "parts")),
        OPTS.storage_cap_bytes,
    )
    return rows.select("file_id", *[checks[c].alias(f"{c}_reason") for c in ("before", "original", "product")])


QUALITY = """
m AS (SELECT doc_id, n_chars AS text_length, CASE WHEN doc_id % 50 = 0 THEN 0 ELSE n_chars * (doc_id % 9) * 400 END AS source_bytes,
        CAST(doc_id % 5 AS INTEGER) AS table_count, CAST(doc_id % 3 AS INTEGER) AS tables_rendered FROM documents),
g AS (SELECT *, CASE WHEN source_bytes > 0 THEN text_length / source_bytes ELSE 0.0 END AS density, greatest(0, table_count - tables_rendered) AS lost FROM m),
q AS (SELECT *, array_to_string(list_filter([CASE WHEN density < 0.0005 THEN 'G1_DENSITY:' || printf('%.6f', density) || '<0.0005' END,
    CASE WHEN table_count > 0 AND lost / table_count > 0.3 THEN 'G2_TABLE_LOST:' || lost || '/' || table_count || '=' || printf('%.3f', lost / table_count) || '>0.3' END,
    CASE WHEN text_length < 20 THEN 'EMPTY_TEXT:' || text_length || '<20' END], lambda x: x IS NOT NULL), '|') AS reasons, text_length < 20 AS empty_text FROM g)"""


def quality(t: Tables, opts: GateOptions = GateOptions()) -> DataFrame:
    doc = F.col("doc_id")
    metrics = t.documents.select(
        "doc_id", F.col("n_chars").alias("text_length"),
        F.when(doc % 50 == 0, 0).otherwise(F.col("n_chars") * (doc % 9) * 400).alias("source_bytes"),
        (doc % 5).cast("int").alias("table_count"), (doc % 3).cast("int").alias("tables_rendered"),
    )
    return gates.evaluate_quality(metrics, opts)


@query("quality_gate", "P12", f"WITH {QUALITY} SELECT doc_id, reasons, reasons <> '' AS triggered, empty_text FROM q")
def _(t: Tables):
    return quality(t).select("doc_id", F.array_join("reasons", "|").alias("reasons"), "triggered", "empty_text")


@query("gate_dispositions", "P13", f"""
WITH {QUALITY}, modes AS (SELECT doc_id, CASE WHEN reasons = '' THEN 'pass' WHEN empty_text THEN 'EMPTY_TEXT' ELSE 'hit' END AS s FROM q)
SELECT doc_id, replace(s, 'hit', 'logged') AS log_mode, replace(s, 'hit', 'QUALITY_GATE') AS reject_mode,
       replace(s, 'hit', 'fallback_requested') AS fallback_mode, replace(s, 'hit', 'logged') AS fallback_off FROM modes
""")
def _(t: Tables):
    def under(name: str, opts: GateOptions):
        return gates.gate_disposition(F.col("triggered"), F.col("empty_text"), opts).alias(name)

    return quality(t).select(
        "doc_id", under("log_mode", GateOptions()), under("reject_mode", GateOptions(mode="reject")),
        under("fallback_mode", GateOptions(mode="fallback", fallback_enabled=True)),
        under("fallback_off", GateOptions(mode="fallback")),
    )


@query("reparse_flags", "P5 P6 P7 P16 J4", f"""
WITH {PLANNED} SELECT file_id, (st_time IS NULL OR status IN ('FAILED', 'PENDING') OR modified_time > st_time) AS reparse,
  NOT (st_time IS NULL OR status IN ('FAILED', 'PENDING') OR modified_time > st_time) AND coalesce(st_path, '') <> '' AND status = 'INDEXED' AS unchanged,
  coalesce(st_hash = new_hash AND status = 'INDEXED', FALSE) AS same_hash,
  coalesce(status IN ('EXCLUDED', 'SKIPPED') AND coalesce(st_error, '') = 'out_of_folder_scope', FALSE) AS evicted FROM joined
""")
def _(t: Tables):
    c = F.col
    reparse = routing.should_reparse(c("modified_time"), c("has_state"), c("state_modified_time"), c("state_status"))
    return planned(t).select(
        "file_id", reparse.alias("reparse"),
        routing.is_unchanged(reparse, c("state_path"), c("state_status")).alias("unchanged"),
        routing.hash_unchanged(c("state_content_hash"), c("content_hash"), c("state_status")).alias("same_hash"),
        routing.already_evicted(c("state_status"), c("state_error")).alias("evicted"),
    )


@query("latest_changes", "W13", f"WITH {PLANNED} SELECT file_id, seq, removed, mime_type FROM latest")
def _(t: Tables):
    return routing.latest_changes(readers.has_file_id(feed(t))).select("file_id", "seq", "removed", "mime_type")


@query("change_dispositions", "P15 X4 plan_changes", f"""
WITH {PLANNED} SELECT file_id, route, audience, path, bundle, disposition, reason, cleanup_skipped FROM planned
""")
def _(t: Tables):
    return planned(t).select(
        "file_id", "route", "audience", "path", "bundle", "disposition", "reason", "cleanup_skipped"
    )


# --- Totals and gates ----------------------------------------------------------------

TOTALS = f"""{PLANNED},
counts AS (SELECT file_id, count(*) AS n FROM made GROUP BY 1),
totals AS (SELECT drive_id, count(*) AS listed, count(*) FILTER (disposition = 'GCS_READY') AS gcs_uploaded,
    coalesce(sum(n), 0) AS uris, count(*) FILTER (disposition IN ('FAILED', 'REJECTED')) AS failed, count(*) FILTER (disposition = 'SKIPPED') AS skipped,
    count(*) FILTER (disposition = 'DELETE_PENDING') AS deleted, count(*) FILTER (disposition LIKE '%UNCHANGED') AS unchanged,
    count(*) FILTER (disposition = 'DLQ') AS dlq, count(*) FILTER (disposition = 'SPLIT_QUEUED') AS split_queued,
    count(*) FILTER (disposition IN ('DLQ', 'SPLIT_QUEUED')) AS parked, count(*) FILTER (disposition = 'EXCLUDED') AS excluded
  FROM planned LEFT JOIN counts USING (file_id) GROUP BY drive_id),
checked AS (SELECT *, CASE WHEN drive_id = 'drive_1' THEN uris - 1 ELSE uris END AS indexed FROM totals),
recon AS (SELECT *, listed - excluded AS listed_in_scope,
    listed - excluded - gcs_uploaded - failed - parked - skipped - deleted - unchanged AS unaccounted,
    indexed = CASE WHEN uris > 0 THEN uris ELSE gcs_uploaded END AS index_consistent FROM checked)"""


@query("run_totals", "A1", f"""
WITH {TOTALS} SELECT drive_id, listed, gcs_uploaded, uris, failed, skipped, deleted, unchanged, dlq, split_queued, parked, excluded FROM totals
""")
def _(t: Tables):
    return reconcile.run_totals(sync.outcomes(planned(t)))


def indexed_of(totals: DataFrame) -> DataFrame:
    return totals.withColumn("indexed", F.when(F.col("drive_id") == "drive_1", F.col("uris") - 1).otherwise(F.col("uris")))


@query("reconciled_runs", "A2", f"""
WITH {TOTALS} SELECT drive_id, listed_in_scope, indexed, unaccounted, index_consistent, unaccounted = 0 AND index_consistent AS ok FROM recon
""")
def _(t: Tables):
    totals = indexed_of(reconcile.run_totals(sync.outcomes(planned(t))))
    return reconcile.reconcile(totals).select(
        "drive_id", "listed_in_scope", "indexed", "unaccounted", "index_consistent", "ok"
    )


@query("commit_gates", "A4 A5", f"""
WITH {TOTALS}, feed_end AS (SELECT drive_id, CAST(max(seq) AS VARCHAR) AS token FROM v_changes GROUP BY 1)
SELECT drive_id, token, failed = 0 AND uris = indexed AND unaccounted = 0 AND index_consistent AS "commit",
  failed = 0 AND uris = indexed AND unaccounted = 0 AND index_consistent AND drive_id <> 'drive_2' AS next_page FROM recon JOIN feed_end USING (drive_id)
""")
def _(t: Tables):
    totals = indexed_of(reconcile.run_totals(sync.outcomes(planned(t))))
    ends = t.v_changes.groupBy("drive_id").agg(F.max("seq").cast("string").alias("token"))
    runs = reconcile.reconcile(totals).join(ends, "drive_id").select(
        "*", F.greatest(F.lit(0), F.col("uris") - F.col("indexed")).alias("index_failed"),
        (F.col("drive_id") != "drive_2").alias("has_more"), F.lit(1).alias("page"),
    )
    return reconcile.commit_gates(runs, OPTS.max_pages).select("drive_id", "token", "commit", "next_page")


@query("committed_tokens", "S18", """
SELECT drive_id, CASE WHEN drive_id = 'drive_2' THEN 5 ELSE max(seq) END AS token FROM v_changes GROUP BY drive_id
""")
def _(t: Tables):
    ends = t.v_changes.groupBy("drive_id").agg(F.max("seq").alias("token"))
    runs = ends.withColumn("commit", F.col("drive_id") != "drive_2")
    control = ends.withColumn("token", F.lit(5).cast("bigint"))
    return reconcile.commit_tokens(control, runs)


@query("import_rollup", "A3 P22", """
WITH b AS (SELECT user_id % 7 AS run_id, 25 AS requested, CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_type = 'error' THEN 24 ELSE 25 END AS imported,
             CASE WHEN event_type = 'error' AND user_id % 7 < 3 THEN 1 ELSE 0 END AS failed, CASE WHEN event_type = 'error' AND user_id % 7 >= 3 THEN 1 ELSE 0 END AS skipped FROM events)
SELECT run_id, sum(requested) AS requested, sum(coalesce(imported, requested)) AS imported, sum(failed) AS failed, sum(skipped) AS skipped,
       sum(failed) = 0 AND sum(coalesce(imported, requested)) + sum(skipped) >= sum(requested) AS ok,
       greatest(0, sum(requested) - sum(coalesce(imported, requested))) AS index_failed FROM b GROUP BY run_id
""")
def _(t: Tables):
    run, bad = F.col("user_id") % 7, F.col("event_type") == "error"
    batches = t.events.select(
        run.alias("run_id"), F.lit(25).alias("requested"),
        F.when(F.col("event_id") % 11 == 0, None).when(bad, 24).otherwise(25).alias("imported"),
        F.when(bad & (run < 3), 1).otherwise(0).alias("failed"), F.when(bad & (run >= 3), 1).otherwise(0).alias("skipped"),
    )
    return reconcile.import_totals(batches, ("run_id",))


# --- State, queues, indexes ----------------------------------------------------------

MERGED_STATE = f"""
WITH {PLANNED}, first_object AS (SELECT file_id, min(object_name) FILTER (object_name NOT LIKE '%.meta.md') AS body, min(object_name) AS side FROM made GROUP BY 1),
u AS (SELECT p.*, 'gs://source/' || coalesce(o.body, o.side) AS first_uri FROM planned p LEFT JOIN first_object o USING (file_id)
      WHERE disposition <> 'UNCHANGED' AND NOT cleanup_skipped),
full_write AS (SELECT file_id, disposition IN ('GCS_READY', 'SKIPPED', 'EXCLUDED') AS all_fields FROM u)
SELECT file_id,
  CASE u.disposition WHEN 'GCS_READY' THEN 'PARSED' WHEN 'SKIPPED' THEN 'SKIPPED' WHEN 'EXCLUDED' THEN 'EXCLUDED' WHEN 'DELETE_PENDING' THEN 'DELETED'
    WHEN 'HASH_UNCHANGED' THEN st.status WHEN NULL THEN st.status ELSE CASE WHEN u.file_id IS NULL THEN st.status ELSE 'FAILED' END END AS status,
  CASE WHEN u.file_id IS NULL OR u.disposition = 'DELETE_PENDING' THEN st.modified_time ELSE u.modified_time END AS modified_time,
  CASE WHEN f.all_fields THEN CASE WHEN u.disposition = 'GCS_READY' THEN u.new_hash END ELSE st.content_hash END AS content_hash,
  CASE WHEN u.file_id IS NULL OR u.disposition = 'HASH_UNCHANGED' THEN st.error WHEN u.disposition = 'GCS_READY' THEN CASE WHEN u.sheet_error IS NOT NULL THEN 'XLSX_UNREADABLE:' || u.sheet_error END
    ELSE u.reason END AS error,
  CASE WHEN u.disposition = 'GCS_READY' THEN coalesce(u.web_view_link, u.first_uri) WHEN f.all_fields THEN u.web_view_link ELSE st.source_uri END AS source_uri,
  CASE WHEN u.disposition = 'GCS_READY' THEN u.path WHEN f.all_fields THEN NULL ELSE st.path END AS path,
  CASE WHEN u.disposition = 'GCS_READY' OR u.disposition = 'HASH_UNCHANGED' THEN u.audience WHEN f.all_fields THEN 'STAFF' ELSE st.audience END AS audience
FROM st FULL JOIN u USING (file_id) LEFT JOIN full_write f USING (file_id)
"""


@query("merged_state", "S11 X2 X3 apply_changes", MERGED_STATE)
def _(t: Tables):
    updates = sync.state_updates(planned(t), BUCKET, now(), OPTS)
    merged = merge.merge_rows(full_state(t), updates)
    return merged.select(
        "file_id", "status", "modified_time", "content_hash", "error", "source_uri", "path", "audience"
    )


@query("applied_state", "S12 X1 index_batch", MERGED_STATE.replace("'GCS_READY' THEN 'PARSED'", "'GCS_READY' THEN 'INDEXED'"))
def _(t: Tables):
    return applied(t)["state"].select(
        "file_id", "status", "modified_time", "content_hash", "error", "source_uri", "path", "audience"
    )


@query("indexed_state", "S12", f"""
WITH {STATE}, batch AS (SELECT DISTINCT file_id FROM v_changes WHERE file_id <> '' AND seq % 2 = 0)
SELECT file_id, CASE WHEN b.file_id IS NOT NULL THEN 'INDEXED' WHEN st.status = 'NEW_VALUE' THEN 'PENDING' ELSE st.status END AS status,
       coalesce(st.drive_id, '') AS drive_id, st.error, coalesce(b.file_id IS NOT NULL AND st.status = 'FAILED', FALSE) AS cleared
FROM st FULL JOIN batch b USING (file_id)
""")
def _(t: Tables):
    state = full_state(t)
    batch = t.v_changes.filter((F.col("file_id") != "") & (F.col("seq") % 2 == 0)).select("file_id").distinct()
    queue = state.filter(F.col("status") == "FAILED").select("file_id", F.lit("r").alias("reason"))
    merged, (left,) = merge.mark_indexed(state, [queue], batch, now())
    cleared = queue.join(left, "file_id", "left_anti").select("file_id", F.lit(True).alias("cleared"))
    return merge.stub_defaults(merged).join(cleared, "file_id", "left").select(
        "file_id", "status", "drive_id", "error", F.coalesce("cleared", F.lit(False)).alias("cleared")
    )


QUEUE = f"""{STATE}, q0 AS (SELECT file_id, 'old' AS reason, CAST(right(file_id, 8) AS BIGINT) % 5 AS retry_count FROM v_state WHERE status = 'FAILED')"""


def retry_queue(t: Tables) -> DataFrame:
    failed = t.v_state.filter(F.col("status") == "FAILED")
    none = F.lit(None)
    return failed.select(
        "file_id", F.lit("old").alias("reason"), none.cast("timestamp").alias("enqueued_at"),
        (F.right("file_id", F.lit(8)).cast("bigint") % 5).alias("retry_count"),
        none.cast("timestamp").alias("last_retry_at"), none.cast("string").alias("drive_id"),
        none.cast("string").alias("name"), none.cast("string").alias("mime_type"),
        none.cast("string").alias("modified_time"), none.cast("string").alias("route"),
        none.cast("string").alias("source_uri"), none.cast("bigint").alias("size_bytes"),
    )


@query("enqueued_failures", "S13", f"""
WITH {QUEUE}, entered AS (SELECT file_id, repeat(any_value(event_type), 300) AS reason FROM (
    SELECT 'doc_' || lpad(CAST(user_id AS VARCHAR), 8, '0') AS file_id, event_type FROM events WHERE event_type = 'error') x GROUP BY 1)
SELECT file_id, coalesce(e.reason, q0.reason) AS reason, q0.retry_count FROM q0 FULL JOIN entered e USING (file_id)
""")
def _(t: Tables):
    errors = t.events.filter(F.col("event_type") == "error").select(_padded("doc_", F.col("user_id")).alias("file_id")).distinct()
    rows = errors.withColumn("reason", F.repeat(F.lit("error"), F.lit(300)))
    return merge.enqueue(retry_queue(t), rows, now()).select("file_id", "reason", "retry_count")


@query("recorded_attempts", "S13 X5", f"""
WITH {QUEUE} SELECT file_id, CASE WHEN status = 'FAILED' AND retry_count < 3 THEN retry_count + 1 ELSE retry_count END AS retry_count FROM q0 JOIN st USING (file_id)
""")
def _(t: Tables):
    candidates = recover.retry_candidates(full_state(t), retry_queue(t), OPTS.max_attempts)
    tried = candidates.filter(~F.col("exhausted"))
    return merge.record_attempts(retry_queue(t), tried, now()).select("file_id", "retry_count")


@query("cleared_queue", "S13", f"WITH {QUEUE}, {REMOVED} SELECT file_id FROM q0 WHERE file_id NOT IN (SELECT file_id FROM removed)")
def _(t: Tables):
    return merge.clear(retry_queue(t), removed_files(t)).select("file_id")


def applied(t: Tables) -> dict[str, DataFrame]:
    """All tables after the page of changes."""
    tables = {
        "state": full_state(t), "retry_queue": retry_queue(t),
        "split_queue": t.spark.createDataFrame([], schemas.SPLIT_QUEUE), "objects": objects(t),
        "staff_index": staff_index(t), "student_index": student_index(t),
    }
    return sync.apply_changes(planned(t), tables, BUCKET, now(), OPTS)


@query("applied_queue", "S13 X5 apply_changes", f"""
WITH {QUEUE.removeprefix(STATE).lstrip(", ")}, {PLANNED}, entered AS (SELECT file_id, reason, web_view_link FROM planned WHERE disposition IN ('DLQ', 'FAILED')),
left_it AS (SELECT file_id FROM made UNION SELECT file_id FROM planned WHERE disposition IN ('DELETE_PENDING', 'EXCLUDED'))
SELECT file_id, coalesce(e.reason, q0.reason) AS reason, q0.retry_count, e.web_view_link AS source_uri
FROM q0 FULL JOIN entered e USING (file_id) WHERE file_id NOT IN (SELECT file_id FROM left_it)
""")
def _(t: Tables):
    return applied(t)["retry_queue"].select("file_id", "reason", "retry_count", "source_uri")


@query("applied_index", "S14 X1 index_batch", f"""
WITH {INDEXES}, {PLANNED}, gone AS (SELECT file_id FROM planned WHERE disposition IN ('DELETE_PENDING', 'EXCLUDED'))
SELECT file_id, uri FROM staff WHERE file_id NOT IN (SELECT file_id FROM made) AND file_id NOT IN (SELECT file_id FROM gone)
UNION ALL SELECT file_id, 'gs://source/' || object_name FROM made
""")
def _(t: Tables):
    return applied(t)["staff_index"].select("file_id", "uri")


@query("replaced_index", "S14", f"""
WITH {INDEXES}, {PLANNED}
SELECT file_id, uri FROM staff WHERE file_id NOT IN (SELECT file_id FROM made) UNION ALL SELECT file_id, 'gs://source/' || object_name FROM made
""")
def _(t: Tables):
    made = corpus.source_objects(planned(t).filter(F.col("disposition") == "GCS_READY"))
    batch = made.select("file_id", ids.gs_uri(F.lit(BUCKET), F.col("object_name")).alias("uri"))
    return corpus.replace_files(staff_index(t), batch)


@query("deleted_from_index", "S15", f"WITH {INDEXES}, {REMOVED} SELECT file_id, uri FROM staff WHERE file_id NOT IN (SELECT file_id FROM removed)")
def _(t: Tables):
    return corpus.delete_files(staff_index(t), removed_files(t))


@query("delete_counts", "S16", f"""
WITH {INDEXES}, {REMOVED}, o AS (SELECT split_part(name, '.', 1) AS file_id, bucket FROM objs)
SELECT r.file_id, (SELECT count(*) FROM staff s WHERE s.file_id = r.file_id) > 0 AS deleted,
  (SELECT count(*) FROM o WHERE o.file_id = r.file_id AND bucket = 'source') AS source_deleted,
  (SELECT count(*) FROM o WHERE o.file_id = r.file_id AND bucket = 'original') AS original_deleted,
  (SELECT count(*) FROM o WHERE o.file_id = r.file_id) AS objects_deleted FROM removed r
""")
def _(t: Tables):
    return corpus.delete_counts(removed_files(t), staff_index(t), student_index(t), objects(t), BUCKET, ORIGINALS)


@query("deleted_everywhere", "S16", f"""
WITH {STATE}, {INDEXES}, {REMOVED}
SELECT 'staff' AS target, file_id AS item FROM staff WHERE file_id NOT IN (SELECT file_id FROM removed)
UNION ALL SELECT 'student', file_id FROM student WHERE file_id NOT IN (SELECT file_id FROM removed)
UNION ALL SELECT 'objects', name FROM objs WHERE split_part(name, '.', 1) NOT IN (SELECT file_id FROM removed)
UNION ALL SELECT 'deleted', file_id FROM removed UNION ALL SELECT 'deleted', file_id FROM st WHERE status = 'DELETED' AND file_id NOT IN (SELECT file_id FROM removed)
""")
def _(t: Tables):
    after = corpus.delete_everywhere(
        removed_files(t), staff_index(t), student_index(t), objects(t), full_state(t), now()
    )

    def tagged(name: str, df: DataFrame, item: str) -> DataFrame:
        return df.select(F.lit(name).alias("target"), F.col(item).alias("item"))

    return (
        tagged("staff", after["staff_index"], "file_id")
        .unionByName(tagged("student", after["student_index"], "file_id"))
        .unionByName(tagged("objects", after["objects"], "name"))
        .unionByName(tagged("deleted", after["state"].filter(F.col("status") == "DELETED"), "file_id"))
    )


@query("evicted_states", "S17", f"""
WITH {PLANNED} SELECT file_id, CASE WHEN seq % 3 = 0 THEN 'FAILED' ELSE 'EXCLUDED' END AS status,
  CASE WHEN seq % 3 = 0 THEN 'out_of_folder_scope_cleanup_failed: busy' ELSE 'out_of_folder_scope' END AS error
FROM planned WHERE disposition = 'EXCLUDED' AND NOT cleanup_skipped
""")
def _(t: Tables):
    gone = planned(t).filter(F.col("disposition") == "EXCLUDED").withColumn(
        "cleanup_error", F.when(F.col("seq") % 3 == 0, "busy")
    )
    return corpus.evicted_rows(gone, now()).select("file_id", "status", "error")


@query("live_objects", "S20", f"""
WITH objs AS (SELECT DISTINCT display_name AS name, split_part(display_name, '.', 1) AS file_id FROM v_chunks)
SELECT name FROM objs o WHERE NOT (name = file_id || '.meta.md' AND EXISTS (SELECT 1 FROM objs b WHERE b.name = o.file_id || '.md'))
""")
def _(t: Tables):
    return corpus.drop_stale_sidecars(objects(t).filter(F.col("bucket") == BUCKET), BUCKET).select("name")


@query("source_objects", "P29 S10", f"WITH {PLANNED} SELECT file_id, object_name FROM made")
def _(t: Tables):
    return corpus.source_objects(planned(t).filter(F.col("disposition") == "GCS_READY")).select("file_id", "object_name")


@query("parsed_states", "P30", f"""
WITH {PLANNED}, first_object AS (SELECT file_id, coalesce(min(object_name) FILTER (object_name NOT LIKE '%.meta.md'), min(object_name)) AS object_name FROM made GROUP BY 1)
SELECT file_id, 'PARSED' AS status, CASE route WHEN 'HWP_PARSE' THEN 'RHWP' WHEN 'GOOGLE_EXPORT' THEN 'GCS_EXPORT' ELSE 'GCS_COPY' END AS parse_route,
  coalesce(web_view_link, 'gs://source/' || object_name) AS source_uri, path, bundle, audience,
  CASE WHEN sheet_error IS NOT NULL THEN 'XLSX_UNREADABLE:' || sheet_error END AS error
FROM planned JOIN first_object USING (file_id) WHERE disposition = 'GCS_READY'
""")
def _(t: Tables):
    ready = planned(t).filter(F.col("disposition") == "GCS_READY")
    return corpus.parsed_state_rows(ready, BUCKET, now()).select(
        "file_id", "status", "parse_route", "source_uri", "path", "bundle", "audience", "error"
    )


@query("clean_file_ids", "P17 U1", f"""
WITH raw AS (SELECT chunk_id AS pos, CASE WHEN chunk_id % 10 = 3 THEN 'a.b' ELSE 'gs://source/' || display_name END AS raw FROM v_chunks),
x AS (SELECT pos, {file_id_sql('raw')} AS file_id FROM raw)
SELECT file_id, min(pos) AS first_pos, regexp_full_match(file_id, '[A-Za-z0-9_-]{{10,}}') AS clean FROM x GROUP BY file_id
""")
def _(t: Tables):
    raw = F.when(F.col("chunk_id") % 10 == 3, "a.b").otherwise(F.concat(F.lit("gs://source/"), "display_name"))
    found = t.v_chunks.select("chunk_id", ids.extract_file_id(raw).alias("file_id"))
    first = found.groupBy("file_id").agg(F.min("chunk_id").alias("first_pos"))
    return first.withColumn("clean", ids.is_clean_file_id(F.col("file_id")))


@query("indexable_objects", "P18", f"WITH {OBJECTS} SELECT bucket, name FROM objs WHERE name NOT LIKE '%.hwp'")
def _(t: Tables):
    return objects(t).filter(ids.is_indexable(F.col("name")))


@query("student_imports", "J10", f"WITH {INDEXES} SELECT s.file_id, s.uri FROM staff s JOIN v_state v USING (file_id) WHERE v.audience = 'STUDENT'")
def _(t: Tables):
    return corpus.student_imports(staff_index(t).select("uri"), full_state(t)).select("file_id", "uri")


@query("touched_ids", "U3", f"WITH {INDEXES}, {REMOVED} SELECT file_id FROM removed UNION SELECT file_id FROM staff")
def _(t: Tables):
    return corpus.touched_ids(staff_index(t).select("uri"), removed_files(t))


@query("student_index", "J10 X2", f"""
WITH {INDEXES}, batch AS (SELECT * FROM staff WHERE file_id IN (SELECT file_id FROM v_changes))
SELECT file_id, uri FROM student WHERE file_id NOT IN (SELECT file_id FROM batch)
UNION ALL SELECT b.file_id, b.uri FROM batch b JOIN v_state v USING (file_id) WHERE v.audience = 'STUDENT'
""")
def _(t: Tables):
    batch = staff_index(t).join(t.v_changes.select("file_id").distinct(), "file_id", "left_semi")
    return corpus.sync_audience(student_index(t), batch.select("uri"), batch.select("file_id"), full_state(t))


@query("audience_moves", "J3 J10", f"""
WITH {STATE}, {INDEXES} SELECT file_id, 'add' AS move FROM st WHERE audience = 'STUDENT' AND status = 'INDEXED' AND file_id NOT IN (SELECT file_id FROM student)
UNION ALL SELECT file_id, 'remove' FROM st WHERE audience <> 'STUDENT' AND file_id IN (SELECT file_id FROM student)
""")
def _(t: Tables):
    return corpus.audience_moves(student_index(t), full_state(t))


@query("outside_staff", "U5", f"""
WITH {INDEXES} SELECT DISTINCT file_id FROM student WHERE file_id NOT IN (SELECT file_id FROM staff WHERE uri NOT LIKE '%.pdf')
""")
def _(t: Tables):
    return corpus.outside_staff(student_index(t), staff_index(t).filter(~F.col("uri").endswith(".pdf")))


@query("batch_mismatch", "U6", f"""
WITH {REMOVED}, s AS (SELECT DISTINCT file_id FROM v_state)
SELECT file_id, 'deleted only' AS side FROM removed WHERE file_id NOT IN (SELECT file_id FROM s)
UNION ALL SELECT file_id, 'imported only' FROM s WHERE file_id NOT IN (SELECT file_id FROM removed)
""")
def _(t: Tables):
    return corpus.batch_mismatch(removed_files(t), t.v_state)


# --- Recovery ------------------------------------------------------------------------

SOURCES = f"""{OBJECTS}, targets AS (SELECT file_id FROM v_state WHERE status IN ('PARSED', 'INDEXED', 'FAILED')),
owned AS (SELECT split_part(name, '.', 1) AS file_id, count(*) AS n, string_agg('gs://source/' || name, ' ' ORDER BY name) AS uris
          FROM objs WHERE bucket = 'source' AND name NOT LIKE '%.md' GROUP BY 1),
sources AS (SELECT t.file_id, coalesce(n, 0) AS uri_count, coalesce(uris, '') AS uris, CASE WHEN n IS NULL THEN 'reindex_no_source_uri' END AS reason
            FROM targets t LEFT JOIN owned USING (file_id))"""


def reindex_sources(t: Tables) -> DataFrame:
    targets = t.v_state.filter(F.col("status").isin("PARSED", "INDEXED", "FAILED")).select("file_id")
    return recover.reindex_sources(targets, objects(t).filter(~F.col("name").endswith(".md")), BUCKET)


@query("reindex_sources", "J8", f"WITH {SOURCES} SELECT file_id, uri_count, uris, reason FROM sources")
def _(t: Tables):
    return reindex_sources(t).select("file_id", "uri_count", F.array_join("uris", " ").alias("uris"), "reason")


@query("reindex_totals", "A18", f"""
WITH {SOURCES}, done AS (SELECT file_id, uri_count, CASE WHEN file_id LIKE '%1' THEN 0 ELSE uri_count END AS indexed FROM sources)
SELECT count(*) AS candidates, count(*) FILTER (uri_count > 0) AS with_uris, sum(indexed) AS indexed, count(*) FILTER (uri_count = 0) AS skipped_no_uri,
  count(*) FILTER (uri_count = 0) + sum(uri_count - indexed) AS failed, count(*) FILTER (uri_count = 0) + sum(uri_count - indexed) = 0 AS ok FROM done
""")
def _(t: Tables):
    sources = reindex_sources(t)
    count = F.when(F.col("file_id").endswith("1"), 0).otherwise(F.col("uri_count"))
    return recover.reindex_totals(sources, sources.select("file_id", count.alias("indexed_count")))


@query("retry_candidates", "J9 P23 P24", f"""
WITH {QUEUE} SELECT file_id, coalesce(retry_count, 0) AS attempts, coalesce(retry_count, 0) >= 3 AS exhausted,
  CASE WHEN regexp_matches(trim(coalesce(source_uri, '')), '^https?://') THEN trim(source_uri) END AS link
FROM st LEFT JOIN q0 USING (file_id) WHERE status = 'FAILED'
""")
def _(t: Tables):
    rows = recover.retry_candidates(full_state(t), retry_queue(t), OPTS.max_attempts)
    return rows.select("file_id", "attempts", "exhausted", "link")


RETRIED = f"""{QUEUE},
res AS (SELECT file_id, f, CASE f % 7 WHEN 0 THEN 'GCS_READY' WHEN 1 THEN 'SKIPPED' WHEN 2 THEN 'EXCLUDED' WHEN 3 THEN 'GCS_READY' WHEN 4 THEN 'DLQ' WHEN 5 THEN 'HASH_UNCHANGED' ELSE 'DELETE_PENDING' END AS disposition,
          2 AS uri_count, CASE WHEN f % 7 = 3 THEN 1 ELSE 2 END AS indexed_count FROM (SELECT file_id, CAST(right(file_id, 8) AS BIGINT) AS f FROM v_state) x),
outcomes AS (SELECT file_id, disposition, indexed_count, CASE WHEN retry_count >= 3 THEN 'exhausted'
    WHEN (disposition = 'GCS_READY' AND indexed_count = uri_count) OR disposition IN ('SKIPPED', 'HASH_UNCHANGED') THEN 'recovered' ELSE 'still_failed' END AS outcome
  FROM q0 JOIN res USING (file_id))"""


def retried(t: Tables) -> DataFrame:
    f = F.right("file_id", F.lit(8)).cast("bigint") % 7
    names = ("GCS_READY", "SKIPPED", "EXCLUDED", "GCS_READY", "DLQ", "HASH_UNCHANGED", "DELETE_PENDING")
    results = t.v_state.select(
        "file_id", F.element_at(F.array(*[F.lit(n) for n in names]), (f + 1).cast("int")).alias("disposition"),
        F.lit(2).alias("uri_count"), F.when(f == 3, 1).otherwise(2).alias("indexed_count"),
    )
    return recover.retry_outcomes(recover.retry_candidates(full_state(t), retry_queue(t), 3), results)


@query("retry_outcomes", "X5 A18", f"WITH {RETRIED} SELECT file_id, disposition, outcome FROM outcomes")
def _(t: Tables):
    return retried(t).select("file_id", "disposition", "outcome")


@query("retry_totals", "A18", f"""
WITH {RETRIED} SELECT count(*) AS candidates, count(*) FILTER (outcome <> 'exhausted') AS retried, count(*) FILTER (outcome = 'recovered') AS recovered,
  count(*) FILTER (outcome = 'still_failed') AS still_failed, count(*) FILTER (outcome = 'exhausted') AS exhausted,
  coalesce(sum(indexed_count) FILTER (outcome = 'recovered' AND disposition = 'GCS_READY'), 0) AS indexed, count(*) FILTER (outcome = 'still_failed') = 0 AS ok FROM outcomes
""")
def _(t: Tables):
    return recover.retry_totals(retried(t))


@query("round_robin_page", "L4", """
SELECT file_id FROM v_state WHERE status = 'INDEXED' ORDER BY CASE WHEN file_id > 'doc_00000050' THEN 0 ELSE 1 END, file_id LIMIT 100
""")
def _(t: Tables):
    indexed = t.v_state.filter(F.col("status") == "INDEXED").select("file_id")
    return recover.round_robin_page(indexed, 100, "doc_00000050")


@query("round_robin_cursor", "L4", """
WITH page AS (SELECT file_id, CASE WHEN file_id > 'doc_00000050' THEN 0 ELSE 1 END AS wrap FROM v_state WHERE status = 'INDEXED' ORDER BY wrap, file_id LIMIT 100)
SELECT arg_max(file_id, CAST(wrap AS VARCHAR) || file_id) AS cursor FROM page
""")
def _(t: Tables):
    indexed = t.v_state.filter(F.col("status") == "INDEXED").select("file_id")
    return recover.page_cursor(recover.round_robin_page(indexed, 100, "doc_00000050"), "doc_00000050")


@query("reindex_page", "L5", """
SELECT file_id, status FROM v_state WHERE status IN ('PARSED', 'INDEXED')
ORDER BY CASE status WHEN 'PARSED' THEN 0 ELSE 1 END, CASE WHEN status = 'PARSED' AND file_id <= 'doc_00000020' THEN 1 ELSE 0 END, file_id LIMIT 60
""")
def _(t: Tables):
    page = recover.reindex_page(full_state(t), 60, force=True, cursors={"PARSED": "doc_00000020"})
    return page.select("file_id", "status")


@query("import_calls", "W10", f"""
WITH {INDEXES} SELECT uri, (row_number() OVER (ORDER BY uri) - 1) // 25 AS call_no FROM staff
""")
def _(t: Tables):
    return recover.import_calls(staff_index(t).select("uri"), ("uri",)).select("uri", "call_no")


@query("document_batches", "W11", f"""
WITH RECURSIVE {OBJECTS},
docs AS (SELECT split_part(name, '.', 1) AS file_id, count(*) AS n FROM objs WHERE bucket = 'source' GROUP BY 1),
runs AS (SELECT 'drive_' || CAST(CAST(right(file_id, 8) AS BIGINT) % 3 AS VARCHAR) AS run, file_id, n,
           row_number() OVER (PARTITION BY CAST(right(file_id, 8) AS BIGINT) % 3 ORDER BY file_id) - 1 AS position FROM docs),
fold AS (SELECT run, file_id, position, n AS held, 0 AS batch_no FROM runs WHERE position = 0
  UNION ALL SELECT r.run, r.file_id, r.position, CASE WHEN f.held >= 10 THEN r.n ELSE f.held + r.n END, CASE WHEN f.held >= 10 THEN f.batch_no + 1 ELSE f.batch_no END
  FROM fold f JOIN runs r ON r.run = f.run AND r.position = f.position + 1)
SELECT run, file_id, position, batch_no FROM fold
""")
def _(t: Tables):
    counts = staff_index(t).groupBy("file_id").agg(F.count(F.lit(1)).alias("n"))
    number = F.right("file_id", F.lit(8)).cast("bigint")
    rows = counts.select(
        F.concat(F.lit("drive_"), (number % 3).cast("string")).alias("run"), "file_id", "n",
        F.floor(number / 3).cast("bigint").alias("position"),
    )
    return recover.document_batches(rows, "run", "position", "n", OPTS.index_batch_uris).select(
        "run", "file_id", "position", "batch_no"
    )


@query("packed_pages", "W12", """
WITH RECURSIVE p AS (SELECT * FROM v_pages_bytes), fold AS (
  SELECT doc, page_no, bytes, bytes AS held, 1 AS part FROM p WHERE page_no = 1
  UNION ALL SELECT p.doc, p.page_no, p.bytes, CASE WHEN f.held + p.bytes > 25500000 THEN p.bytes ELSE f.held + p.bytes END,
    CASE WHEN f.held + p.bytes > 25500000 THEN f.part + 1 ELSE f.part END FROM fold f JOIN p ON p.doc = f.doc AND p.page_no = f.page_no + 1),
parts AS (SELECT doc, part, sum(bytes) AS part_bytes FROM fold GROUP BY 1, 2),
docs AS (SELECT doc, sum(bytes) AS total, count(*) AS n, min_by(bytes, page_no) AS first_bytes FROM p GROUP BY 1),
wide AS (SELECT doc, max(part_bytes) AS widest FROM parts GROUP BY 1)
SELECT f.doc, f.page_no, f.bytes, CASE WHEN total <= 30000000 THEN 1 ELSE f.part END AS part_no,
  CASE WHEN total <= 30000000 THEN NULL WHEN n <= 1 THEN 'single_page_over_limit' WHEN first_bytes > 25500000 THEN 'first_page_over_target'
    WHEN widest > 30000000 THEN 'part_over_limit' END AS split_error
FROM fold f JOIN docs USING (doc) JOIN wide USING (doc)
""")
def _(t: Tables):
    return recover.pack_pages(t.v_pages_bytes, 30_000_000)
