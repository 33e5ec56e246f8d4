"""Explicit schemas of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


S, L, B = T.StringType(), T.LongType(), T.BooleanType()
TS, STRINGS = T.TimestampType(), T.ArrayType(T.StringType())

CHANGE = _struct(
    seq=L, file_id=S, drive_id=S, name=S, mime_type=S, modified_time=S, removed=B, trashed=B,
    web_view_link=S, md5_checksum=S, size_bytes=L, parents=STRINGS,
)
# A change as it arrives: the file part may be missing, the size is text.
WIRE_CHANGE = T.StructType([
    T.StructField("seq", L), T.StructField("driveId", S), T.StructField("fileId", S),
    T.StructField("removed", B),
    T.StructField("file", _struct(
        id=S, name=S, mimeType=S, modifiedTime=S, trashed=B, md5Checksum=S, size=S,
        webViewLink=S, parents=STRINGS, driveId=S,
    )),
])
STATE = _struct(
    file_id=S, drive_id=S, name=S, mime_type=S, modified_time=S, content_hash=S, status=S,
    parse_route=S, last_synced_at=TS, error=S, source_uri=S, rag_file_id=S, path=S, bundle=S,
    audience=S,
)
# State rows as written by older or other writers: both spellings of a field may occur.
WIRE_STATE = _struct(
    fileId=S, file_id=S, driveId=S, drive_id=S, name=S, mimeType=S, mime_type=S,
    modifiedTime=S, modified_time=S, contentHash=S, content_hash=S, status=S, parseRoute=S,
    lastSyncedAt=TS, last_synced_at=TS, error=S, sourceUri=S, source_uri=S, ragFileId=S,
    rag_file_id=S, path=S, bundle=S, audience=S,
)
RETRY_QUEUE = _struct(
    file_id=S, reason=S, enqueued_at=TS, retry_count=L, last_retry_at=TS, drive_id=S, name=S,
    mime_type=S, modified_time=S, route=S, source_uri=S, size_bytes=L, path=S, bundle=S, parse_route=S,
)
SPLIT_QUEUE = _struct(
    file_id=S, reason=S, size_bytes=L, enqueued_at=TS, drive_id=S, name=S, mime_type=S,
    modified_time=S, source_uri=S, path=S, bundle=S, parse_route=S,
)
OBJECT = _struct(bucket=S, name=S)
INDEX = _struct(file_id=S, uri=S)
# Tokens and cursors of jobs; the key is a job's or drive's name.
CONTROL = _struct(file_id=S, value=S)
GOLDEN = _struct(n=L, q=S, type=S, file_id=S, name=S, bundle=S, also_accept=STRINGS)
LOG = _struct(
    event_id=L, ts=TS, service=S, severity=S, text_payload=S, json_message=S, status_message=S,
)
