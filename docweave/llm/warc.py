"""WARC files and their audit with Merkle trees.

Records are built from columns and written by Spark's text writer, gzipped, one file per shard. A
replica keeps the shards. The audit reads the files of both replicas back, splits them by their
``Content-Length`` and hashes each record. Records of a shard in the order of their offsets are the
leaves of a tree whose inner nodes each hash a range of ``FANOUT`` nodes below. The roots of the two
replicas are compared, and only children of nodes that differ are looked at, level by level, down to
the records.

A shard has about ``SHARD_BYTES``, so that a task holds one file; a longer record stands alone.

Defined results: a null page is an empty payload, a null address an empty one, and line ends in an
address are escaped. Rows that repeat are records of their own. A record that one replica lacks
shifts those behind it in its shard, and all of them count as damaged. An empty table gives an empty
result.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.llm.shared import parked
from docweave.session import checkpoint_folder

SHARD_BYTES = 16 << 20
FANOUT = 16
DATE = "2024-01-01T00:00:00Z"
_LINE = "\r\n"


def record(page_id: Column, url: Column, html: Column) -> Column:
    """The text of a record without its last line end, which the writer adds."""
    body = F.coalesce(html, F.lit(""))
    address = F.replace(F.replace(F.coalesce(url, F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(
        F.lit(f"WARC/1.0{_LINE}WARC-Type: resource{_LINE}WARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(f">{_LINE}WARC-Date: {DATE}{_LINE}WARC-Target-URI: "), address,
        F.lit(f"{_LINE}Content-Type: text/html; charset=utf-8{_LINE}Content-Length: "), F.octet_length(body).cast("string"),
        F.lit(_LINE * 2), body, F.lit(_LINE),
    )


def _write(records: DataFrame, path: str) -> None:
    """Rows (shard, value), in order within each shard, as one file per shard."""
    records.write.partitionBy("shard").option("lineSep", _LINE).option("compression", "gzip").text(path)


def write_archive(pages: DataFrame, path: str) -> None:
    """Write (page_id, url, html) as shards of WARC records."""
    total = pages.agg(F.sum(F.coalesce(F.octet_length("html"), F.lit(0)).cast("long") + 300)).first()[0] or 0
    shards = max(-(-total // SHARD_BYTES), 1)
    spread = F.xxhash64("page_id", "url", F.monotonically_increasing_id())
    rows = pages.select(
        F.pmod(spread, F.lit(shards)).cast("int").alias("shard"), "page_id",
        record(F.col("page_id"), F.col("url"), F.col("html")).alias("value"),
    )
    ordered = rows.repartition(shards, "shard").sortWithinPartitions("shard", F.col("page_id").asc_nulls_first(), "value")
    _write(ordered.select("shard", "value"), path)


_LENGTH = re.compile(rb"\r\nContent-Length: (\d+)\r\n")
_NAME = re.compile(rb"\r\nWARC-Record-ID: <urn:page:(-?\d*)>\r\n")


def split_records(data: bytes) -> Iterator[tuple[int, int, int | None]]:
    """Offset, length and page number of each record of a file."""
    at = 0
    while at < len(data):
        head = data.find(b"\r\n\r\n", at)
        length = _LENGTH.search(data, at, head + 2) if head >= 0 else None
        if length is None:
            yield at, len(data) - at, None
            return
        end = min(head + 4 + int(length[1]) + 4, len(data))
        name = _NAME.search(data, at, head + 2)
        yield at, end - at, int(name[1]) if name and name[1] else None
        at = end


_ROWS = "shard int, leaf long, offset long, n_bytes long, page_id long"


def _files(spark, path: str) -> DataFrame:
    shard = F.regexp_extract("path", r"/shard=(\d+)/", 1).cast("int").alias("shard")
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "*.gz"
    ).load(path).select(shard, "content")


def _rows_of(batch: pa.RecordBatch, last: str, value) -> Iterator[pa.RecordBatch]:
    for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content"), strict=True):
        data = gzip.decompress(content.as_buffer())
        places = list(split_records(data))
        for start in range(0, len(places), 256):
            part = places[start:start + 256]
            yield pa.record_batch([
                pa.array([shard] * len(part), pa.int32()), pa.array(range(start, start + len(part)), pa.int64()),
                *(pa.array([p[k] for p in part], pa.int64()) for k in range(3)),
                pa.array([value(data[o:o + n]) for o, n, _ in part], pa.string()),
            ], names=["shard", "leaf", "offset", "n_bytes", "page_id", last])


def leaves(spark, path: str) -> DataFrame:
    """One row per record of an archive, with the digest of its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _rows_of(batch, "sha256", lambda b: hashlib.sha256(b).hexdigest())

    return _files(spark, path).mapInArrow(run, f"{_ROWS}, sha256 string")


def replicate(spark, source: str, target: str, change: Column | None = None) -> None:
    """Copy an archive shard by shard. ``change`` may alter ``value`` on the way, as a failing disk would."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _rows_of(batch, "value", lambda b: b[:-2].decode())

    rows = _files(spark, source).mapInArrow(run, f"{_ROWS}, value string")
    rows = rows.withColumn("value", change) if change is not None else rows
    _write(rows.sortWithinPartitions("shard", "leaf").select("shard", "value"), target)


def tree(records: DataFrame) -> tuple[DataFrame, int]:
    """All nodes (shard, level, node, digest) above and with the records, and the highest level."""
    largest = records.agg(F.max("leaf")).first()[0] or 0
    height = 0
    while FANOUT**height <= largest:
        height += 1
    level = records.select("shard", F.lit(0).alias("level"), F.col("leaf").alias("node"), F.col("sha256").alias("digest"))
    every = [level]
    for number in range(1, height + 1):
        below = F.transform(F.array_sort(F.collect_list(F.struct("node", "digest"))), lambda c: c["digest"])
        level = (
            level.groupBy("shard", F.floor(F.col("node") / FANOUT).alias("up"))  # at most FANOUT rows a group
            .agg(F.sha2(F.concat_ws("", below), 256).alias("digest"))
            .select("shard", F.lit(number).alias("level"), F.col("up").alias("node"), "digest")
        )
        every.append(level)
    nodes = every[0]
    for more in every[1:]:
        nodes = nodes.unionByName(more)
    return nodes, height


def differing(one: DataFrame, two: DataFrame, height: int) -> DataFrame:
    """Leaves (shard, node) that differ between two trees, found from the roots down."""
    branch = None
    for number in range(height, -1, -1):
        sides = []
        for nodes, name in ((one, "x"), (two, "y")):
            level = nodes.filter(F.col("level") == number).select("shard", "node", F.col("digest").alias(name))
            if branch is not None:
                level = level.withColumn("up", F.floor(F.col("node") / FANOUT)).join(
                    branch.withColumnRenamed("node", "up"), ["shard", "up"], "left_semi"
                )
            sides.append(level.select("shard", "node", name))
        branch = parked(
            sides[0].join(sides[1], ["shard", "node"], "full").filter(~F.col("x").eqNullSafe(F.col("y"))).select("shard", "node"),
            "branches",
        )
    return branch


def audit(spark, original: str, replica: str) -> DataFrame:
    """One row per record of the original: its place, digest, and whether the replica agrees."""
    records = parked(leaves(spark, original), "leaves")
    others = parked(leaves(spark, replica), "leaves")
    (one, height), (two, other) = tree(records), tree(others)
    top = max(height, other)
    damaged = differing(parked(one, "tree"), parked(two, "tree"), top).select(
        "shard", F.col("node").alias("leaf"), F.lit(True).alias("damaged")
    )
    return records.join(damaged, ["shard", "leaf"], "left").withColumn("intact", F.col("damaged").isNull()).drop("damaged")


# Of the audited replica, one record in 256 has a letter of its head replaced.
DAMAGE = "00"


def damage(page_id: Column, value: Column) -> Column:
    struck = F.substring(F.md5(F.coalesce(page_id.cast("string"), F.lit(""))), 1, 2) == DAMAGE
    return F.when(struck, F.replace(value, F.lit("text/html; charset"), F.lit("text/htm1; charset"))).otherwise(value)


def audited(pages: DataFrame) -> DataFrame:
    """Write pages, replicate them with damage, and audit the replica."""
    spark = pages.sparkSession
    base = f"{checkpoint_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archive(pages.select("page_id", "url", "html"), f"{base}/original")
    replicate(spark, f"{base}/original", f"{base}/replica", damage(F.col("page_id"), F.col("value")))
    return audit(spark, f"{base}/original", f"{base}/replica").select("page_id", "n_bytes", "sha256", "intact")


SQL = r"""
WITH r AS (
  SELECT page_id, 'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
    || 'WARC-Record-ID: <urn:page:' || coalesce(page_id::VARCHAR, '') || '>' || chr(13) || chr(10)
    || 'WARC-Date: 2024-01-01T00:00:00Z' || chr(13) || chr(10) || 'WARC-Target-URI: '
    || replace(replace(coalesce(url, ''), chr(13), '%0D'), chr(10), '%0A') || chr(13) || chr(10)
    || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) || 'Content-Length: '
    || octet_length(encode(coalesce(html, '')))::VARCHAR || chr(13) || chr(10) || chr(13) || chr(10)
    || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
  FROM pages
)
SELECT page_id, octet_length(encode(record)) AS n_bytes, sha256(record) AS sha256,
       substr(md5(coalesce(page_id::VARCHAR, '')), 1, 2) <> '00' AS intact
FROM r
"""
