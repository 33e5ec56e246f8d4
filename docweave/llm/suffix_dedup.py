"""Repeated byte strings by merged Burrows-Wheeler transforms.

Every byte that a string of ``LENGTH`` bytes covers goes, if that string also starts earlier, in a
document with a smaller ``doc_id`` or before it in the same one.

Starts of equal strings are brought together first. The least hash of a string's ``GRAM``-byte
substrings is its minimizer, and consecutive starts with one minimizer are a segment. Segments of
equal content are found by a digest: the first stays, the starts of the others all repeat. Only
first segments whose minimizer other content shares, or that may repeat inside themselves, need
their suffixes compared. These meet in buckets of bounded size by minimizer.

In a bucket, segments are dealt to shards, each of which sorts the suffixes of its own and has a
Burrows-Wheeler transform. The shards are merged without sorting suffixes again: the interleave of
their rows is refined by stable sorts of the merged transform, of four symbols at first and then of
as many as the intervals so far name. Rows that the steps do not separate share a prefix of as many
symbols, and rows still together after ``LENGTH`` symbols are the repeated intervals.

A minimizer with so much content that it would fill a bucket alone is not brought to one task: each
of its starts is then grouped by the hash of its string, with partial minima before the shuffle.

Defined results: a null or empty text has no bytes. Rows that repeat both ``doc_id`` and text are one
document and get equal results; rows that repeat a ``doc_id`` alone are in the order of a hash of
their texts. A null ``doc_id`` comes first. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.shared import Texts, mixed, parked, range_hashes, slices

LENGTH, GRAM = 100, 48
WIDTH = LENGTH - GRAM + 1  # grams in a string
BUCKET_BYTES = 2 << 20
SHARDS = 2
HEAD = 5  # symbols that the sort of a shard begins with
FLUSH_SEGMENTS = 1 << 19
_END = 0xFF  # no byte of UTF-8


def _slide(values: np.ndarray, width: int, best) -> np.ndarray:
    """Least or largest value of each window, by doubling."""
    reach = 1
    while reach * 2 <= width:
        values = best(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return best(values[:len(values) - rest], values[rest:]) if rest else values


class Segments:
    """Runs of starts with one minimizer in a slice of texts."""

    def __init__(self, column: pa.Array):
        texts = self.texts = Texts(column)
        n = len(texts.data)
        self.start = self.stop = np.empty(0, np.int64)
        self.key = self.digest = np.empty(0, np.uint64)
        self.owner, self.inner = np.empty(0, np.int64), np.empty(0, bool)
        if n < LENGTH:
            return
        sums = texts.prefix_hash()
        first = np.arange(n - GRAM + 1)
        grams = range_hashes(sums, first, first + GRAM)
        least = _slide(grams, WIDTH, np.minimum)
        whole = np.zeros(len(least) + 1, np.int64)
        long = texts.ends - texts.starts >= LENGTH
        np.add.at(whole, texts.starts[long], 1)
        np.add.at(whole, texts.ends[long] - LENGTH + 1, -1)
        whole = np.cumsum(whole[:-1]) > 0
        cut = np.ones(len(least), bool)
        cut[1:] = (least[1:] != least[:-1]) | (whole[1:] != whole[:-1])
        cut[texts.starts[texts.starts < len(least)]] = True
        begin = np.flatnonzero(cut)
        end = np.append(begin[1:], len(least))
        kept = whole[begin]
        self.start, self.stop = begin[kept], end[kept]
        self.key = least[self.start]
        self.owner = np.searchsorted(texts.ends, self.start, side="right")
        self.digest = range_hashes(sums, self.start, self.stop + LENGTH - 1)
        self.inner = self._inner(grams, np.where(whole, least, np.uint64(0)))

    def _inner(self, grams: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Whether the minimizer is at two places of a segment, as it is if a string repeats in it."""
        edge = np.zeros(WIDTH - 1, np.uint64)
        most = _slide(np.concatenate([edge, least, edge]), WIDTH, np.maximum)
        places = np.flatnonzero(grams == most)
        low = np.searchsorted(places, self.start)
        high = np.searchsorted(places, self.stop - 1 + WIDTH)
        sizes = high - low
        segment = np.repeat(np.arange(len(sizes)), sizes)
        at = np.arange(len(segment)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[segment]
        same = grams[places[at]] == self.key[segment]
        return np.bincount(segment, weights=same, minlength=len(sizes)) > 1


_ENTRY = np.dtype([
    ("key", "<u8"), ("digest", "<u8"), ("doc", "<i8"), ("mark", "<i8"), ("named", "u1"), ("inner", "u1"),
    ("start", "<u4"), ("count", "<u4"),
])
_BLOBS = "bucket int, data binary"
_FOUND = "kind byte, key long, doc_id long, mark long, start int, count int"
_REPEATED, _MIXED = 0, 1


def _first_of_equal(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries in the order of content and place, and which are the first of their content."""
    order = np.lexsort((table["start"], table["mark"], table["doc"], table["named"], table["digest"], table["key"]))
    table = table[order]
    fresh = np.ones(len(table), bool)
    fresh[1:] = (table["digest"][1:] != table["digest"][:-1]) | (table["key"][1:] != table["key"][:-1])
    return table, fresh


def _rows(kind: int, table: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([
        pa.array(np.full(len(table), kind, np.int8)), pa.array(np.ascontiguousarray(table["key"]).view(np.int64)),
        pa.array(np.ascontiguousarray(table["doc"]), mask=table["named"] == 0),
        pa.array(np.ascontiguousarray(table["mark"])),
        pa.array(table["start"].astype(np.int32)), pa.array(table["count"].astype(np.int32)),
    ], names=["kind", "key", "doc_id", "mark", "start", "count"])


def _entries(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(tables: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            table = np.concatenate(tables)
            number = ((table["key"] >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(number, kind="stable")
            table, cuts = table[order], np.searchsorted(number[order], np.arange(buckets + 1))
            held = np.flatnonzero(cuts[1:] > cuts[:-1])
            if len(held):
                yield pa.record_batch([
                    pa.array(held, pa.int32()), pa.array([table[cuts[b]:cuts[b + 1]].tobytes() for b in held], pa.binary()),
                ], names=["bucket", "data"])

        tables, held = [], 0
        for batch in batches:
            text, doc = batch.column("text"), batch.column("doc_id")
            marks = np.asarray(batch.column("mark"), dtype=np.int64)
            for begin, end in slices(text):
                found = Segments(text.slice(begin, end - begin))
                table = np.zeros(len(found.start), _ENTRY)
                part = doc.slice(begin, end - begin)
                table["key"], table["digest"], table["inner"] = found.key, found.digest, found.inner
                table["doc"] = np.asarray(part.fill_null(0), dtype=np.int64)[found.owner]
                table["named"] = np.asarray(part.is_valid())[found.owner]
                table["mark"] = marks[begin:end][found.owner]
                table["start"] = found.start - found.texts.starts[found.owner]
                table["count"] = found.stop - found.start
                tables.append(table)
                held += len(table)
                if held > FLUSH_SEGMENTS:
                    yield from flush(tables)
                    tables, held = [], 0
        if tables:
            yield from flush(tables)

    return run


def _same_content(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments that repeat an earlier one, and first segments whose suffixes must be compared."""

    def of_bucket(parts: list[bytes]) -> Iterator[pa.RecordBatch]:
        table, fresh = _first_of_equal(np.frombuffer(b"".join(parts), _ENTRY))
        # A row that repeats doc_id and text brings the same segments again.
        again = np.zeros(len(table), bool)
        again[1:] = (table[["key", "digest", "doc", "mark", "named", "start"]][1:] == table[["key", "digest", "doc", "mark", "named", "start"]][:-1])
        later, kept = table[~fresh & ~again], table[fresh]
        change = np.ones(len(kept), bool)
        change[1:] = kept["key"][1:] != kept["key"][:-1]
        sizes = np.diff(np.append(np.flatnonzero(change), len(kept)))
        shared = np.repeat(sizes, sizes) > 1
        for kind, rows in ((_REPEATED, later), (_MIXED, kept[shared | (kept["inner"] > 0)])):
            for at in range(0, len(rows), 50_000):
                yield _rows(kind, rows[at:at + 50_000])

    current, parts = None, []
    for batch in batches:
        for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("data").to_pylist(), strict=True):
            if bucket != current and parts:
                yield from of_bucket(parts)
                parts = []
            current = bucket
            parts.append(data)
    if parts:
        yield from of_bucket(parts)


def _stable_order(key: np.ndarray) -> np.ndarray:
    """Stable order of unsigned numbers. Number and place are sorted as one where both fit in 64 bits."""
    bits = np.uint64(len(key).bit_length())
    if not len(key) or int(key.max()).bit_length() + int(bits) > 64:
        return np.argsort(key, kind="stable")
    both = key.astype(np.uint64) << bits | np.arange(len(key), dtype=np.uint64)
    both.sort()
    return (both & ((np.uint64(1) << bits) - np.uint64(1))).view(np.int64)


def _sorted_rows(data: np.ndarray) -> np.ndarray:
    """Places of one shard's bytes in the order of the ``LENGTH`` symbols that follow.

    The first ``HEAD`` symbols are one key; then the order is refined by doubling.
    """
    padded = np.append(data, np.zeros(HEAD - 1, np.uint8)).astype(np.uint64)
    key = np.zeros(len(data), np.uint64)
    for k in range(HEAD):
        key = key << np.uint64(8) | padded[k:k + len(data)]
    reach = HEAD
    while True:
        order = _stable_order(key)
        ranked = key[order]
        step = np.zeros(len(key), np.uint64)
        step[1:] = np.cumsum(ranked[1:] != ranked[:-1])
        rank = np.empty(len(key), np.uint64)
        rank[order] = step
        if reach >= LENGTH:
            return order
        ahead = np.zeros(len(key), np.uint64)
        ahead[:-reach] = rank[reach:] + np.uint64(1)
        key = rank * np.uint64(len(key) + 2) + ahead
        reach *= 2


class _Shard:
    """A shard with the transforms of its rows: names of some symbols before each, around the string that it is in."""

    def __init__(self, data: np.ndarray, order: np.ndarray):
        self.order = order
        ends = np.flatnonzero(data == _END)
        begins = np.append(0, ends[:-1] + 1)
        sizes = ends - begins + 1
        self.begin, self.size = np.repeat(begins, sizes)[order], np.repeat(sizes, sizes)[order]
        following = np.arange(1, len(data) + 1)
        following[ends] = begins
        two = data.astype(np.uint32) << np.uint32(8) | data[following]
        self.names = {4: two << np.uint32(16) | two[following[following]]}

    def transform(self, width: int) -> np.ndarray:
        before = self.order - width
        wrapped = before < self.begin
        before[wrapped] = ((before - self.begin) % self.size + self.begin)[wrapped]
        return self.names[width][before]

    def name(self, width: int, interval: np.ndarray) -> None:
        names = np.empty(len(self.order), np.uint32)
        names[self.order] = interval
        self.names[width] = names


def merge(shards: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Merge shards given as (bytes, sorted places) of strings that each end with ``_END``.

    A stable sort of the merged transforms by one symbol is a step of refinement; one by several symbols is
    as many steps. The first steps take four symbols. Intervals of rows that share a number of symbols then
    name these symbols, so that a later step takes as many at once. Returns, for the merged rows, the row in the
    concatenated shards and the number of the interval of rows with the same first ``LENGTH`` symbols.
    """
    held = [_Shard(data, order) for data, order in shards]
    interleave = np.repeat(np.arange(len(held), dtype=np.uint8), [len(shard.order) for shard in held])
    interval = np.zeros(len(interleave), np.uint32)
    merged = np.empty(len(interleave), np.uint32)
    reach = 0
    while reach < LENGTH:
        width = max(w for w in held[0].names if w <= LENGTH - reach)
        for number, shard in enumerate(held):
            merged[interleave == number] = shard.transform(width)
        order = _stable_order(merged)
        interleave, symbols, last = interleave[order], merged[order], interval[order]
        step = np.zeros(len(order), np.uint32)
        step[1:] = (symbols[1:] != symbols[:-1]) | (last[1:] != last[:-1])
        interval = np.cumsum(step, dtype=np.uint32)
        reach += width
        if reach not in held[0].names and 2 * reach <= LENGTH:
            for number, shard in enumerate(held):
                shard.name(reach, interval[interleave == number])
    at = np.empty(len(interleave), np.int64)
    at[np.argsort(interleave, kind="stable")] = np.arange(len(at))
    return at, interval


def repeated_starts(strings: list[bytes], counts: np.ndarray) -> list[np.ndarray]:
    """Of strings in the order of their places, the starts whose ``LENGTH`` bytes start earlier."""
    groups = [np.arange(k, len(strings), SHARDS) for k in range(SHARDS) if k < len(strings)]
    shards, owners, offsets = [], [], []
    for group in groups:
        data = np.frombuffer(b"".join(strings[i] + bytes([_END]) for i in group), np.uint8)
        order = _sorted_rows(data)
        sizes = np.array([len(strings[i]) + 1 for i in group])
        owner = np.repeat(group, sizes)
        offset = np.arange(len(data)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        shards.append((data, order))
        owners.append(owner[order])
        offsets.append(offset[order])
    at, interval = merge(shards)
    owner, offset = np.concatenate(owners)[at], np.concatenate(offsets)[at]
    valid = offset < counts[owner]
    owner, offset, interval = owner[valid], offset[valid], interval[valid]
    order = np.lexsort((offset, owner, interval))
    owner, offset, interval = owner[order], offset[order], interval[order]
    again = np.zeros(len(owner), bool)
    again[1:] = interval[1:] == interval[:-1]
    owner, offset = owner[again], offset[again]
    order = np.lexsort((offset, owner))
    owner, offset = owner[order], offset[order]
    cuts = np.searchsorted(owner, np.arange(len(strings) + 1))
    return [offset[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _runs(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of consecutive numbers."""
    if not len(starts):
        return starts, starts
    cut = np.flatnonzero(np.diff(starts) != 1) + 1
    first = np.concatenate([[0], cut])
    return starts[first], np.diff(np.append(first, len(starts)))


_PIECES = "bucket int, doc_id long, mark long, start int, count int, bytes binary"


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated starts of the segments of each bucket."""

    def of_bucket(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks()
        order = pa.compute.sort_indices(
            table, sort_keys=[("named", "ascending"), ("doc_id", "ascending"), ("mark", "ascending"), ("start", "ascending")]
        )
        table = table.take(order).combine_chunks()
        # A row that repeats doc_id and text brings the same segments again.
        places = [np.asarray(table.column(c).fill_null(0)) for c in ("named", "doc_id", "mark", "start")]
        fresh = np.ones(len(table), bool)
        fresh[1:] = np.any([p[1:] != p[:-1] for p in places], axis=0)
        table = table.filter(pa.array(fresh)).combine_chunks()
        counts = np.asarray(table.column("count"))
        found = repeated_starts(table.column("bytes").to_pylist(), counts)
        row, start, count = [], [], []
        for i, starts in enumerate(found):
            a, n = _runs(starts)
            row.append(np.full(len(a), i))
            start.append(a)
            count.append(n)
        row = pa.array(np.concatenate(row))
        place = np.asarray(table.column("start"))[np.asarray(row)] + np.concatenate(start)
        return pa.record_batch([
            *(table.column(c).take(row).combine_chunks() for c in ("doc_id", "mark")),
            pa.array(place.astype(np.int32)), pa.array(np.concatenate(count).astype(np.int32)),
        ], names=["doc_id", "mark", "start", "count"])

    current, parts = None, []
    for batch in batches:
        named = batch.column("doc_id").is_valid().cast(pa.int8())
        batch = batch.append_column("named", named)
        number = np.asarray(batch.column("bucket"))
        cuts = [0, *(np.flatnonzero(number[1:] != number[:-1]) + 1).tolist(), len(number)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            if number[a] != current and parts:
                yield of_bucket(parts)
                parts = []
            current = number[a]
            parts.append(batch.slice(a, b - a))
    if parts:
        yield of_bucket(parts)


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted segments of each document."""
    for batch in batches:
        for row in range(batch.num_rows):
            data = batch.column("text")[row].as_buffer()
            wanted = batch.column("segments")[row].values
            start, count = (np.asarray(wanted.field(c)) for c in ("start", "count"))
            view, n = memoryview(data), len(wanted)
            yield pa.record_batch([
                wanted.field("bucket"), wanted.field("hot"),
                *(pa.array([batch.column(c)[row].as_py()] * n, pa.int64()) for c in ("doc_id", "mark")),
                pa.array(start), pa.array(count),
                pa.array([bytes(view[a:a + k + LENGTH - 1]) for a, k in zip(start.tolist(), count.tolist(), strict=True)], pa.binary()),
            ], names=["bucket", "hot", "doc_id", "mark", "start", "count", "bytes"])


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of every string of hot segments, with its place."""
    for batch in batches:
        for row in range(batch.num_rows):
            data = Texts(pa.array([""]))
            data.data = np.frombuffer(batch.column("bytes")[row].as_buffer(), np.uint8)
            first = np.arange(batch.column("count")[row].as_py())
            hashes = range_hashes(data.prefix_hash(), first, first + LENGTH)
            yield pa.record_batch([
                pa.array(hashes.view(np.int64)),
                *(pa.array([batch.column(c)[row].as_py()] * len(first), pa.int64()) for c in ("doc_id", "mark")),
                pa.array((first + batch.column("start")[row].as_py()).astype(np.int32)),
            ], names=["string", "doc_id", "mark", "start"])


def _hot_repeats(pieces: DataFrame) -> DataFrame:
    """Starts of hot segments that repeat, by a grouped minimum."""
    strings = parked(pieces.mapInArrow(_strings, "string long, doc_id long, mark long, start int"), "strings")
    place = F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id", "mark", "start")
    least = strings.groupBy("string").agg(F.min(place).alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return strings.withColumn("place", place).join(least, "string").filter("place <> least").select(
        "doc_id", "mark", "start", F.lit(1).alias("count")
    )


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document without the bytes that repeated strings cover."""
    for batch in batches:
        sizes, removed, spans, digests = [], [], [], []
        for text, runs in zip(batch.column("text"), batch.column("runs"), strict=True):
            data = text.as_py().encode() if text.is_valid else b""
            gone, parts, at, n_spans = 0, [], 0, 0
            if runs.is_valid:
                start = np.asarray(runs.values.field("start"), np.int64)
                stop = start + np.asarray(runs.values.field("count"), np.int64) + LENGTH - 1
                order = np.argsort(start)
                start, stop = start[order], np.maximum.accumulate(stop[order])
                first = np.flatnonzero(np.concatenate([[True], start[1:] > stop[:-1]]))
                for a, b in zip(start[first].tolist(), stop[np.append(first[1:] - 1, len(stop) - 1)].tolist(), strict=True):
                    parts.append(data[at:a])
                    gone, at, n_spans = gone + b - a, b, n_spans + 1
            parts.append(data[at:])
            sizes.append(len(data))
            removed.append(gone)
            spans.append(n_spans)
            digests.append(hashlib.sha256(b"".join(parts)).hexdigest())
        yield pa.record_batch([
            batch.column("doc_id"), *(pa.array(v, pa.int64()) for v in (sizes, removed, spans)), pa.array(digests, pa.string()),
        ], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _met(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """Documents with what was gathered for their ``doc_id`` and ``mark``."""
    named = rows.withColumnRenamed("doc_id", "__doc").withColumnRenamed("mark", "__mark")
    same = (F.col("mark") == F.col("__mark")) & F.col("doc_id").eqNullSafe(F.col("__doc"))
    return docs.join(named, same, how).drop("__doc", "__mark")


def repeats(docs: DataFrame) -> DataFrame:
    """Runs of repeated starts: doc_id, mark, start, count. ``docs`` has doc_id, text, mark."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blobs = docs.mapInArrow(_entries(partitions * 4), _BLOBS)
    found = parked(
        blobs.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(_same_content, _FOUND), "segments"
    )
    mixed_rows = found.filter(F.col("kind") == _MIXED)
    size = (F.col("count") + LENGTH).cast("long")
    total = mixed_rows.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    buckets = max(-(-total // BUCKET_BYTES), 1)
    hot = mixed_rows.groupBy("key").agg(F.sum(size).alias("size")).filter(F.col("size") > BUCKET_BYTES).select("key", F.lit(True).alias("hot"))
    wanted = mixed_rows.join(hot, "key", "left").select(
        "doc_id", "mark", F.struct(
            F.pmod("key", F.lit(buckets)).cast("int").alias("bucket"), F.coalesce("hot", F.lit(False)).alias("hot"), "start", "count"
        ).alias("segment"),
    ).groupBy("doc_id", "mark").agg(F.collect_list("segment").alias("segments"))  # bounded by the document
    pieces = parked(
        _met(docs, wanted, "inner").select("doc_id", "mark", "text", "segments").mapInArrow(
            _cut_out, "bucket int, hot boolean, doc_id long, mark long, start int, count int, bytes binary"
        ),
        "pieces",
    )
    compared = (
        pieces.filter("NOT hot").drop("hot").repartition(max(buckets, partitions), "bucket").sortWithinPartitions("bucket")
        .mapInArrow(_compared, "doc_id long, mark long, start int, count int")
    )
    earlier = found.filter(F.col("kind") == _REPEATED).select("doc_id", "mark", "start", "count")
    return earlier.unionByName(compared).unionByName(_hot_repeats(pieces.filter("hot").drop("hot", "bucket")))


def dedup(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    docs = docs.select("doc_id", "text", F.xxhash64("text").alias("mark"))
    runs = repeats(docs).groupBy("doc_id", "mark").agg(F.collect_list(F.struct("start", "count")).alias("runs"))
    return _met(docs, runs, "left").select("doc_id", "text", "runs").mapInArrow(
        _removed, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


SQL = r"""
WITH b AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), s AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS w FROM (SELECT doc_id, h, unnest(range(0, greatest(n - 99, 0))) AS i FROM b)
), r AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS k FROM s) WHERE k > 1
), g AS (
  SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM (
    SELECT doc_id, i, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 1 ELSE 0 END AS fresh FROM r)
), spans AS (
  SELECT doc_id, min(i) AS a, max(i) + 100 AS z FROM g GROUP BY doc_id, span
), pieces AS (
  SELECT p.doc_id, p.a, p.z, substr(b.h, 2 * p.before + 1, 2 * (p.a - p.before)) AS piece FROM (
    SELECT *, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans) p JOIN b USING (doc_id)
), kept AS (
  SELECT doc_id, string_agg(piece, '' ORDER BY a) AS head, max(z) AS z, sum(z - a) AS n_removed, count(*) AS n_spans
  FROM pieces GROUP BY doc_id
)
SELECT b.doc_id, b.n AS n_bytes, coalesce(k.n_removed, 0)::BIGINT AS n_removed, coalesce(k.n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(k.head, '') || substr(b.h, 2 * coalesce(k.z, 0) + 1))) AS kept_sha256
FROM b LEFT JOIN kept k USING (doc_id)
"""
