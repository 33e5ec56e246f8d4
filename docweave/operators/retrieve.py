"""Nearest chunks of many queries at once.

Blocks of queries stream past the chunks where they lie: each block, of bounded size, is broadcast, and no
chunk vector is ever shuffled. A task groups its chunk vectors around pivots. On unit vectors the distance
to a pivot and the group's radius bound, by the triangle inequality, how near a query can come to any
member, so a group is multiplied only with the queries whose best list it may still enter. A task keeps the
best ``fetch_k`` of each query; these short lists are shuffled and merged in two levels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docweave.options import SearchOptions
from docweave.session import cut_lineage

DISTANCE_DIGITS = 6
_PRODUCT_CELLS = 4_000_000
PIVOT_ROWS = 256  # about so many vectors share a pivot
_MARGIN = 2e-6  # rounding of a distance and of its bound
MERGE_LISTS = 64  # lists of a query met by the first level of the merge


class _Best:
    """The nearest chunks seen so far, at most ``keep[i]`` for query ``i``.

    Distances are compared rounded, equal ones by chunk id, so that copies of one vector are
    cut exactly and the result does not depend on the order of arrival.
    """

    def __init__(self, keep: np.ndarray):
        self.keep = keep
        self.bound = np.full(len(keep), np.inf)
        self.query = np.empty(0, dtype=np.int64)
        self.distance = np.empty(0)
        self.chunk: np.ndarray | None = None

    def add(self, query: np.ndarray, distance: np.ndarray, chunk: np.ndarray) -> None:
        if self.chunk is not None:
            query = np.concatenate([self.query, query])
            distance = np.concatenate([self.distance, distance])
            chunk = np.concatenate([self.chunk, chunk])
        order = np.lexsort((chunk, distance, query))
        query, distance, chunk = query[order], distance[order], chunk[order]
        starts = np.searchsorted(query, query, side="left")
        rank = np.arange(len(query)) - starts
        last = rank == self.keep[query] - 1
        self.bound[query[last]] = distance[last]
        kept = rank < self.keep[query]
        self.query, self.distance, self.chunk = query[kept], distance[kept], chunk[kept]


def _unit_rows(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    with np.errstate(divide="ignore", invalid="ignore"):
        return vectors / norms


def _matrix(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of an Arrow list column as a matrix, and which rows hold one."""
    valid = np.asarray(column.is_valid())
    flat = column.drop_null().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    count = int(valid.sum())
    return flat.reshape(count, -1 if count else 0), valid


def pivot_groups(unit: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Rows of each group, its pivot and its radius. Pivots are rows far apart from each other."""
    count = max(1, len(unit) // PIVOT_ROWS)
    nearest = np.full(len(unit), np.inf)
    owner = np.zeros(len(unit), dtype=np.int64)
    row = 0
    for number in range(count):
        squared = np.maximum(2.0 - 2.0 * (unit @ unit[row]), 0.0)
        closer = squared < nearest
        owner[closer], nearest[closer] = number, squared[closer]
        row = int(np.argmax(nearest))
    groups = []
    for number in np.unique(owner):
        rows = np.flatnonzero(owner == number)
        pivot = unit[rows].mean(axis=0)
        groups.append((rows, pivot, float(np.linalg.norm(unit[rows] - pivot, axis=1).max())))
    return groups


def _measure(best: _Best, queries: np.ndarray, chunks: np.ndarray, ids: np.ndarray, threshold: float) -> int:
    """Fold one batch of chunk vectors into ``best``; the number of products that bounds did not spare."""
    unit = _unit_rows(chunks)
    sound = np.isfinite(unit).all(axis=1)
    unit, ids = unit[sound], ids[sound]
    products = 0
    for rows, pivot, radius in pivot_groups(unit) if len(unit) else ():
        gap = np.maximum(np.linalg.norm(queries - pivot, axis=1) - radius, 0.0)
        # One minus the cosine is half the squared distance.
        near = np.flatnonzero(gap * gap / 2 <= np.minimum(best.bound, threshold) + _MARGIN)
        step = max(1, _PRODUCT_CELLS // len(rows))
        for lo in range(0, len(near), step):
            some = near[lo:lo + step]
            distance = np.abs(np.round(1.0 - queries[some] @ unit[rows].T, DISTANCE_DIGITS))  # no minus zero
            products += distance.size
            limit = np.minimum(best.bound[some], threshold)
            widest = int(best.keep[some].max())
            if distance.shape[1] > widest:
                limit = np.minimum(limit, np.partition(distance, widest - 1, axis=1)[:, widest - 1])
            i, j = np.nonzero(distance <= limit[:, None])
            if len(i):
                best.add(some[i], distance[i, j], ids[rows[j]])
    return products


def _ids(column: pa.Array) -> np.ndarray:
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        return np.asarray(column.to_pylist(), dtype=str)
    return column.to_numpy(zero_copy_only=False)


def nearest_chunks(queries: DataFrame, chunks: DataFrame, opts: SearchOptions) -> DataFrame:
    """Rows (query_id, chunk_id, distance, vec_rank), nearest first, ``vec_rank`` from 0.

    ``queries`` has query_id, embedding and, where it varies, fetch_k; ``chunks`` has chunk_id
    and embedding. The distance is one minus the cosine, rounded to six digits.
    """
    if "fetch_k" not in queries.columns:
        queries = queries.withColumn("fetch_k", F.lit(opts.fetch_k(None)))
    queries = queries.select("query_id", "embedding", F.col("fetch_k").cast("int"))
    chunks = chunks.select("chunk_id", "embedding")
    found = None
    for block in query_blocks(queries, opts.query_block_rows):
        near = _merged(_against(block, queries, chunks, opts))
        found = near if found is None else found.unionByName(near)
    return found


def with_chunk_fields(queries: DataFrame, chunks: DataFrame, fields: list[str], opts: SearchOptions) -> DataFrame:
    """The nearest chunks with more of their fields, read for the kept rows only.

    The kept rows are short and written first, so that the planner knows their size and lets the texts
    stay where they lie if it is small.
    """
    near = cut_lineage(nearest_chunks(queries, chunks, opts))
    return chunks.select("chunk_id", *fields).join(near, "chunk_id")


def query_blocks(queries: DataFrame, rows: int) -> Iterator[pa.Table]:
    """Queries in blocks of about ``rows``, even by hash; a batch that fits is one block."""
    head = queries.limit(rows + 1).toArrow()
    if head.num_rows <= rows:
        yield head
        return
    kept = cut_lineage(queries)
    blocks = -(-kept.count() // rows)
    for number in range(blocks):
        yield kept.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == number).toArrow()


def _merged(lists: DataFrame) -> DataFrame:
    """The first ``fetch_k`` of all lists of a query, in two levels so that no task meets all of them."""
    order = ("distance", "chunk_id")
    some = Window.partitionBy("query_id", "__some").orderBy(*order)
    every = Window.partitionBy("query_id").orderBy(*order)
    first = lists.withColumn("__some", F.floor(F.spark_partition_id() / MERGE_LISTS)).withColumn(
        "__rank", F.row_number().over(some)
    ).filter(F.col("__rank") <= F.col("fetch_k")).drop("__some", "__rank")
    ranked = first.withColumn("vec_rank", F.row_number().over(every) - 1)
    return ranked.filter(F.col("vec_rank") < F.col("fetch_k")).drop("fetch_k")


def _result_schema(queries: DataFrame, chunks: DataFrame) -> T.StructType:
    def kind(df: DataFrame, name: str) -> T.DataType:
        return T.StringType() if isinstance(df.schema[name].dataType, T.StringType) else T.LongType()

    return T.StructType([
        T.StructField("query_id", kind(queries, "query_id")),
        T.StructField("chunk_id", kind(chunks, "chunk_id")),
        T.StructField("distance", T.DoubleType()),
        T.StructField("fetch_k", T.IntegerType()),
    ])


def _threshold(opts: SearchOptions) -> float:
    return opts.distance_threshold if opts.distance_threshold > 0 else np.inf


def _emit(best: _Best, query_ids: np.ndarray, id_types: tuple[pa.DataType, pa.DataType]) -> pa.RecordBatch:
    chunk = best.chunk if best.chunk is not None else np.empty(0)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(query_ids[best.query].tolist(), type=id_types[0]),
            pa.array(chunk.tolist(), type=id_types[1]),
            pa.array(best.distance),
            pa.array(best.keep[best.query].astype(np.int32)),
        ],
        names=["query_id", "chunk_id", "distance", "fetch_k"],
    )


def _arrow_type(kind: T.DataType) -> pa.DataType:
    return pa.string() if isinstance(kind, T.StringType) else pa.int64()


def _against(head: pa.Table, queries: DataFrame, chunks: DataFrame, opts: SearchOptions) -> DataFrame:
    """The lists of a block of queries, one for each task over the chunks."""
    schema = _result_schema(queries, chunks)
    id_types = (_arrow_type(schema["query_id"].dataType), _arrow_type(schema["chunk_id"].dataType))
    table = head.combine_chunks()
    vectors = table["embedding"].combine_chunks()
    matrix, valid = _matrix(vectors)
    payload = chunks.sparkSession.sparkContext.broadcast((
        _ids(table["query_id"].combine_chunks())[valid],
        _unit_rows(matrix),
        table["fetch_k"].to_numpy()[valid],
    ))
    threshold = _threshold(opts)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, unit_queries, keep = payload.value
        best = _Best(keep)
        for batch in batches:
            vectors, valid = _matrix(batch.column("embedding"))
            if len(vectors) and len(query_ids):
                _measure(best, unit_queries, vectors, _ids(batch.column("chunk_id"))[valid], threshold)
        if best.chunk is not None:
            yield _emit(best, query_ids, id_types)

    return chunks.mapInArrow(scan, schema)
