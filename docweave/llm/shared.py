"""What the operators share: tables in the shared folder, and words of Arrow texts as numpy arrays."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (used as pa.compute)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.session import checkpoint_folder

# White space of the contracts: space and U+0009 to U+000D.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]+"

SLICE_BYTES = 1 << 20
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_STEP = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xD1342543DE82EF95)


def parked(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the folder of ``spark.checkpoint.dir`` and read it back.

    The lineage ends there, so that a lost executor repeats no work before it, and the shuffle files of
    the write are removed as it ends, not when the driver's garbage is collected.
    """
    path = f"{checkpoint_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLES_GO)
    conf.set(SHUFFLES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(SHUFFLES_GO, before)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.parked_at = path
    return table


def unparked(*tables: DataFrame) -> None:
    """Remove the files of parked tables that nothing will read again, and shuffle files as ``swept`` does."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.parked_at)
        path.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
    if tables:
        swept(tables[0])


def swept(table: DataFrame) -> DataFrame:
    """Shuffle files of finished queries go when the driver's JVM collects their plans, so it is asked to."""
    table.sparkSession._jvm.System.gc()
    return table


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def text_or_empty() -> object:
    return F.coalesce(F.col("text"), F.lit(""))


def mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser over 64-bit integers: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * _STEP)


_BYTES = _byte_values()
_LOWER = _BYTES.copy()
_LOWER[ord("A"):ord("Z") + 1] = _BYTES[ord("a"):ord("z") + 1]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    """Powers 0 to n - 1 of an odd number, or of its inverse, modulo 2 ** 64."""
    if len(_powers[kind]) < n:
        base = int(_ODD) if kind == "up" else pow(int(_ODD), -1, 1 << 64)
        factors = np.full(1 << (n - 1).bit_length(), base, dtype=np.uint64)
        factors[0] = 1
        _powers[kind] = np.multiply.accumulate(factors)
    return _powers[kind][:n]


class Texts:
    """A slice of texts as one byte array: ``data``, with ``starts`` and ``ends`` of each text."""

    def __init__(self, column: pa.Array):
        column = column.fill_null("") if column.null_count else column
        if not pa.types.is_large_string(column.type):
            column = column.cast(pa.large_string())
        offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
        base, stop = int(offsets[0]), int(offsets[-1])
        values = column.buffers()[2]
        self.data = np.frombuffer(values, np.uint8, stop - base, base) if stop > base else np.empty(0, np.uint8)
        self.starts, self.ends = offsets[:-1] - base, offsets[1:] - base

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all words, and the number of the text each is in, in order.

        A word does not reach over the end of its text, whatever byte the next one begins with.
        """
        n = len(self.data)
        inside = ~_SPACE[self.data]
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        cut = self.starts[(self.starts > 0) & (self.starts < n)]
        begins[cut] = inside[cut]
        stops[cut - 1] = inside[cut - 1]
        first, last = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        return first, last, np.searchsorted(self.ends, first, side="right")

    def prefix_hash(self, lower: bool = False) -> np.ndarray:
        """Running sums that give the hash of any range of bytes."""
        n = len(self.data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((_LOWER if lower else _BYTES)[self.data] * _power("up", n), out=sums[1:])
        return sums

    def word_hashes(self, first: np.ndarray, last: np.ndarray, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of each range, of its bytes alone."""
        return range_hashes(self.prefix_hash(lower), first, last)


def range_hashes(sums: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    down = _power("down", len(sums))
    return mixed((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64) * _STEP)


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a text column with about ``limit`` bytes each; a longer text stands alone."""
    n = len(column)
    if not n:
        return
    sizes = np.asarray(pa.compute.binary_length(column).fill_null(0), dtype=np.int64)
    begin, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if held and held + size > limit:
            yield begin, row
            begin, held = row, 0
        held += size
    yield begin, n
