"""Exact Jaccard self-join on word shingles by a partition of the hashed universe.

The plan follows the pigeonhole principle on symmetric differences. Two sets that link differ in
at most ``H`` shingles, where ``H`` follows from the largest size of their band. The universe of
shingle hashes is cut into segments; a segment with allocation 1 is met by its exact content, one
with allocation 2 also by its content less one shingle. If the allocations add up to more than
``H``, some segment of a linked pair differs by less than its allocation, so the pair shares a
signature. Each band takes the allocation with the least cost, counted in signatures and in
segments so small that unrelated documents share them. Allocations exceed ``H`` by a slack: of a
linked pair, segments of more than the slack's weight agree, so a document may leave its smallest
segments out, up to that weight, and the pair still shares a signature.

Signatures are computed, combined and grouped as numpy arrays that Spark shuffles by hash bucket.
Members of a signature meet its pivots, the least and the largest set id, not each other. Members
that are still in different components meet in a second step, in blocks of bounded size. Before a
pair is verified on the whole sets, histograms of both over 128 classes of shingles are compared:
their L1 distance is never more than the symmetric difference, so no link is lost. Histograms are
made with the signatures; whole sets are made again, from texts, for members of pairs that they let pass.
These sets do not travel with every pair, whose number may grow with the square of a group: pairs that
hang together are one group, cut into blocks of bounded bytes, and a set goes once to each pair of
blocks (a cell) that it has pairs in.

Equal sets share one id (a 64-bit fingerprint of the set), so copies are never paired.

Defined results: null and blank texts have no shingles and link with nothing; a text with fewer
words than a shingle has its whole sequence as one. Rows that repeat are linked. A null ``doc_id``
takes part, but never names a component. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from math import exp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.components import components
from docweave.llm.shared import Texts, mixed, parked, slices, swept, unparked

WIDTH, PERCENT = 4, 85
FLUSH_ENTRIES = 1 << 20
BUCKETS_PER_PARTITION = 4
SMALL_SEGMENT_COST = 50
SMALL = 3  # segments of up to so many shingles may be left out
CLASSES = 128
BLOCK_MEMBERS = 1024
PAIRS_AT_ONCE = 1 << 13  # whose histograms are compared in one step
HELD_PAIRS = 1 << 18  # that a task holds to give a pair once
BLOCK_BYTES = 1 << 24  # of whole sets in a block of a group of pairs
STEPS = 3  # from a set to the one that names its group
_SEED = np.uint64(0xA0761D6478BD642F)


@lru_cache(maxsize=256)
def band_floor(band: int, percent: int) -> int:
    """Least size in a band. A set's partners that are not smaller are in its band or the next."""
    return 1 if band == 0 else (band_floor(band - 1, percent) * 100) // percent + 1


def _floors(largest: int, percent: int) -> np.ndarray:
    floors = [1]
    while floors[-1] <= largest:
        floors.append(band_floor(len(floors), percent))
    return np.array(floors + [band_floor(len(floors), percent)], dtype=np.int64)


@lru_cache(maxsize=256)
def allocation(band: int, percent: int) -> tuple[int, int, int]:
    """Segments with allocation 1, segments with allocation 2, and the slack of a band."""
    low, high = band_floor(band, percent), band_floor(band + 1, percent) - 1
    bound = 2 * high * (100 - percent) // (100 + percent)
    if bound == 0:
        return 0, 0, 0  # only equal sets link, and those have one id
    slack = 1 + bound // 5
    need, size = bound + 1 + slack, (low + high) / 2

    def cost(twos: int) -> float:
        ones = max(need - 2 * twos, 0)
        mean = size / (ones + twos)
        small = exp(-mean) * (ones * (1 + mean) + 2 * twos * (1 + mean + mean * mean / 2))
        # Small segments that the slack lets a document leave out cost nothing.
        return ones + twos * (1 + mean) + SMALL_SEGMENT_COST * max(small - slack, 0.0)

    twos = min(range((need + 1) // 2 + 1), key=cost)
    return max(need - 2 * twos, 0), twos, slack


class Sets:
    """Distinct shingle hashes of a slice of texts: ``values`` sorted in each of the ranges ``bounds``."""

    def __init__(self, column: pa.Array, width: int):
        texts = Texts(column)
        first, last, owner = texts.words()
        words = texts.word_hashes(first, last, lower=True)
        rows = len(column)
        counts = np.bincount(owner, minlength=rows)
        place = np.arange(len(words)) - (np.cumsum(counts) - counts)[owner]
        length = np.minimum(counts, width)
        starts = np.flatnonzero(place <= counts[owner] - length[owner])
        owner = owner[starts]
        values = length[owner].astype(np.uint64) * _SEED
        for k in range(width):
            use = length[owner] > k
            at = np.minimum(starts + k, len(words) - 1)
            values = np.where(use, mixed(values + words[at] * np.uint64(2 * k + 1)), values)
        order = np.argsort(values)
        order = order[np.argsort(owner[order].astype(np.uint16 if rows <= 1 << 16 else np.uint32), kind="stable")]
        values, owner = values[order], owner[order]
        fresh = np.ones(len(values), bool)
        fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
        self.values, self.owner = values[fresh], owner[fresh]
        self.sizes = np.bincount(self.owner, minlength=rows)
        self.bounds = np.concatenate([[0], np.cumsum(self.sizes)])

    def sums(self, of: np.ndarray) -> np.ndarray:
        """Sum of a value over each set."""
        total = np.zeros(len(of) + 1, np.uint64)
        np.cumsum(of, out=total[1:])
        return total[self.bounds[1:]] - total[self.bounds[:-1]]

    def ids(self) -> np.ndarray:
        """A fingerprint of each whole set."""
        one, two = mixed(self.values ^ _SEED), mixed(self.values + _SEED)
        return mixed(self.sums(one) + mixed(self.sums(two) + self.sizes.astype(np.uint64) * _SEED))


def signatures(sets: Sets, ids: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Signature and set id of all entries of a slice."""
    floors = _floors(int(sets.sizes.max(initial=1)), percent)
    own = np.searchsorted(floors, sets.sizes, side="right") - 1
    keys, owners = [], []
    for step in (0, 1):
        band = own + step
        plan = np.array([allocation(b, percent) for b in range(int(band.max(initial=0)) + 1)], dtype=np.int64)
        ones, twos, slack = plan[np.maximum(band, 0)].T
        segments = np.where(sets.sizes > 0, ones + twos, 0)
        base = np.cumsum(segments) - segments
        used = segments[sets.owner] > 0
        owner, values = sets.owner[used], sets.values[used]
        values = mixed(values + (band[owner].astype(np.uint64) + np.uint64(1)) * _SEED)
        local = (values >> np.uint64(16)) % segments[owner].astype(np.uint64)
        at = base[owner] + local.astype(np.int64)
        total = int(segments.sum())
        content, filled = np.zeros(total, np.uint64), np.bincount(at, minlength=total)
        np.add.at(content, at, values)
        row = np.repeat(np.arange(len(segments)), segments)
        place = np.arange(total) - base[row]
        label = mixed((band[row].astype(np.uint64) << np.uint64(32)) + place.astype(np.uint64) + _SEED)
        double = place >= ones[row]
        left_out = np.full(len(segments), -1)
        for small in range(SMALL + 1):
            weight = np.where(double, 2 * (filled - 1 <= small), filled <= small)
            fits = np.bincount(row, weights=weight, minlength=len(segments)) <= slack
            left_out = np.where(fits & (left_out == small - 1), small, left_out)
        indexed = filled > left_out[row]
        keys.append(mixed(content + label)[indexed])
        owners.append(ids[row[indexed]])
        less = double[at] & (filled[at] - 1 > left_out[owner])
        keys.append(mixed(content[at[less]] - values[less] + label[at[less]]))
        owners.append(ids[owner[less]])
    return np.concatenate(keys), np.concatenate(owners)


def _distinct(keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((owners, keys))
    keys, owners = keys[order], owners[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])
    return keys[fresh], owners[fresh]


_BLOB = pa.schema([("bucket", pa.int32()), ("kind", pa.int8()), ("data", pa.binary())])
_PARTS = "kind byte, a long, b long, c long, d long, classes binary"
_PARTS_ARROW = pa.schema([("kind", pa.int8()), *((c, pa.int64()) for c in "abcd"), ("classes", pa.binary())])
_DOC, _MEMBER = 0, 1


def _histograms(sets: Sets, rows: int) -> np.ndarray:
    """Shingles of each class in each set, as rows."""
    cell = sets.owner * CLASSES + (mixed(sets.values ^ _SEED) >> np.uint64(40)).astype(np.int64) % CLASSES
    return np.minimum(np.bincount(cell, minlength=rows * CLASSES), 255).astype(np.uint8).reshape(-1, CLASSES)


def _index(width: int, percent: int, buckets: int):
    """Documents and signatures of each task as arrays, one row per bucket."""

    def blobs(kind: int, spread: np.ndarray, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        number = (spread >> np.uint64(20)) % np.uint64(buckets)
        order = np.argsort(number, kind="stable")
        cuts = np.searchsorted(number[order], np.arange(buckets + 1, dtype=np.uint64))
        table = np.stack([c.view(np.int64) for c in columns], axis=1)[order]
        held = np.flatnonzero(cuts[1:] > cuts[:-1])
        if len(held):
            yield pa.record_batch([
                pa.array(held, pa.int32()), pa.array(np.full(len(held), kind), pa.int8()),
                pa.array([table[cuts[b]:cuts[b + 1]].tobytes() for b in held], pa.binary()),
            ], schema=_BLOB)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, owners, held = [], [], 0
        for batch in batches:
            text, doc = batch.column("text"), batch.column("doc_id")
            for begin, end in slices(text):
                sets = Sets(text.slice(begin, end - begin), width)
                ids = sets.ids()
                part = doc.slice(begin, end - begin)
                named = np.asarray(part.is_valid()).astype(np.int64)
                number = np.asarray(part.fill_null(0), dtype=np.int64)
                sizes = sets.sizes.astype(np.int64)
                classes = _histograms(sets, end - begin).view(np.int64).T
                yield from blobs(_DOC, mixed(number.view(np.uint64) ^ ids), [number, named, ids, sizes, *classes])
                key, owner = signatures(sets, ids, percent)
                keys.append(key)
                owners.append(owner)
                held += len(key)
                if held > FLUSH_ENTRIES:
                    key, owner = _distinct(np.concatenate(keys), np.concatenate(owners))
                    yield from blobs(_MEMBER, key, [key, owner])
                    keys, owners, held = [], [], 0
        if held:
            key, owner = _distinct(np.concatenate(keys), np.concatenate(owners))
            yield from blobs(_MEMBER, key, [key, owner])

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents as they are; of each bucket, the signatures of two sets or more, with their pivot."""

    def shared(parts: list[bytes]) -> Iterator[pa.RecordBatch]:
        if not parts:
            return
        table = np.frombuffer(b"".join(parts), np.uint64).reshape(-1, 2)
        key, owner = _distinct(table[:, 0], table[:, 1])
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(start, len(key)))
        least, most = np.repeat(owner[start], size), np.repeat(owner[start + size - 1], size)
        met = np.repeat(size, size) > 1
        for at in range(0, int(met.sum()), 100_000):
            rows = np.flatnonzero(met)[at:at + 100_000]
            yield pa.record_batch([
                pa.array(np.full(len(rows), _MEMBER), pa.int8()), pa.array(key[rows].view(np.int64)),
                pa.array(owner[rows].view(np.int64)), pa.array(least[rows].view(np.int64)),
                pa.array(most[rows].view(np.int64)), pa.nulls(len(rows), pa.binary()),
            ], schema=_PARTS_ARROW)

    current, parts = None, []
    for batch in batches:
        for bucket, kind, data in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if kind == _DOC:
                table = np.frombuffer(data, np.int64).reshape(-1, 4 + CLASSES // 8)
                yield pa.record_batch([
                    pa.array(np.full(len(table), _DOC), pa.int8()),
                    pa.array(table[:, 0], pa.int64(), mask=table[:, 1] == 0),
                    pa.array(table[:, 2].copy()), pa.array(table[:, 3].copy()), pa.nulls(len(table), pa.int64()),
                    pa.array([row[4:].tobytes() for row in table], pa.binary()),
                ], schema=_PARTS_ARROW)
                continue
            if bucket != current:
                yield from shared(parts)
                current, parts = bucket, []
            parts.append(data)
    yield from shared(parts)


def _sets_of(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            for begin, end in slices(text):
                sets = Sets(text.slice(begin, end - begin), width)
                yield pa.record_batch([
                    pa.array(sets.ids().view(np.int64)), pa.array(sets.sizes.astype(np.int64)),
                    pa.array([
                        sets.values[a:b].tobytes()
                        for a, b in zip(sets.bounds[:-1], sets.bounds[1:], strict=True)
                    ], pa.binary()),
                ], names=["id", "n", "items"])

    return run


def _table(column: pa.Array) -> np.ndarray:
    """Histograms of equal length as rows."""
    return np.frombuffer(b"".join(v.as_buffer() for v in column), np.uint8).reshape(-1, CLASSES)


def _may_link(n_x, n_y, x: np.ndarray, y: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Distance of the histograms of pairs, and whether they and the sizes allow a link."""
    apart = np.abs(x.astype(np.int16) - y.astype(np.int16)).sum(axis=1)
    return apart, (apart * (100 + percent) <= (n_x + n_y) * (100 - percent)) & (
        np.minimum(n_x, n_y) * 100 >= np.maximum(n_x, n_y) * percent
    )


def _likely(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_x, n_y = np.asarray(batch.column("n_x")), np.asarray(batch.column("n_y"))
            _, keep = _may_link(n_x, n_y, _table(batch.column("classes_x")), _table(batch.column("classes_y")), percent)
            yield pa.record_batch(
                [batch.column(c).filter(pa.array(keep)) for c in ("x", "y")], names=["x", "y"]
            )

    return run


def _meetings(
    ids: np.ndarray, n: np.ndarray, root: np.ndarray, side: np.ndarray, same_block: bool, percent: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of members of a cell that meet: of different roots and of sizes that allow a link, some at a time."""
    left = np.flatnonzero(side == 0)
    right = left if same_block else np.flatnonzero(side == 1)
    step = max(PAIRS_AT_ONCE // max(len(right), 1), 1)
    for at in range(0, len(left), step):
        rows = left[at:at + step, None]
        meet = (root[rows] != root[right]) & (
            np.minimum(n[rows], n[right]) * 100 >= np.maximum(n[rows], n[right]) * percent
        )
        if same_block:
            meet &= ids[rows] < ids[right]
        i, j = np.nonzero(meet)
        if len(i):
            yield left[at + i], right[j]


def _across(percent: int, nearest: bool):
    """Pairs of members of a cell (key and two blocks) that may link and have different roots.

    Members share many signatures, so a pair is found in many cells. Cells that begin with the same member
    lie side by side, and a task gives a pair it still holds only once.
    """

    def found(cell: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        ids, n, side = (np.asarray(cell.column(c)) for c in ("id", "n", "side"))
        root = np.unique(np.asarray(cell.column("root")), return_inverse=True)[1]
        classes = _table(cell.column("classes").combine_chunks())
        same_block = cell.column("low")[0].as_py() == cell.column("high")[0].as_py()
        for i, j in _meetings(ids, n, root, side, same_block, percent):
            apart, may = _may_link(n[i], n[j], classes[i], classes[j], percent)
            i, j = i[may], j[may]
            yield np.stack([np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])]), apart[may], root[i], root[j]

    def pairs(cell: pa.Table) -> Iterator[np.ndarray]:
        if not nearest:
            yield from (met for met, _, _, _ in found(cell))
            return
        # The nearest pair of each root, of those looked at so far.
        gap, best = np.full(len(cell), np.iinfo(np.int64).max), np.zeros((2, len(cell)), np.int64)
        for met, apart, *ends in found(cell):
            for of in ends:
                nearer = np.flatnonzero(apart < gap[of])
                nearer = nearer[np.argsort(-apart[nearer], kind="stable")]  # the last one written stays
                gap[of[nearer]], best[:, of[nearer]] = apart[nearer], met[:, nearer]
        yield best[:, gap < np.iinfo(np.int64).max]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty((2, 0), np.int64)]

        def kept() -> np.ndarray:
            return np.stack(_distinct(*np.concatenate(held, axis=1)))

        count = 0
        for cell in _cells(batches):
            for some in pairs(cell):
                held.append(some)
                count += some.shape[1]
                if count > HELD_PAIRS:
                    held = [kept()]
                    count = held[0].shape[1]
                    if 2 * count > HELD_PAIRS:
                        yield pa.record_batch([pa.array(c) for c in held[0]], names=["x", "y"])
                        held, count = [], 0
        if count:
            yield pa.record_batch([pa.array(c) for c in kept()], names=["x", "y"])

    return run


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each cell, of rows in the order of cells."""
    current, held = None, []
    for batch in batches:
        cells = np.stack([np.asarray(batch.column(c)) for c in ("key", "low", "high")], axis=1)
        cuts = [0, *(np.flatnonzero((cells[1:] != cells[:-1]).any(axis=1)) + 1).tolist(), len(cells)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b == a:
                continue
            cell = tuple(cells[a].tolist())
            if cell != current and held:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            current = cell
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _overlaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sizes of both sets of a pair and of what they share. A cell has sets, with items and no ``y``, and pairs."""
    for cell in _cells(batches):
        y = cell.column("y")
        held = cell.filter(y.is_null())
        sets = {
            x: np.frombuffer(v.as_buffer(), np.uint64)
            for x, v in zip(held.column("x").to_pylist(), held.column("items"), strict=True)
        }
        pairs = cell.select(["x", "y"]).filter(y.is_valid())
        for batch in pairs.to_batches(max_chunksize=10_000):
            common, left, right = [], [], []
            for one, two in zip(*(batch.column(c).to_pylist() for c in ("x", "y")), strict=True):
                both = np.concatenate([sets[one], sets[two]])
                both.sort()
                common.append(int(np.count_nonzero(both[1:] == both[:-1])))
                left.append(len(sets[one]))
                right.append(len(sets[two]))
            yield pa.record_batch([
                *batch.columns, *(pa.array(v, pa.int64()) for v in (common, left, right)),
            ], names=["x", "y", "common", "n_x", "n_y"])


def _likely_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sizes and histograms allow a link."""
    sides = {
        c: sets.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}"), F.col("classes").alias(f"classes_{c}"))
        for c in ("x", "y")
    }
    return pairs.join(sides["y"], "y").join(sides["x"], "x").mapInArrow(_likely(percent), "x long, y long")


def _grouped(pairs: DataFrame) -> DataFrame:
    """Each pair (x, y) with its group, ``key``: the least id within some steps along pairs."""
    ends = pairs.unionByName(pairs.select(F.col("y").alias("x"), F.col("x").alias("y")))
    named = ends.groupBy("x").agg(F.least("x", F.min("y")).alias("key"))
    for _ in range(STEPS - 1):
        met = ends.join(named.withColumnRenamed("x", "y"), "y").unionByName(
            named.select(F.col("x").alias("y"), "x", "key")
        )
        named = met.groupBy("x").agg(F.min("key").alias("key"))
    return pairs.join(named.withColumnRenamed("key", "key_x"), "x").join(
        named.select(F.col("x").alias("y"), F.col("key").alias("key_y")), "y"
    ).select("x", "y", F.least("key_x", "key_y").alias("key"))


def _placed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Each pair (x, y) with its cell: its group, and the blocks of the group that both sets are in."""
    grouped = _grouped(pairs)
    members = grouped.select("key", F.explode(F.array("x", "y")).alias("id")).distinct()
    blocks = members.join(sets.select("id", "n"), "id").groupBy("key").agg(
        F.ceil(F.sum("n") * 8 / BLOCK_BYTES).alias("blocks")
    )
    of = {c: F.pmod(F.xxhash64(c, F.lit(1)), F.col("blocks")).cast("int") for c in ("x", "y")}
    return grouped.join(blocks, "key").select(
        "key", F.least(of["x"], of["y"]).alias("low"), F.greatest(of["x"], of["y"]).alias("high"), "x", "y"
    )


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Each placed pair (x, y) with the sizes of its sets and of their intersection, counted on whole sets."""
    partitions = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    needed = pairs.select("key", "low", "high", F.explode(F.array("x", "y")).alias("id")).distinct()
    held = needed.join(sets.select("id", "items"), "id").select(
        "key", "low", "high", F.col("id").alias("x"), F.lit(None).cast("long").alias("y"), "items"
    )
    return (
        held.unionByName(pairs.withColumn("items", F.lit(None).cast("binary")))
        .repartition(partitions, "key", "low", "high").sortWithinPartitions("key", "low", "high")
        .mapInArrow(_overlaps, "x long, y long, common long, n_x long, n_y long")
    )


def _links(percent: int):
    return 100 * F.col("common") >= percent * (F.col("n_x") + F.col("n_y") - F.col("common"))


def _texts_of(docs: DataFrame, parts: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """The shingle sets of the wanted ids, from the text of one document of each."""
    named = (
        parts.filter(F.col("kind") == _DOC)
        .groupBy(F.col("b").alias("id")).agg(F.min("a").alias("doc"))
        .join(ids, "id", "left_semi")
        .select("doc", "id")
    )
    texts = docs.select("doc_id", "text").join(
        named, F.col("doc_id").eqNullSafe(F.col("doc")), "left_semi"
    ).select("text")
    items = texts.mapInArrow(_sets_of(width), "id long, n long, items binary")
    # Documents that share an id by number, or a missing number, may bring the same set twice.
    return swept(parked(items.dropDuplicates(["id"]), "items"))


def join(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id."""
    spark = docs.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blobs = docs.select("doc_id", "text").mapInArrow(
        _index(width, percent, partitions * BUCKETS_PER_PARTITION), "bucket int, kind byte, data binary"
    )
    parts = swept(parked(
        blobs.repartition(partitions, "bucket").sortWithinPartitions("bucket").mapInArrow(_meet, _PARTS), "signatures"
    ))
    members = parts.filter(F.col("kind") == _MEMBER).select(
        F.col("a").alias("key"), F.col("b").alias("id"), F.col("c").alias("least"), F.col("d").alias("most")
    )
    stars = swept(parked(
        members.select(F.col("id").alias("x"), F.explode(F.array_distinct(F.array("least", "most"))).alias("y"))
        .filter("x <> y").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct(),
        "pairs",
    ))
    sets = swept(parked(
        parts.filter((F.col("kind") == _DOC) & (F.col("c") > 0)).groupBy(F.col("b").alias("id")).agg(
            F.first("c").alias("n"), F.first("classes").alias("classes")
        ), "sets",
    ))

    def items(ids: DataFrame) -> DataFrame:
        return _texts_of(docs, parts, ids, width)

    linked = _linked(_likely_pairs(stars, sets, percent), items, percent)
    unparked(stars)
    roots = components(linked)
    # Two rounds join most components through their nearest members; the last looks at every pair left.
    for nearest in (True, True, False):
        more = _linked(_left_over(members, roots, sets, percent, nearest), items, percent)
        if not more.isEmpty():
            linked = linked.unionByName(more)
            roots = components(linked)
    unparked(sets)
    return _labelled(parts, roots)


def _linked(pairs: DataFrame, items: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    likely = swept(parked(pairs, "pairs"))
    sets = items(likely.select(F.explode(F.array("x", "y")).alias("id")).distinct())
    placed = parked(_placed(likely, sets), "pairs")
    unparked(likely)
    checked = _verified(placed, sets).filter(_links(percent))
    links = parked(checked.select(F.col("x").alias("a"), F.col("y").alias("b")), "links")
    unparked(placed, sets)
    return links


def _left_over(
    members: DataFrame, roots: DataFrame, sets: DataFrame, percent: int, nearest: bool
) -> DataFrame:
    """Pairs that share a signature, are in different components so far, and may link.

    With ``nearest``, only the pair with the nearest histograms of each component in a cell.

    The members of a signature are cut into blocks, and each pair of blocks is one small cell.
    """
    spark = members.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = members.select("key", "id", "least").join(
        roots.select(F.col("node").alias("id"), "root"), "id", "left"
    ).select("key", "id", "least", F.coalesce("root", "id").alias("root"))
    keys = rows.groupBy("key").agg(
        F.min("root").alias("one"), F.max("root").alias("other"), F.count(F.lit(1)).alias("size"),
        F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("members"),
    ).filter("one < other AND size > 2")  # of two members, one is the pivot
    # Signatures with the same members are one.
    keys = keys.groupBy("members", "size").agg(F.min("key").alias("key")).select(
        "key", F.ceil(F.col("size") / BLOCK_MEMBERS).cast("int").alias("blocks")
    )
    own = F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks")).cast("int")
    cells = rows.join(keys, "key").withColumn("own", own).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("met")
    ).select(
        "key", "id", "least", "root", F.least("own", "met").alias("low"), F.greatest("own", "met").alias("high"),
        (F.col("own") > F.col("met")).cast("int").alias("side"),
    )
    return (
        cells.join(sets.select("id", "n", "classes"), "id")
        .repartition(partitions, "least", "low", "high").sortWithinPartitions("least", "low", "high", "key")
        .mapInArrow(_across(percent, nearest), "x long, y long")
        .distinct()
    )


def _labelled(parts: DataFrame, roots: DataFrame) -> DataFrame:
    rows = parts.filter(F.col("kind") == _DOC).select(
        F.col("a").alias("doc_id"), F.col("b").alias("id"), F.col("c").alias("n_shingles")
    )
    sets = rows.filter("n_shingles > 0").groupBy("id").agg(F.min("doc_id").alias("least"))
    rooted = sets.join(roots.select(F.col("node").alias("id"), "root"), "id", "left").select(
        "id", "least", F.coalesce("root", "id").alias("root")
    )
    linked = rooted.join(roots.select("root").distinct(), "root", "left_semi")
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    moved = linked.join(least, "root").select("id", F.col("component_id").alias("of_links"))
    alone = rooted.join(moved, "id", "left").select("id", F.coalesce("of_links", "least").alias("component_id"))
    return rows.join(alone, "id", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS items
  FROM w
), e AS (
  SELECT doc_id, len(items) AS n, unnest(items) AS item FROM s
), held AS (
  SELECT * FROM e WHERE item IN (SELECT item FROM e GROUP BY item HAVING count(*) > 1)
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, x.n AS n_a, y.n AS n_b, count(*) AS common
  FROM held x JOIN held y ON x.item = y.item AND x.doc_id <> y.doc_id AND y.n * 100 >= x.n * 85 AND x.n * 100 >= y.n * 85
  GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs WHERE 100 * common >= 85 * (n_a + n_b - common)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT r.doc_id, max(len(s.items)) AS n_shingles, min(r.other) AS component_id
FROM reach r JOIN s ON s.doc_id = r.doc_id GROUP BY r.doc_id
"""
