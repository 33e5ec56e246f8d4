"""Hard negatives from Hilbert-ordered blocks with zone maps.

Vectors are cut to integers, sorted by label and by their place on a Hilbert curve through the
eight dimensions that vary most, and written as Parquet rows of ``BLOCK_ROWS`` vectors each. A row
holds its block's least and greatest value of every dimension and label: its zone map. Interval
arithmetic on the map bounds the inner products of an anchor with all vectors of the block, and a
block is multiplied only for anchors whose windows, or best lists so far, the bounds may still reach.

Blocks are read where they lie and never shuffled: anchors pass them in rounds of ``ROUND_ANCHORS``,
each round a bounded broadcast. A task keeps the best few of each anchor over all its blocks, and only
these are shuffled and merged. Bounds leave out what cannot be among the best, so results are exact.

Defined results: rows with a null ``vec_id`` or label, or a null, missing or non-finite component take
no part. Rows are known by ``vec_id``; of rows that share one, the least (label, vector) counts. A
shorter vector is filled with zeros, an empty one scores 0. Anchors without another row of their label,
and windows without a row, give no rows; an empty table gives none. Other columns are not read. Scores
are exact below 2 ** 50 in size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docweave.llm.shared import parked, unparked

POSITIVES, NEGATIVES = 5, 3
LOW_PERCENT, HIGH_PERCENT = 50, 95
ANCHOR_EVERY = 50
BLOCK_ROWS = 1024
ROUND_ANCHORS = 16_384
CURVE_DIMENSIONS, CURVE_BITS = 8, 8
_STRIP = 512  # anchors multiplied with a block at once


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells`` (coordinates below ``2 ** bits``)."""
    x = [c.copy() for c in cells.astype(np.uint64).T]
    top = np.uint64(1 << (bits - 1))
    bit = top
    while bit > 1:
        low = bit - np.uint64(1)
        for i in range(len(x)):
            flips = (x[i] & bit) != 0
            swap = np.where(flips, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] = np.where(flips, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
        bit >>= np.uint64(1)
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros(len(cells), np.uint64)
    bit = top
    while bit > 1:
        turn = np.where((x[-1] & bit) != 0, turn ^ (bit - np.uint64(1)), turn)
        bit >>= np.uint64(1)
    place = np.zeros(len(cells), np.uint64)
    for b in reversed(range(bits)):
        for axis in x:
            place = (place << np.uint64(1)) | (((axis ^ turn) >> np.uint64(b)) & np.uint64(1))
    return place


def taking_part(rows: DataFrame) -> DataFrame:
    """``vec_id``, ``label`` and integer ``q`` of the rows that take part, one for each ``vec_id``."""
    whole = F.col("embedding").isNotNull() & F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    moved = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label").cast("long") + 1, F.lit(10))).otherwise(
        F.col("label").cast("long")
    )
    cut = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double"))
    known = rows.filter(whole).select(F.col("vec_id").cast("long").alias("vec_id"), moved.alias("label"), cut.alias("q"))
    return known.groupBy("vec_id").agg(F.min(F.struct("label", "q")).alias("row")).select("vec_id", "row.label", "row.q")


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Vectors of a list column as rows, filled with zeros up to ``width``."""
    sizes = np.asarray(lists.value_lengths(), dtype=np.int64)
    found = np.zeros((len(lists), width))
    row = np.repeat(np.arange(len(lists)), sizes)
    found[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = np.asarray(lists.flatten())
    return found


def _spread(vectors: DataFrame) -> tuple[int, list[int], np.ndarray, np.ndarray]:
    """Number of dimensions, those that vary most, and their means and deviations."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = max(np.asarray(batch.column(0).value_lengths()), default=0)
            x = _matrix(batch.column(0), width)
            yield pa.record_batch([
                pa.array(np.arange(width)), pa.array(np.full(width, len(x))), pa.array(x.sum(axis=0)),
                pa.array((x * x).sum(axis=0)),
            ], names=["axis", "n", "total", "squares"])

    by_axis = vectors.select("q").mapInArrow(sums, "axis long, n long, total double, squares double")
    found = by_axis.groupBy("axis").agg(*(F.sum(c).alias(c) for c in ("n", "total", "squares"))).orderBy("axis").collect()
    n = max((r.n for r in found), default=1)
    mean = np.array([r.total / n for r in found])
    deviation = np.sqrt(np.maximum(np.array([r.squares / n for r in found]) - mean * mean, 0))
    axes = np.argsort(-deviation, kind="stable")[:CURVE_DIMENSIONS].tolist()
    return len(found), axes, mean[axes], deviation[axes]


def _placed(width: int, axes: list[int], mean: np.ndarray, deviation: np.ndarray):
    side = 1 << CURVE_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("q"), width)[:, axes]
            cells = np.clip((x - mean) / np.maximum(deviation, 1) * (side / 8) + side / 2, 0, side - 1)
            place = hilbert(cells, CURVE_BITS) if axes else np.zeros(len(x), np.uint64)
            yield pa.record_batch(
                [batch.column("vec_id"), batch.column("label"), batch.column("q"), pa.array((place >> np.uint64(1)).view(np.int64))],
                names=["vec_id", "label", "q", "place"],
            )

    return run


_BLOCK = (
    "block long, low array<double>, high array<double>, least_label long, greatest_label long, "
    "ids binary, labels binary, kind string, vectors binary"
)


def _packed(width: int, block_rows: int):
    """Rows of a sorted partition as blocks, each sorted by ``vec_id``."""

    def block(number: int, rows: pa.Table) -> pa.RecordBatch:
        ids, labels = np.asarray(rows.column("vec_id")), np.asarray(rows.column("label"))
        x = _matrix(rows.column("q").combine_chunks(), width)
        order = np.argsort(ids)
        ids, labels, x = ids[order], labels[order], x[order]
        kind = "i2" if np.abs(x).max(initial=0) < 1 << 15 else "f8"
        return pa.record_batch([
            pa.array([number]), pa.array([x.min(axis=0)]), pa.array([x.max(axis=0)]),
            pa.array([labels.min()]), pa.array([labels.max()]), pa.array([ids.tobytes()]), pa.array([labels.tobytes()]),
            pa.array([kind]), pa.array([x.astype(kind).tobytes()]),
        ], names=[part.split()[0] for part in _BLOCK.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held, size = [], 0
        for batch in batches:
            at = 0
            while at < len(batch):
                taken = min(block_rows - size, len(batch) - at)
                held.append(batch.slice(at, taken))
                at, size = at + taken, size + taken
                if size == block_rows:
                    yield block(number, pa.Table.from_batches(held))
                    number, held, size = number + 1, [], 0
        if size:
            yield block(number, pa.Table.from_batches(held))

    return run


def blocks_of(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, int]:
    """The table of blocks in the order of label and curve, written to the shared folder, and the dimensions."""
    vectors = parked(taking_part(rows), "vectors")
    width, axes, mean, deviation = _spread(vectors)
    placed = vectors.mapInArrow(_placed(width, axes, mean, deviation), "vec_id long, label long, q array<double>, place long")
    order = ("label", "place", "vec_id")
    packed = placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_packed(width, block_rows), _BLOCK)
    blocks = parked(packed, "blocks")
    unparked(vectors)
    return blocks, width


def reach(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest possible product of each anchor with each box, by interval arithmetic."""
    above, below = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return above @ low.T + below @ high.T, above @ high.T + below @ low.T


class Best:
    """The best ``k`` (score, id) of each slot, higher scores first, ties by smaller id."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.slot, self.id = np.empty(0, np.int64), np.empty(0, np.int64)
        self.score = np.empty(0)
        self.floor = np.full(slots, -np.inf)  # a slot's last score, once it is full

    def add(self, slot: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, ident = (np.concatenate(p) for p in ((self.slot, slot), (self.score, score), (self.id, ident)))
        order = np.lexsort((ident, -score, slot))
        slot, score, ident = slot[order], score[order], ident[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot, side="left")
        keep = rank < self.k
        self.slot, self.score, self.id = slot[keep], score[keep], ident[keep]
        full = rank[keep] == self.k - 1
        self.floor[self.slot[full]] = self.score[full]


def _columns(batch: pa.RecordBatch, row: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels, vectors = (batch.column(c)[row].as_buffer() for c in ("ids", "labels", "vectors"))
    kind = batch.column("kind")[row].as_py()
    ids = np.frombuffer(ids, np.int64)
    return ids, np.frombuffer(labels, np.int64), np.frombuffer(vectors, kind).reshape(len(ids), width).astype(np.float64)


def _boxes(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray]:
    return _matrix(batch.column("low"), width), _matrix(batch.column("high"), width)


def _found(best: Best, names: list[np.ndarray]) -> pa.RecordBatch:
    return pa.record_batch(
        [*(pa.array(n[best.slot]) for n in names), pa.array(best.id), pa.array(best.score.astype(np.int64))],
        names=[*(f"of_{i}" for i in range(len(names))), "vec_id", "score"],
    )


def _positives(sent, width: int, k: int):
    """For each anchor of the round, the best ``k`` rows of its label over the blocks of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, label, vector = sent.value
        best = Best(len(anchor), k)
        for batch in batches:
            _, upper = reach(vector, *_boxes(batch, width))
            least, most = (np.asarray(batch.column(c)) for c in ("least_label", "greatest_label"))
            for row in range(len(batch)):
                needed = np.flatnonzero((least[row] <= label) & (label <= most[row]) & (upper[:, row] >= best.floor))
                if not len(needed):
                    continue
                ids, labels, x = _columns(batch, row, width)
                for at in range(0, len(needed), _STRIP):
                    some = needed[at:at + _STRIP]
                    score = vector[some] @ x.T
                    fits = (
                        (labels[None] == label[some][:, None]) & (ids[None] != anchor[some][:, None])
                        & (score >= best.floor[some][:, None])
                    )
                    i, j = np.nonzero(fits)
                    best.add(some[i], score[i, j], ids[j])
        yield _found(best, [anchor])

    return run


def _negatives(sent, width: int, k: int):
    """For each window of the round, the best ``k`` rows of another label within it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, label, vector, first, positive, floor, ceiling = sent.value
        owner = np.repeat(np.arange(len(anchor)), np.diff(first))
        best = Best(len(positive), k)
        for batch in batches:
            lower, upper = reach(vector, *_boxes(batch, width))
            least, most = (np.asarray(batch.column(c)) for c in ("least_label", "greatest_label"))
            for row in range(len(batch)):
                bottom = np.maximum(floor, best.floor)
                open_windows = (
                    ((label[owner] != least[row]) | (label[owner] != most[row]))
                    & (upper[owner, row] >= bottom) & (lower[owner, row] <= ceiling)
                )
                windows = np.flatnonzero(open_windows)
                if not len(windows):
                    continue
                ids, labels, x = _columns(batch, row, width)
                for at in range(0, len(windows), _STRIP):
                    some = windows[at:at + _STRIP]
                    ours, back = np.unique(owner[some], return_inverse=True)
                    score = (vector[ours] @ x.T)[back]
                    fits = (
                        (score <= ceiling[some][:, None]) & (score >= bottom[some][:, None])
                        & (labels[None] != label[owner[some]][:, None])
                    )
                    i, j = np.nonzero(fits)
                    best.add(some[i], score[i, j], ids[j])
        yield _found(best, [anchor[owner], positive])

    return run


def _anchors(every: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(len(batch)):
                ids, labels, x = _columns(batch, row, width)
                own = ids % every == 0
                if own.any():
                    yield pa.record_batch(
                        [pa.array(ids[own]), pa.array(labels[own]), pa.array([v.tobytes() for v in x[own]], pa.binary())],
                        names=["anchor_id", "label", "vector"],
                    )

    return run


def _merged(found: DataFrame, of: tuple[str, ...], k: int) -> DataFrame:
    order = Window.partitionBy(*of).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    rows: DataFrame, every: int = ANCHOR_EVERY, block_rows: int = BLOCK_ROWS, round_anchors: int = ROUND_ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = rows.sparkSession
    blocks, width = blocks_of(rows, block_rows)
    anchors = parked(
        blocks.select("ids", "labels", "kind", "vectors").mapInArrow(
            _anchors(every, width), "anchor_id long, label long, vector binary"
        ), "anchors",
    )
    # The rounds are even by hash; one holds ``round_anchors`` within a few standard deviations.
    rounds = -(-anchors.count() // round_anchors)
    mined = None
    for number in range(rounds):
        ours = anchors.filter(F.pmod(F.xxhash64("anchor_id"), F.lit(rounds)) == number).toArrow().sort_by("anchor_id")
        ids, labels = (ours.column(c).to_numpy() for c in ("anchor_id", "label"))
        vectors = np.frombuffer(b"".join(ours.column("vector").to_pylist()), np.float64).reshape(len(ids), width)
        near = blocks.mapInArrow(
            _positives(spark.sparkContext.broadcast((ids, labels, vectors)), width, POSITIVES),
            "anchor_id long, vec_id long, score long",
        )
        pairs = parked(
            _merged(near, ("anchor_id",), POSITIVES).select(
                "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
            ), "positives",
        )
        held = pairs.toArrow().sort_by([("anchor_id", "ascending"), ("positive_id", "ascending")])
        owner = np.searchsorted(ids, held.column("anchor_id").to_numpy())
        score = held.column("positive_score").to_numpy()
        windows = (
            ids, labels, vectors, np.searchsorted(owner, np.arange(len(ids) + 1)), held.column("positive_id").to_numpy(),
            # Scores s with LOW * p <= 100 * s <= HIGH * p; scores are integers.
            -(-LOW_PERCENT * score // 100), HIGH_PERCENT * score // 100,
        )
        far = blocks.mapInArrow(
            _negatives(spark.sparkContext.broadcast(windows), width, NEGATIVES),
            "anchor_id long, positive_id long, vec_id long, score long",
        )
        some = parked(
            _merged(far, ("anchor_id", "positive_id"), NEGATIVES).join(pairs, ["anchor_id", "positive_id"]).select(
                "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
                F.col("score").alias("negative_score"),
            ), "mined",
        )
        mined = some if mined is None else mined.unionByName(some)
        unparked(pairs)
    unparked(blocks, anchors)
    if mined is None:
        return spark.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        )
    return mined


SQL = """
WITH k AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id AS vec_id, b.label AS label,
         CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM k a JOIN k b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score FROM scored
  WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND s.label <> p.anchor_label
 AND 100 * s.score BETWEEN 50 * p.positive_score AND 95 * p.positive_score
QUALIFY rank <= 3
"""
