"""Near duplicates from bottom-k sketches of one hash function.

A sketch holds the ``K`` least shingle hashes of a document, or all of them. The ``K`` least hashes of
the union of two sets are found in their two sketches; the share of them that both hold estimates the
Jaccard similarity. Of a linked pair, both hold at least ``floor_of(percent)`` of them but with
probability ``RISK``; where both whole sets are retained, the bound is exact.

Inverted lists of retained values generate the overlaps. A pair that shares ``c`` of ``K`` values shares
one of the rarest ``K - c + 1`` of either sketch, so only those are listed: a common shingle, as of a
passage that a third of all documents hold, is counted but not listed. Lists are split by bands of set
sizes. Members of a list meet its two pivots (least and largest id). Members still in different
components then meet in blocks, a pair only in the first of the lists that both are in: overlaps are
counted from the lists within the block, the union sketch
leaves pairs out, and whole sets of what is left are compared there, skipping pairs that are joined
already, so a block of ``m`` members sends at most ``m - 1`` links. Every link is confirmed on whole sets.

Equal sets share one id (a 64-bit fingerprint) and are never paired. Defined results: null and blank
texts have no shingles and link with nothing; a text with fewer words than a shingle has its whole
sequence as one. Rows that repeat are linked. A null ``doc_id`` takes part, but never names a component;
its row is kept, as is a row without a component of another name. Other columns are not read. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.components import components
from docweave.llm.ngram_join import Sets
from docweave.llm.shared import parked, slices, unparked

WIDTH, PERCENT = 2, 80
K = 96
RISK = 1e-10
BLOCK_MEMBERS = 1024
_FILL = np.uint32(0xFFFFFFFF)


@lru_cache(maxsize=64)
def floor_of(percent: int, k: int = K, risk: float = RISK) -> int:
    """The most shared values that a linked pair misses with a probability of at most ``risk``.

    Sampling without replacement is closer to its mean than the binomial tail used here.
    """
    p, below = percent / 100, 0.0
    for c in range(k + 1):
        below += comb(k, c) * p**c * (1 - p) ** (k - c)
        if below > risk:
            return c
    return k


def listed(n: int, percent: int, k: int = K) -> int:
    """How many of the rarest retained values of a set of ``n`` shingles are listed."""
    least = -(-n * percent // 100)  # what it shares with any partner
    largest = n * 100 // percent  # of any union
    if least == n == largest:
        return 0  # only equal sets link
    return n - least + 1 if largest <= k else min(n, k) - floor_of(percent, k) + 1


def _sketches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, doc = batch.column("text"), batch.column("doc_id")
            for begin, end in slices(text):
                sets = Sets(text.slice(begin, end - begin), width)
                ids = sets.ids()
                first = np.zeros(len(ids), bool)
                first[np.unique(ids, return_index=True)[1]] = True
                kept = np.where(first, np.minimum(sets.sizes, K), 0)
                at = np.repeat(sets.bounds[:-1] - np.cumsum(kept) + kept, kept) + np.arange(kept.sum())
                sketch = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(kept)]), pa.int32()), pa.array(sets.values[at].view(np.int64))
                )
                yield pa.record_batch(
                    [doc.slice(begin, end - begin), pa.array(ids.view(np.int64)), pa.array(sets.sizes.astype(np.int64)), sketch],
                    names=["doc_id", "id", "n", "sketch"],
                )

    return run


def _whole_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            for begin, end in slices(text):
                sets = Sets(text.slice(begin, end - begin), width)
                yield pa.record_batch([
                    pa.array(sets.ids().view(np.int64)),
                    pa.array([sets.values[a:b].tobytes() for a, b in zip(sets.bounds[:-1], sets.bounds[1:], strict=True)], pa.binary()),
                ], names=["id", "items"])

    return run


def _rows(sketches: pa.Array) -> np.ndarray:
    """Short sketches as rows of a matrix, filled up with the greatest value."""
    sizes = np.asarray(sketches.value_lengths(), dtype=np.int64)
    found = np.full((len(sketches), K), _FILL)
    row = np.repeat(np.arange(len(sketches)), sizes)
    found[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = np.asarray(sketches.flatten()).view(np.uint32)
    return found


def may_link(n_x, n_y, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Whether sizes and union sketch of each pair of rows allow a link.

    Sketches are given by the upper halves of their values: equal halves of different values can only
    raise the estimate.
    """
    both = np.concatenate([x, y], axis=1)
    both.sort(axis=1)
    same = (both[:, 1:] == both[:, :-1]) & (both[:, 1:] != _FILL)
    fresh = np.concatenate([np.ones((len(both), 1), bool), ~same], axis=1) & (both != _FILL)
    rank = np.cumsum(fresh, axis=1)
    common = (same & (rank[:, 1:] <= K)).sum(axis=1)
    union = np.minimum(rank[:, -1], K)
    whole = (n_x <= K) & (n_y <= K)
    every, all_shared = rank[:, -1], same.sum(axis=1)
    likely = np.where(whole, 100 * all_shared >= percent * every, common >= np.where(union < K, 0, floor_of(percent)))
    return likely & (100 * np.minimum(n_x, n_y) >= percent * np.maximum(n_x, n_y))


def _likely(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_x, n_y = np.asarray(batch.column("n_x")), np.asarray(batch.column("n_y"))
            keep = may_link(n_x, n_y, _rows(batch.column("sketch_x")), _rows(batch.column("sketch_y")), percent)
            yield pa.record_batch([batch.column(c).filter(pa.array(keep)) for c in ("x", "y")], names=["x", "y"])

    return run


def _shared(x: np.ndarray, y: np.ndarray) -> int:
    both = np.concatenate([x, y])
    both.sort()
    return int(np.count_nonzero(both[1:] == both[:-1]))


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    common = _shared(x, y)
    return 100 * common >= percent * (len(x) + len(y) - common)


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [
                _linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent)
                for x, y in zip(batch.column("one"), batch.column("two"), strict=True)
            ]
            yield pa.record_batch([batch.column(c).filter(pa.array(keep, pa.bool_())) for c in ("x", "y")], names=["a", "b"])

    return run


# Members of a list that are still apart


def meetings(ids: np.ndarray, root: np.ndarray, side: np.ndarray, minor: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each member of side 0 with the members of side 1 it is to meet: of other roots, and two minor ones once."""
    for i in np.flatnonzero(side == 0).tolist():
        yield i, np.flatnonzero((side == 1) & (root != root[i]) & (~minor | (ids > ids[i])))


class Shared:
    """Inverted lists of values of members, given in the order of members."""

    def __init__(self, member: np.ndarray, values: np.ndarray, n: int):
        self.of = np.concatenate([[0], np.cumsum(np.bincount(member, minlength=n))])
        order = np.argsort(values, kind="stable")
        values, self.member = values[order], member[order]
        start = np.flatnonzero(np.append(True, values[1:] != values[:-1]))[: len(values)]
        self.begin, self.end = start, np.append(start[1:], len(values))
        slot = np.empty(len(values), np.int64)
        slot[order] = np.repeat(np.arange(len(start)), self.end - self.begin)
        self.slots, self.n = slot, n

    def count(self, i: int) -> np.ndarray:
        """How many values each member shares with ``i``."""
        lists = [self.member[self.begin[v]:self.end[v]] for v in self.slots[self.of[i]:self.of[i + 1]]]
        return np.bincount(np.concatenate(lists), minlength=self.n) if lists else np.zeros(self.n, np.int64)


class Overlaps(Shared):
    """The values that members of a cell retain."""

    def __init__(self, sketch: np.ndarray):
        kept = sketch != _FILL
        super().__init__(np.nonzero(kept)[0], sketch[kept], len(sketch))


def earlier(cell: pa.Table) -> Shared:
    """Lists before that of the cell: members who share one have met there."""
    keys = cell.column("keys").combine_chunks()
    member = np.repeat(np.arange(len(cell)), np.asarray(keys.value_lengths(), dtype=np.int64))
    values = np.asarray(keys.flatten())
    before = values < cell.column("key")[0].as_py()
    return Shared(member[before], values[before], len(cell))


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of each cell (key, low, high) of a sorted partition."""
    current, held = None, []
    for batch in batches:
        cells = np.stack([np.asarray(batch.column(c)) for c in ("key", "low", "high")], axis=1)
        cuts = [0, *(np.flatnonzero((cells[1:] != cells[:-1]).any(axis=1)) + 1).tolist(), len(cells)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b == a:
                continue
            cell = tuple(cells[a].tolist())
            if cell != current and held:
                yield pa.Table.from_batches(held)
                held = []
            current = cell
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


_CELL = ("key", "low", "high", "id", "root", "side", "minor", "keys", "n", "sketch")


def _suspects(percent: int):
    """Members with a partner of another root that overlap, sizes and union sketch allow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _cells(batches):
            ids, root, side, minor, n = (np.asarray(cell.column(c)) for c in ("id", "root", "side", "minor", "n"))
            sketch = _rows(cell.column("sketch").combine_chunks())
            overlaps, met = Overlaps(sketch), earlier(cell)
            found = np.zeros(len(n), bool)
            for i, at in meetings(ids, root, side, minor):
                if len(at):
                    at = at[met.count(i)[at] == 0]
                at = at[100 * np.minimum(n[at], n[i]) >= percent * np.maximum(n[at], n[i])]
                if not len(at):
                    continue
                at = at[overlaps.count(i)[at] >= np.where(np.minimum(n[at], n[i]) <= K, 1, floor_of(percent))]
                if len(at):
                    at = at[may_link(n[i], n[at], np.broadcast_to(sketch[i], (len(at), K)), sketch[at], percent)]
                    found[at] = True
                    found[i] |= len(at) > 0
            if found.any():
                yield pa.record_batch([cell.column(c).filter(pa.array(found)).combine_chunks() for c in _CELL], names=list(_CELL))

    return run


def _settled(percent: int):
    """Links that join the components of a cell, by exact comparison of the whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _cells(batches):
            ids, side, minor, n = (np.asarray(cell.column(c)) for c in ("id", "side", "minor", "n"))
            root = np.unique(np.asarray(cell.column("root")), return_inverse=True)[1]
            sketch = _rows(cell.column("sketch").combine_chunks())
            items = [np.frombuffer(v.as_buffer(), np.uint64) for v in cell.column("items").combine_chunks()]
            met, links = earlier(cell), []
            for i in np.flatnonzero(side == 0).tolist():
                at = np.flatnonzero((side == 1) & (root != root[i]) & (~minor | (ids > ids[i])))
                if len(at):
                    at = at[met.count(i)[at] == 0]
                if len(at):
                    at = at[may_link(n[i], n[at], np.broadcast_to(sketch[i], (len(at), K)), sketch[at], percent)]
                for j in at.tolist():
                    if root[i] != root[j] and _linked(items[i], items[j], percent):
                        root[root == root[j]] = root[i]
                        links.append((ids[i], ids[j]))
            x, y = np.array(links, np.int64).reshape(-1, 2).T
            yield pa.record_batch([pa.array(x.copy()), pa.array(y.copy())], names=["a", "b"])

    return run


def _left_over(members: DataFrame, roots: DataFrame, sketches: DataFrame) -> DataFrame:
    """Cells of the lists with members of several roots.

    Members of the root that most have (major) need not meet each other. So a cell is a block of minor
    members (side 0) and a block of all (side 1), and where a list has few minor ones, each of the many
    others goes to one cell.
    """
    rows = members.join(roots.select(F.col("node").alias("id"), "root"), "id", "left").select(
        "key", "id", F.coalesce("root", "id").alias("root")
    )
    counts = rows.groupBy("key", "root").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("members")
    )
    keys = counts.groupBy("key").agg(
        F.max_by("root", F.struct("n", "root")).alias("major"), F.max("n").alias("most"), F.sum("n").alias("size"),
        F.sum("members").alias("members"),
    ).filter("most < size AND size > 3")  # among three, two are pivots

    def blocks(n):
        return F.ceil(n / BLOCK_MEMBERS).cast("int")

    # Lists with the same members are one.
    keys = keys.groupBy("members", "size").agg(F.min(F.struct("key", "major", "most")).alias("k")).select(
        "k.key", "k.major", blocks(F.col("size")).alias("blocks"), blocks(F.col("size") - F.col("k.most")).alias("minor_blocks")
    )
    minor = F.col("root") != F.col("major")

    def own(salt: int, of: str):
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.col(of)).cast("int")

    def place(low, high, side: int):
        return F.struct(low.alias("low"), high.alias("high"), F.lit(side).alias("side"))

    met = F.transform(F.sequence(F.lit(0), F.col("minor_blocks") - 1), lambda low: place(low, own(1, "blocks"), 1))
    asks = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda high: place(own(2, "minor_blocks"), high, 0))
    kept = rows.join(keys, "key")
    cells = kept.select("key", "id", "root", minor.alias("minor"), F.inline(
        F.when(minor, F.concat(met, asks)).otherwise(met)
    ))
    own_keys = kept.groupBy("id").agg(F.collect_list("key").alias("keys"))
    return cells.join(own_keys, "id").join(sketches.select("id", "n", "sketch"), "id").select(*_CELL)


def _in_cells(rows: DataFrame, run, schema: str) -> DataFrame:
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cell = ("key", "low", "high")
    return rows.repartition(partitions, *cell).sortWithinPartitions(*cell, "id").mapInArrow(run, schema)


def lists(sketches: DataFrame, percent: int) -> DataFrame:
    """``key``, ``id``, ``n``: lists of the rarest retained values, by band of set sizes, with two members or more."""
    entries = sketches.select("id", "n", F.explode("sketch").alias("value"))
    often = entries.groupBy("value").agg(F.count(F.lit(1)).alias("often")).filter("often > 1")
    # Values of one document only come first in its order and list nothing.
    counted = entries.join(often, "value").groupBy("id", "n").agg(
        F.sort_array(F.collect_list(F.struct("often", "value"))).alias("values")
    )
    reach = F.array(*(F.lit(listed(n, percent)) for n in range(K + 1)))
    most = F.when(F.col("n") <= K, F.get(reach, F.col("n").cast("int"))).otherwise(listed(100 * K, percent))
    alone = F.least(F.col("n"), F.lit(K)) - F.size("values")
    rare = counted.select("id", "n", F.slice("values", 1, F.greatest(most - alone, F.lit(0)).cast("int")).alias("values"))
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100 / percent)) + 1e-9).cast("int")
    split = rare.select("id", "n", F.explode("values.value").alias("value"), band.alias("own")).select(
        "id", "n", "value", F.explode(F.array("own", F.col("own") + 1)).alias("band")
    )
    members = split.select(F.xxhash64("value", "band").alias("key"), "id", "n")
    least, most_of = (f(F.struct("id", "n")) for f in (F.min, F.max))
    ends = members.groupBy("key").agg(least.alias("least"), most_of.alias("most")).filter("least.id < most.id")
    return members.join(ends, "key")


def _stars(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) of members with the pivots of their lists, of sizes that allow a link."""
    met = members.select("id", "n", F.explode(F.array("least", "most")).alias("pivot"))
    fits = 100 * F.least("n", "pivot.n") >= percent * F.greatest("n", "pivot.n")
    return met.filter(fits & (F.col("id") != F.col("pivot.id"))).select(
        F.least("id", "pivot.id").alias("x"), F.greatest("id", "pivot.id").alias("y")
    ).distinct()


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    found = parked(docs.select("doc_id", "text").mapInArrow(
        _sketches(width), "doc_id long, id long, n long, sketch array<long>"
    ), "sketches")
    rows = parked(found.select("doc_id", "id", "n"), "documents")
    whole = parked(found.filter("size(sketch) > 0").groupBy("id").agg(
        F.first("n").alias("n"), F.first("sketch").alias("sketch")
    ), "whole-sketches")
    unparked(found)
    members = parked(lists(whole, percent), "lists")
    # Halves keep the order as unsigned numbers.
    upper = F.transform("sketch", lambda v: F.shiftright(v, 32).cast("int"))
    sketches = parked(whole.select("id", "n", upper.alias("sketch")), "short-sketches")
    unparked(whole)
    sides = {c: sketches.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}")) for c in "xy"}
    likely = parked(
        _stars(members, percent).join(sides["y"], "y").join(sides["x"], "x").mapInArrow(_likely(percent), "x long, y long"), "likely"
    )
    roots = components(_exact(docs, rows, likely, width, percent))
    cells = parked(_in_cells(
        _left_over(members.select("key", "id"), roots, sketches), _suspects(percent),
        "key long, low int, high int, id long, root long, side int, minor boolean, keys array<long>, n long, sketch array<int>",
    ), "cells")
    unparked(members, sketches, likely)
    more = _exact_links(docs, rows, cells, width, percent)
    if not more.isEmpty():
        roots = components(more.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))
    unparked(cells, more)
    return _labelled(rows, roots)


def _items(docs: DataFrame, rows: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """Whole sets of the wanted ids, from the text of one document of each."""
    named = rows.groupBy("id").agg(F.min("doc_id").alias("doc")).join(ids, "id", "left_semi").select("doc")
    texts = docs.select("doc_id", "text").join(named, F.col("doc_id").eqNullSafe(F.col("doc")), "left_semi").select("text")
    return texts.mapInArrow(_whole_sets(width), "id long, items binary").dropDuplicates(["id"])


def _exact(docs: DataFrame, rows: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (x, y) that link, as ``a``, ``b``."""
    ids = pairs.select(F.explode(F.array("x", "y")).alias("id")).distinct()
    items = parked(_items(docs, rows, ids, width), "items")
    one, two = (items.select(F.col("id").alias(c), F.col("items").alias(name)) for c, name in (("x", "one"), ("y", "two")))
    joined = pairs.join(two, "y").join(one, "x").select("x", "y", "one", "two")
    links = parked(joined.mapInArrow(_confirmed(percent), "a long, b long"), "links")
    unparked(items)
    return links


def _exact_links(docs: DataFrame, rows: DataFrame, cells: DataFrame, width: int, percent: int) -> DataFrame:
    items = _items(docs, rows, cells.select("id").distinct(), width)
    return parked(_in_cells(cells.join(items, "id"), _settled(percent), "a long, b long"), "links")


def _labelled(rows: DataFrame, roots: DataFrame) -> DataFrame:
    least = rows.filter("n > 0").groupBy("id").agg(F.min("doc_id").alias("least"))
    rooted = least.join(roots.select(F.col("node").alias("id"), "root"), "id", "left").select(
        "id", "least", F.coalesce("root", "id").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of = rooted.join(names, "root").select("id", F.col("component_id").alias("found"))
    named = F.when(F.col("n") > 0, F.col("found")).otherwise(F.col("doc_id"))
    return rows.join(of, "id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), named.alias("component_id"),
        (named.isNull() | F.col("doc_id").isNull() | (F.col("doc_id") == named)).alias("kept"),
    )


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 2 THEN [ws[1]]
    ELSE list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) END AS items
  FROM w
), e AS (
  SELECT doc_id, len(items) AS n, unnest(items) AS item FROM s
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, x.n AS n_a, y.n AS n_b, count(*) AS common
  FROM e x JOIN e y ON x.item = y.item AND x.doc_id <> y.doc_id AND y.n * 100 >= x.n * 80 AND x.n * 100 >= y.n * 80
  GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs WHERE 100 * common >= 80 * (n_a + n_b - common)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
)
SELECT r.doc_id, max(len(s.items)) AS n_shingles, min(r.other) AS component_id, r.doc_id = min(r.other) AS kept
FROM reach r JOIN s ON s.doc_id = r.doc_id GROUP BY r.doc_id
"""
