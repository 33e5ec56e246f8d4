"""Language-model scores by a hierarchical Pitman-Yor model.

Every word that stands before another in the training texts has a restaurant, whose customers are
the words that follow it; the end of a text stands before the first word of one. Restaurants send a
customer for each table to the one of the words, whose base is uniform over the vocabulary and one
unknown word. No word or context is left out or pooled for being rare.

Seating is sampled by Gibbs: in each sweep every restaurant unseats and reseats its customers dish by
dish, given the other's predictive probabilities; those of the last ``SAMPLES`` sweeps are averaged. A
dish with one customer has one table, so only pairs seen twice or more take part in the sweeps.

Pairs of words are counted by a shuffle of sums. A bucket holds all pairs of a rare context, or those
of its share of the words after a context with at least ``SUPPORT`` of the tokens, so that no bucket
holds more than such a share of one context. Words with that support, at most 1 / SUPPORT, are
broadcast with their tables; the others are counted by their own buckets, which answer the buckets of pairs that
name them. A text asks each bucket once for the pairs of a flush of texts, and gets their probabilities back.

A level's discount is estimated from its counts as n1 / (n1 + 2 n2), the dishes with one and two
customers. Large dishes are seated in steps of an eighth of those who sit already, so a sweep takes a number of
steps that grows with the logarithm of a count. Random numbers are seeded by sweep and bucket, so reruns agree.

Defined results: a null or blank text has only the end token. A null ``doc_id`` counts as an empty
string. Rows that repeat are scored alike. An empty table, or one without training rows, gives
counts of 0 and the uniform model.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.shared import Texts, mixed, parked, slices, unparked

SUPPORT = 4e-6
SWEEPS, SAMPLES = 4, 2
STRENGTH = 1.0
SPLIT = 4  # buckets for each partition of a shuffle: a task holds all of its bucket
FLUSH = 1 << 20  # tokens whose pairs are counted, or asked for, at once
END = np.uint64(0x5851F42D4C957F2D)
_PAIR = np.uint64(0x9E3779B97F4A7C15)


class Counted:
    """Tokens of a slice: hashes with one end per text, the token before each, and the sizes of the texts."""

    def __init__(self, column: pa.Array):
        texts, rows = Texts(column), len(column)
        first, last, owner = texts.words()
        hashes = texts.word_hashes(first, last, lower=True)
        counts = np.bincount(owner, minlength=rows)
        self.sizes = counts + 1
        at = np.cumsum(self.sizes) - 1
        self.tokens = np.full(len(hashes) + rows, END)
        keep = np.ones(len(self.tokens), bool)
        keep[at] = False
        self.tokens[keep] = hashes
        self.before = np.full(len(self.tokens), END)
        self.before[1:] = self.tokens[:-1]  # a text begins after the end of another


def _places(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys in a sorted array, and whether they are there."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


def _found(sorted_keys: np.ndarray, values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Values by key; 0 where there is none."""
    at, known = _places(sorted_keys, keys)
    return np.where(known, values[at], 0) if len(values) else np.zeros(len(keys), values.dtype)


class Alphabet:
    """Frequent words in the order of their hashes."""

    def __init__(self, words: np.ndarray, counts: np.ndarray):
        order = np.argsort(words)
        self.words, self.counts = words[order], counts[order]


def pair_hash(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mixed(before * _PAIR + word)


def _owner(alphabet: Alphabet, before: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """What names the bucket of a pair: a rare context, or the pair."""
    return np.where(_places(alphabet.words, before)[1], pairs, before)


def _number(keys: np.ndarray, buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(24)) % np.uint64(buckets)).astype(np.int64)


def _dealt(number: np.ndarray, columns: list[np.ndarray], kind: int, header: int | None = None) -> Iterator[pa.RecordBatch]:
    """8-byte columns, one after another, as one binary value for each bucket, after a header."""
    order = np.argsort(number, kind="stable")
    table = np.stack([c.view(np.int64)[order] for c in columns])
    held, begins = np.unique(number[order], return_index=True)
    ends = np.append(begins[1:], table.shape[1])
    lead = b"" if header is None else np.int64(header).tobytes()
    for at in range(0, len(held), 256):
        part = slice(at, at + 256)
        yield pa.record_batch([
            pa.array(held[part].astype(np.int64)), pa.array(np.full(len(held[part]), kind), pa.int8()),
            pa.array([lead + table[:, b:e].tobytes() for b, e in zip(begins[part], ends[part], strict=True)], pa.binary()),
        ], names=["bucket", "kind", "data"])


def _blob(buckets: int, keys: np.ndarray, columns: list[np.ndarray], kind: int) -> Iterator[pa.RecordBatch]:
    yield from _dealt(_number(keys, buckets), columns, kind)


def _one(bucket: int, kind: int, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows for one bucket, in parts."""
    for at in range(0, len(columns[0]), 200_000):
        part = [c[at:at + 200_000] for c in columns]
        yield from _dealt(np.full(len(part[0]), bucket, np.int64), part, kind)


def _table(held: dict[int, list[pa.Buffer]], kind: int, width: int) -> np.ndarray:
    """The columns of a kind as unsigned 8-byte numbers."""
    parts = [np.frombuffer(x, np.uint64).reshape(width, -1) for x in held.get(kind, [])]
    return np.concatenate([np.empty((width, 0), np.uint64), *parts], axis=1)


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of values by key."""
    unique, at = np.unique(keys, return_inverse=True)
    return unique, np.bincount(at, weights=values, minlength=len(unique)).astype(np.int64)


_BLOBS = "bucket long, kind byte, data binary"


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[int, list[pa.Buffer]]]]:
    """Each bucket and its values by kind, of rows in the order of buckets."""
    current, held = None, {}
    for batch in batches:
        values = batch.column(2)
        for row, (bucket, kind) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            if bucket != current and held:
                yield current, held
                held = {}
            current = bucket
            held.setdefault(kind, []).append(values[row].as_buffer())  # no copy
    if held:
        yield current, held


def _met(blobs: DataFrame, partitions: int) -> DataFrame:
    """Each bucket in the partition of its number: a hash of few numbers would leave partitions empty."""
    number = (F.col("bucket") % partitions).cast("int")
    return blobs.repartitionById(partitions, number).sortWithinPartitions("bucket")


def word_counts(docs: DataFrame, partitions: int) -> DataFrame:
    """Count of each word (by hash) and of the end in training texts: ``word``, ``c``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, values, held = np.empty(0, np.uint64), np.empty(0, np.int64), 0
        parts: list[np.ndarray] = []
        for batch in batches:
            for begin, end in slices(batch.column("text")):
                parts.append(Counted(batch.column("text").slice(begin, end - begin)).tokens)
                held += len(parts[-1])
                if held > 1 << 20:
                    found = np.concatenate(parts)
                    keys, values = _summed(np.concatenate([keys, found]), np.concatenate([values, np.ones(len(found), np.int64)]))
                    parts, held = [], 0
                    if len(keys) > 1 << 20:
                        yield from _blob(partitions, keys, [keys, values], 0)
                        keys, values = keys[:0], values[:0]
        if parts:
            found = np.concatenate(parts)
            keys, values = _summed(np.concatenate([keys, found]), np.concatenate([values, np.ones(len(found), np.int64)]))
        yield from _blob(partitions, keys, [keys, values], 0)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in _buckets(batches):
            words, counts = _table(held, 0, 2)
            keys, values = _summed(words, counts.view(np.int64))
            for at in range(0, len(keys), 100_000):
                part = slice(at, at + 100_000)
                yield pa.record_batch([pa.array(keys[part].view(np.int64)), pa.array(values[part])], names=["word", "c"])

    blobs = docs.filter("NOT held_out").select("text").mapInArrow(count, _BLOBS)
    return _met(blobs, partitions).mapInArrow(add, "word long, c long")


def seat(counts: np.ndarray, base: np.ndarray, tables: float | np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish of a restaurant, or of many with the tables of each dish's own, reseating dish by dish given the other dishes' tables.

    A customer opens a table by the odds of the base and of the tables there are, against those who
    sit at the dish's tables already. Dishes reseat side by side; a step seats at most an eighth of
    those who sit.
    """
    room = (STRENGTH + discount * tables) * base
    seated = np.minimum(counts, 1).astype(np.int64)
    opened = seated.copy()
    open_dishes = np.flatnonzero(seated < counts)
    while len(open_dishes):
        n, t = seated[open_dishes], opened[open_dishes]
        step = np.minimum(np.maximum(n // 8, 1), counts[open_dishes] - n)
        new = room[open_dishes]
        old = n - discount * t
        fresh = rng.binomial(step, new / (new + old))
        opened[open_dishes] += fresh
        seated[open_dishes] += step
        open_dishes = open_dishes[seated[open_dishes] < counts[open_dishes]]
    return opened


def predictive(counts: np.ndarray, tables: np.ndarray, base: np.ndarray, discount: float) -> np.ndarray:
    """Predictive probability of each dish of one restaurant."""
    below = STRENGTH + counts.sum()
    return (counts - discount * tables + (STRENGTH + discount * tables.sum()) * base) / below


def discount_of(ones: int, twos: int) -> float:
    """The usual estimate from dishes with one customer and with two."""
    return min(max((ones + 1) / (ones + 2 * twos + 2), 0.05), 0.95)


# Kinds of values. By bucket of pairs: (before, word, count) of all pairs and of those seen twice or more,
# (before, pairs seen once), (pair, tables), and answers (word, share), (word, count, share). By bucket of words:
# (word, tables) of pairs seen once and of others, (before, tables) of frequent contexts, and questions
# (word, bucket) of the sweeps and of the scores, (word, count). In bucket -1: (word, share) and (before, tables) of
# frequent ones, and totals. By flush: its texts, and (log, count) of the pairs it asked for.
PAIRS, SEATS, SINGLES, TABLES, ANSWER, LAST_ANSWER = range(6)
ONCE, SENT, ROOM, ASK, LAST_ASK, COUNT = range(6, 12)
SHARE, ROOMS, TOTALS, DISHES = range(12, 16)
TEXTS, WANTED, SCORES = range(16, 19)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[Counted], list[tuple[pa.RecordBatch, int, int]]]]:
    """Counted slices of whole texts, with the rows they are of, of about ``FLUSH`` tokens together."""
    parts, rows, held = [], [], 0
    for batch in batches:
        for begin, end in slices(batch.column("text")):
            parts.append(Counted(batch.column("text").slice(begin, end - begin)))
            rows.append((batch, begin, end))
            held += len(parts[-1].tokens)
            if held >= FLUSH:
                yield parts, rows
                parts, rows, held = [], [], 0
    if parts:
        yield parts, rows


def pair_counts(docs: DataFrame, shipped, partitions: int) -> DataFrame:
    """Values of kinds ``PAIRS`` to ``SINGLES`` and ``ONCE`` to ``LAST_ASK``, in the least seating, and ``DISHES``.

    Pairs that only held-out texts have are there with a count of 0.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts, rows in _tokens(batches):
            before, word = (np.concatenate([getattr(p, c) for p in parts]) for c in ("before", "tokens"))
            sizes = np.concatenate([p.sizes for p in parts])
            training = np.concatenate([~np.asarray(b.column("held_out").slice(i, j - i)) for b, i, j in rows])
            pairs, first, at = np.unique(pair_hash(before, word), return_index=True, return_inverse=True)
            c = np.bincount(at, weights=np.repeat(training, sizes), minlength=len(pairs)).astype(np.int64)
            order = first[np.argsort(before[first], kind="stable")]  # equal numbers together, for the codec
            c = c[at[order]]
            before, word, pairs = before[order], word[order], pairs[at[order]]
            yield from _blob(partitions, _owner(shipped.value, before, pairs), [before, word, c], PAIRS)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shipped.value.words
        for bucket, held in _buckets(batches):
            before, word, c = _table(held, PAIRS, 3)
            held.clear()
            pairs, first, at = np.unique(pair_hash(before, word), return_index=True, return_inverse=True)
            c = np.bincount(at, weights=c.view(np.int64), minlength=len(pairs)).astype(np.int64)
            order = first[np.lexsort((word[first], before[first]))]
            c = c[at[order]]
            before, word = before[order], word[order]
            yield from _one(bucket, PAIRS, [before, word, c])
            many, once = c > 1, c == 1
            yield from _one(bucket, SEATS, [before[many], word[many], c[many]])
            yield from _one(bucket, SINGLES, list(_summed(before[once], np.ones(once.sum(), np.int64))))
            for kind, keep in ((ONCE, once), (SENT, many)):
                found, n = _summed(word[keep], np.ones(keep.sum(), np.int64))
                yield from _blob(partitions, found, [found, n], kind)
            found, n = _summed(before, np.minimum(c, 1))
            found, n = (x[_places(words, found)[1]] for x in (found, n))
            yield from _blob(partitions, found, [found, n], ROOM)
            for kind, asked in ((ASK, word[many]), (LAST_ASK, word)):
                asked = np.unique(asked)
                asked = asked[~_places(words, asked)[1]]
                yield from _blob(partitions, asked, [asked, np.full(len(asked), bucket, np.int64)], kind)
            yield from _one(-1, DISHES, [np.array([once.sum()]), np.array([(c == 2).sum()])])

    return _met(docs.select("text", "held_out").mapInArrow(count, _BLOBS), partitions).mapInArrow(add, _BLOBS)


class State:
    """What a sweep leaves for all: shares of frequent words, tables of frequent contexts, and totals."""

    def __init__(self, words: np.ndarray, rows: DataFrame, vocabulary: int, discount: float):
        held: dict[int, list[bytes]] = {}
        for r in rows.filter("bucket = -1").select("kind", "data").toLocalIterator():
            held.setdefault(r["kind"], []).append(bytes(r["data"]))
        word, share = _table(held, SHARE, 2)
        order = np.argsort(word)
        self.share = _found(word[order], share[order].view(float), words)
        before, tables = _table(held, ROOMS, 2)
        order = np.argsort(before)
        self.rooms = _found(before[order], tables[order].view(np.int64), words)
        customers, self.tables = (float(x.view(np.int64).sum()) for x in _table(held, TOTALS, 2))
        self.below = STRENGTH + customers
        self.rest = (STRENGTH + discount * self.tables) / (vocabulary + 1)

    def probability(self, share: np.ndarray) -> np.ndarray:
        return (share + self.rest) / self.below


def seat_words(blobs: DataFrame, shipped, tables: float, vocabulary: int, discount: float, sweep: int, partitions: int) -> DataFrame:
    """Seat the restaurant of the words by what the contexts send, and answer those that ask for a word."""

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shipped.value.words
        for bucket, held in _buckets(batches):
            sent = np.concatenate([_table(held, k, 2) for k in (ONCE, SENT)], axis=1)
            word, c = _summed(sent[0], sent[1].view(np.int64))
            t = seat(c, np.full(len(c), 1 / (vocabulary + 1)), tables, discount, np.random.default_rng([0, sweep, bucket]))
            share = c - discount * t
            yield from _one(-1, TOTALS, [np.array([c.sum()]), np.array([t.sum()])])
            own = _places(words, word)[1]
            yield from _one(-1, SHARE, [word[own], share[own]])
            yield from _one(-1, ROOMS, list(_rooms(held)))
            asked, by = _table(held, ASK, 2)
            yield from _dealt(by.view(np.int64), [asked, _found(word, share, asked)], ANSWER)
            asked, by = _table(held, LAST_ASK, 2)
            if len(asked):
                counted, n = _table(held, COUNT, 2)
                order = np.argsort(counted)
                n = _found(counted[order], n[order].view(np.int64), asked)
                yield from _dealt(by.view(np.int64), [asked, n, _found(word, share, asked)], LAST_ANSWER)

    return _met(blobs, partitions).mapInArrow(one, _BLOBS)


def _rooms(held: dict[int, list[pa.Buffer]]) -> tuple[np.ndarray, np.ndarray]:
    before, tables = _table(held, ROOM, 2)
    return _summed(before, tables.view(np.int64))


def seat_contexts(blobs: DataFrame, shipped, state, discount: float, sweep: int, partitions: int) -> DataFrame:
    """Seat the restaurants of contexts: the tables of each pair, and their sums by word and by frequent context."""

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, now = shipped.value.words, state.value
        for bucket, held in _buckets(batches):
            before, word, c = _table(held, SEATS, 3)
            pairs = pair_hash(before, word)
            order = np.argsort(pairs)
            before, word, c, pairs = before[order], word[order], c[order].view(np.int64), pairs[order]
            answered, share = _answers(held, ANSWER, 2)
            at, own = _places(words, word)
            known = now.share[at] if len(words) else np.zeros(len(word))
            base = now.probability(np.where(own, known, _found(answered, share.view(float), word)))
            places, room = np.unique(before, return_inverse=True)
            single, ones = _table(held, SINGLES, 2)
            single, ones = _summed(single, ones.view(np.int64))
            begun = _found(single, ones, places)
            at, own = _places(words, places)
            given = now.rooms[at] if len(words) else np.zeros(len(places))
            rng, t = np.random.default_rng([1, sweep, bucket]), np.ones(len(c), np.int64)
            for _ in range(2):  # once from the least seating, once given what that seats
                tables = np.where(own, given, begun + np.bincount(room, weights=t, minlength=len(places)))
                t = seat(c, base, tables[room], discount, rng)
            yield from _one(bucket, TABLES, [pairs, t])
            found, n = _summed(word, t)
            yield from _blob(partitions, found, [found, n], SENT)
            found, n = _summed(np.concatenate([before, single]), np.concatenate([t, ones]))
            own = _places(words, found)[1]
            yield from _blob(partitions, found[own], [found[own], n[own]], ROOM)

    return _met(blobs, partitions).mapInArrow(one, _BLOBS)


def _answers(held: dict[int, list[pa.Buffer]], kind: int, width: int) -> np.ndarray:
    columns = _table(held, kind, width)
    return columns[:, np.argsort(columns[0])]


def score(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    partitions = SPLIT * int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    docs = docs.select("doc_id", "text", (F.crc32(named) % 7 == 2).alias("held_out"))

    words = parked(word_counts(docs, partitions), "words")
    total, vocabulary, ones, twos = words.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1)), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)
    ).first()
    of_word = discount_of(ones, twos)
    frequent = words.filter(F.col("c") >= F.lit(max(total * SUPPORT, 1))).toPandas()  # at most 1 / SUPPORT rows
    alphabet = Alphabet(frequent["word"].to_numpy(np.int64).view(np.uint64), frequent["c"].to_numpy(np.int64))
    shipped = spark.sparkContext.broadcast(alphabet)

    pairs = parked(pair_counts(docs, shipped, partitions), "pairs")
    dishes = [np.frombuffer(r["data"], np.int64) for r in pairs.filter(F.col("kind") == DISHES).toLocalIterator()]
    of_pair = discount_of(*(int(sum(d[i] for d in dishes)) for i in range(2)))

    def of(rows: DataFrame, *kinds: int) -> DataFrame:
        return rows.filter(F.col("kind").isin(*kinds)).select("bucket", "kind", "data")

    def ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            word = np.asarray(batch.column("word")).view(np.uint64)
            rare = ~_places(shipped.value.words, word)[1]
            yield from _blob(partitions, word[rare], [word[rare], np.asarray(batch.column("c"))[rare]], COUNT)

    counted = words.mapInArrow(ship, _BLOBS)
    seated = parked(seat_words(of(pairs, ONCE, SENT, ROOM, ASK), shipped, float(vocabulary), vocabulary, of_word, 0, partitions), "seats")
    state = State(alphabet.words, seated, vocabulary, of_word)
    samples: list[State] = []
    answers: DataFrame | None = None
    for sweep in range(1, SWEEPS + 1):
        now = spark.sparkContext.broadcast(state)
        rooms = parked(seat_contexts(of(pairs, SEATS, SINGLES).unionByName(of(seated, ANSWER)), shipped, now, of_pair, sweep, partitions), "seats")
        asked = of(pairs, ONCE, ASK).unionByName(of(rooms, SENT, ROOM))
        last, kept = seated, sweep > SWEEPS - SAMPLES
        if kept:
            asked = asked.unionByName(of(pairs, LAST_ASK)).unionByName(counted)
        seated = parked(seat_words(asked, shipped, state.tables, vocabulary, of_word, sweep, partitions), "seats")
        state = State(alphabet.words, seated, vocabulary, of_word)
        if kept:
            k = len(samples) * 32  # kinds of one sample
            found = of(rooms, TABLES).unionByName(of(seated, LAST_ANSWER)).withColumn("kind", (F.col("kind") + 32 + k).cast("byte"))
            answers = found if answers is None else answers.unionByName(found)
            samples.append(state)
        # Tables of a sweep that is not averaged are read by the next one only.
        unparked(*([] if kept else [rooms]), *([] if sweep - 1 > SWEEPS - SAMPLES else [last]))
    model = spark.sparkContext.broadcast(samples)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Texts of each flush as places in the pairs it asks for, and the pairs, by bucket."""
        task = TaskContext.get().partitionId()
        for n, (parts, rows) in enumerate(_tokens(batches)):
            before, word = (np.concatenate([getattr(p, c) for p in parts]) for c in ("before", "tokens"))
            sizes = np.concatenate([p.sizes for p in parts]).astype(np.int64)
            wanted, first, at = np.unique(pair_hash(before, word), return_index=True, return_inverse=True)
            number = _number(_owner(shipped.value, before[first], wanted), partitions)
            order = np.argsort(number, kind="stable")
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order), dtype=np.int32)
            flush = (n << 24) + task
            yield from _dealt(number, [wanted], WANTED, flush)
            ids = [b.column("doc_id").slice(i, j - i) for b, i, j in rows]
            held = [np.asarray(b.column("held_out").slice(i, j - i)).astype(np.int64) for b, i, j in rows]
            columns = [
                np.concatenate([np.asarray(x.fill_null(0), dtype=np.int64) for x in ids]),
                np.concatenate([np.asarray(x.is_null()).astype(np.int64) for x in ids]), np.concatenate(held), sizes,
            ]
            data = np.int64(len(sizes)).tobytes() + np.stack(columns).tobytes() + place[at].tobytes()
            yield pa.record_batch([
                pa.array([flush], pa.int64()), pa.array([TEXTS], pa.int8()), pa.array([data], pa.binary()),
            ], names=["bucket", "kind", "data"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Probabilities of the pairs of a bucket, sent to the flushes that want them."""
        alphabet = shipped.value
        for bucket, held in _buckets(batches):
            before, word, c = _table(held, PAIRS, 3)
            pairs = pair_hash(before, word)
            order = np.argsort(pairs)
            before, word, c, pairs = before[order], word[order], c[order].view(np.int64), pairs[order]
            at, own = _places(alphabet.words, word)
            places, room = np.unique(before, return_inverse=True)
            lead, shared = _places(alphabet.words, places)
            listed = len(alphabet.words) > 0
            customers = np.bincount(room, weights=c, minlength=len(places))
            customers = np.where(shared, alphabet.counts[lead], customers) if listed else customers
            p, seen = np.zeros(len(c)), np.zeros(len(c), np.int64)
            for k, now in enumerate(model.value):
                drawn, tables = _answers(held, TABLES + 32 * (k + 1), 2)
                t = np.where(c > 1, _found(drawn, tables.view(np.int64), pairs), np.minimum(c, 1))
                opened = np.bincount(room, weights=t, minlength=len(places))
                answered, n, share = _answers(held, LAST_ANSWER + 32 * (k + 1), 3)
                share, n = _found(answered, share.view(float), word), _found(answered, n.view(np.int64), word)
                if listed:
                    opened = np.where(shared, now.rooms[lead], opened)
                    share, n = np.where(own, now.share[at], share), np.where(own, alphabet.counts[at], n)
                rest = (STRENGTH + of_pair * opened)[room] * now.probability(share)
                p += (c - of_pair * t + rest) / (STRENGTH + customers[room])
                seen = n
            logs = np.log10(p / len(model.value))
            for data in held.get(WANTED, []):
                flush, wanted = int(np.frombuffer(data, np.int64, 1)[0]), np.frombuffer(data, np.uint64, offset=8)
                at = np.searchsorted(pairs, wanted)
                yield from _dealt(np.full(len(at), flush, np.int64), [logs[at], seen[at]], SCORES, bucket)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums over the tokens of each text of a flush."""
        for _, held in _buckets(batches):
            data = held[TEXTS][0]
            n = int(np.frombuffer(data, np.int64, 1)[0])
            doc_id, missing, held_out, sizes = np.frombuffer(data, np.int64, 4 * n, 8).reshape(4, n)
            place = np.frombuffer(data, np.int32, offset=8 + 32 * n)
            found = sorted(held[SCORES], key=lambda x: int(np.frombuffer(x, np.int64, 1)[0]))
            table = np.concatenate([np.frombuffer(x, np.int64, offset=8).reshape(2, -1) for x in found], axis=1)
            logs, seen = table[0].view(float), table[1]
            base = np.log10((seen + 1) / (total + vocabulary + 1))
            owner = np.repeat(np.arange(n), sizes)
            sums = [np.bincount(owner, weights=x[place], minlength=n) for x in (seen > 0, base, logs)]
            yield pa.record_batch([
                pa.array(doc_id, mask=missing > 0), pa.array(held_out > 0), pa.array(sizes), pa.array(sums[0].astype(np.int64)),
                pa.array(np.full(n, total, np.int64)), pa.array(sums[1]), pa.array(sums[2]),
            ], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    flushes = parked(docs.mapInArrow(read, _BLOBS), "flushes")
    found = _met(of(pairs, PAIRS).unionByName(answers).unionByName(of(flushes, WANTED)), partitions).mapInArrow(meet, _BLOBS)
    return _met(found.unionByName(of(flushes, TEXTS)), partitions).mapInArrow(
        add, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )
