"""Quality rules: counts over whole texts, and the divergence of a document from its language.

Each document has two histograms: its characters by class, and its words by common word. The
reference of a language is the sum of the histograms of all its documents that pass the base rules.
A document whose Jensen-Shannon distance (base 2, so between 0 and 1) from its reference exceeds a
limit is rejected, if it has enough words for the histogram to mean anything. Every language has a
reference: those with at least ``support`` of the documents are broadcast, at most ``1 / support``, and
the documents of the others meet theirs by a shuffle. A document without a language has its distances
from all documents together, and is not rejected by them.

Defined results: a null or blank text has no words and fails the base rules. Rows that repeat are
judged alike. An empty table gives an empty result. Columns of other names are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.shared import Texts, mixed, parked, slices

LEAST_WORDS, REPEAT_PERCENT, WINDOW = 20, 30, 8


@dataclass(frozen=True)
class QualityOptions:
    """Limits on the distances, the words a document needs to be judged by each, and the support from which a reference is broadcast."""

    char_distance: float = 0.34
    char_words: int = 50
    word_distance: float = 0.50
    word_words: int = 100
    support: float = 1e-3


# Common words of four languages.
COMMON_WORDS = (
    "the of and to in is that for it was on are as with by at be this from have or an not but "
    "der die und in den von zu das mit sich des auf ist im dem nicht ein eine als auch es an werden aus er "
    "le la les de des du un une et est que qui dans en pour pas sur au par ce il elle plus avec "
    "el los las de que y en un una por con para se no es al lo su como del más"
).split()
SYMBOLS = b"#*$%&|<>"


def _classes() -> np.ndarray:
    """Class of each byte; a byte inside a character counts for nothing."""
    table = np.full(256, 7)
    table[ord("a"):ord("z") + 1] = 0
    table[ord("A"):ord("Z") + 1] = 1
    table[ord("0"):ord("9") + 1] = 2
    table[list(b".,;:'\"()-")] = 3
    table[list(b"!?")] = 4
    table[list(SYMBOLS)] = 5
    table[0xC2:0xCC] = 6  # first byte of an accented Latin letter
    table[0xCC:0x100] = 8
    table[0x80:0xC0] = 9
    table[[0x20, *range(0x09, 0x0E)]] = 9
    return table


_CLASS = _classes()
CHAR_BINS = 9
_VOCABULARY = sorted(set(COMMON_WORDS))
WORD_BINS = len(_VOCABULARY) + 1
_TRIM = np.zeros(256, dtype=bool)
_TRIM[list(b".,;:!?'\"()-#*$%&|<>")] = True


def _vocabulary() -> tuple[np.ndarray, np.ndarray]:
    texts = Texts(pa.array(_VOCABULARY))
    first, last, owner = texts.words()
    hashes = texts.word_hashes(first, last, lower=True)
    order = np.argsort(hashes)
    return hashes[order], owner[order]


def _per_row(owner: np.ndarray, rows: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(owner, weights=weights, minlength=rows).astype(np.int64)


def _repeated(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Whether a value appears again in the same row, and whether an equal one came before."""
    order = np.lexsort((np.arange(len(hashes)), hashes, owner))
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    out = np.zeros((2, len(hashes)), bool)
    out[1, order] = same
    either = same.copy()
    either[:-1] |= same[1:]
    out[0, order] = either
    return out


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    """All counts and both histograms of a slice of texts."""
    texts, rows = Texts(column), len(column)
    first, last, owner = texts.words()
    n_words = _per_row(owner, rows)
    of_byte = np.repeat(np.arange(rows), texts.ends - texts.starts)
    kinds = _CLASS[texts.data]
    chars = np.bincount(of_byte * 10 + kinds, minlength=rows * 10).reshape(rows, 10)[:, :CHAR_BINS]

    hashes = texts.word_hashes(first, last)
    place = np.arange(len(first)) - (np.cumsum(n_words) - n_words)[owner]
    starts = np.flatnonzero(place + WINDOW <= n_words[owner])
    windows = np.zeros(len(starts), np.uint64)
    for k in range(WINDOW):
        windows = mixed(windows + hashes[starts + k] * np.uint64(2 * k + 1))
    twice = starts[_repeated(windows, owner[starts])[0]]
    cover = np.zeros(len(first) + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + WINDOW, -1)
    covered = np.cumsum(cover[:-1]) > 0

    ends = np.flatnonzero(texts.data == 0x0A)
    line_start = np.concatenate([texts.starts, ends + 1])
    line_end = np.concatenate([texts.ends, ends])
    line_start.sort()
    line_end.sort()
    with_word = np.searchsorted(first, line_start) < np.searchsorted(first, line_end)
    line_start, line_end = line_start[with_word], line_end[with_word]
    line_owner = np.searchsorted(texts.ends, line_start, side="right")
    earlier = _repeated(texts.word_hashes(line_start, line_end), line_owner)[1]

    stop = last.copy()
    for _ in range(4):
        stop -= (stop - 1 > first) & _TRIM[texts.data[stop - 1]]
    keys, bins = _vocabulary()
    folded = texts.word_hashes(first, stop, lower=True)
    at = np.minimum(np.searchsorted(keys, folded), len(keys) - 1)
    found = np.where(keys[at] == folded, bins[at], WORD_BINS - 1)
    words = np.bincount(owner * WORD_BINS + found, minlength=rows * WORD_BINS).reshape(rows, WORD_BINS)
    return {
        "n_words": n_words, "word_chars": chars.sum(axis=1), "n_symbols": chars[:, 5],
        "n_dup_lines": _per_row(line_owner, rows, earlier), "n_repeat_words": _per_row(owner, rows, covered),
        "histogram": np.concatenate([chars, words], axis=1).astype(np.int32),
    }


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
BINS = CHAR_BINS + WORD_BINS


def _arrays(table: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(
        pa.array(np.arange(len(table) + 1, dtype=np.int32) * table.shape[1]), pa.array(table.reshape(-1))
    )


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        text = batch.column("text")
        for begin, end in slices(text):
            found = measure(text.slice(begin, end - begin))
            kept = [c.slice(begin, end - begin) for name, c in zip(batch.schema.names, batch.columns, strict=True) if name != "text"]
            names = [name for name in batch.schema.names if name != "text"]
            yield pa.record_batch(
                [*kept, *(pa.array(found[c]) for c in _COUNTS), _arrays(found["histogram"])],
                names=[*names, *_COUNTS, "histogram"],
            )


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each language in a batch, those that pass the base rules, and the sums of their histograms."""
    for batch in batches:
        table = np.asarray(batch.column("histogram").flatten()).reshape(batch.num_rows, BINS).astype(np.int64)
        passed = ~np.asarray(batch.column("base_failed"))
        coded = batch.column("lang").dictionary_encode()
        codes = np.asarray(coded.indices.fill_null(len(coded.dictionary)))
        sums = np.zeros((len(coded.dictionary) + 1, BINS), np.int64)
        np.add.at(sums, codes[passed], table[passed])
        rows, good = np.bincount(codes, minlength=len(sums)), np.bincount(codes[passed], minlength=len(sums))
        yield pa.record_batch(
            [pa.array([*coded.dictionary.to_pylist(), None], pa.string()), pa.array(rows), pa.array(good), _arrays(sums)],
            names=["lang", "rows", "passed", "sums"],
        )


def references(measured: DataFrame, support: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``lang`` and the summed ``reference`` of languages with much and with little support, and the pooled sums."""
    parts = measured.select("lang", "base_failed", "histogram").mapInArrow(
        _summed, "lang string, rows long, passed long, sums array<long>"
    )
    cells = parts.select("lang", "rows", "passed", F.posexplode("sums").alias("bin", "sum"))
    totals = [F.sum(c).alias(c) for c in ("sum", "rows", "passed")]
    sums = parked(cells.groupBy("lang", "bin").agg(*totals), "references")
    whole = sums.groupBy("bin").agg(*totals)
    total = whole.agg(F.max("rows").alias("total"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("bin", "sum"))), lambda c: c["sum"])
    named = sums.filter("lang IS NOT NULL AND passed > 0").join(F.broadcast(total)).withColumn(
        "large", F.col("rows") >= F.col("total") * support
    )
    by_language = [named.filter(c).groupBy("lang").agg(ordered.alias("reference")) for c in ("large", "NOT large")]
    return *by_language, whole.agg(ordered.alias("pooled"))


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of the rows of two tables of counts; 0 where either is empty."""
    with np.errstate(divide="ignore", invalid="ignore"):
        p = p / p.sum(axis=1, keepdims=True)
        q = q / q.sum(axis=1, keepdims=True)
        m = (p + q) / 2
        parts = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
    return np.sqrt(np.clip(np.nan_to_num(parts.sum(axis=1)) / 2, 0, 1))


def _diverged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        p, q = (
            np.asarray(batch.column(c).flatten()).reshape(batch.num_rows, BINS).astype(float)
            for c in ("histogram", "reference")
        )
        kept = [(name, c) for name, c in zip(batch.schema.names, batch.columns, strict=True) if name not in ("histogram", "reference")]
        yield pa.record_batch(
            [*(c for _, c in kept), pa.array(js_distance(p[:, :CHAR_BINS], q[:, :CHAR_BINS])),
             pa.array(js_distance(p[:, CHAR_BINS:], q[:, CHAR_BINS:]))],
            names=[*(name for name, _ in kept), "char_js", "word_js"],
        )


def judged(docs: DataFrame, options: QualityOptions = QualityOptions()) -> DataFrame:
    """One row per row of ``docs``: its columns but the text, the counts, both distances, ``kept``."""
    kept = [f"{f.name} {f.dataType.simpleString()}" for f in docs.schema if f.name != "text"]
    counts = ", ".join(f"{c} long" for c in _COUNTS)
    measured = docs.mapInArrow(_measured, ", ".join([*kept, counts, "histogram array<int>"])).withColumn(
        "base_failed",
        (F.col("n_words") < LEAST_WORDS)
        | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")),
    )
    measured = parked(measured, "measured")
    large, small, pooled = references(measured, options.support)
    large, small = (
        by_language.withColumnRenamed("lang", "__lang").withColumnRenamed("reference", f"__{name}")
        for by_language, name in ((large, "large"), (small, "small"))
    )
    met = measured.join(F.broadcast(large), F.col("lang") == F.col("__lang"), "left").drop("__lang")
    rest = F.col("__large").isNull() & F.col("lang").isNotNull()  # no such language has many documents that pass
    by_broadcast = met.filter(~rest).withColumnRenamed("__large", "reference")
    by_shuffle = met.filter(rest).drop("__large").join(small, F.col("lang") == F.col("__lang"), "left").drop("__lang")
    referred = by_broadcast.unionByName(by_shuffle.withColumnRenamed("__small", "reference"))
    referred = referred.withColumn("own", F.col("reference").isNotNull()).join(F.broadcast(pooled))  # one row
    zeros = F.array_repeat(F.lit(0).cast("long"), BINS)
    referred = referred.withColumn(
        "reference", F.coalesce(F.when(F.size("reference") == BINS, F.col("reference")), F.when(F.size("pooled") == BINS, F.col("pooled")), zeros)
    ).drop("pooled")
    schema = ", ".join([*kept, counts, "base_failed boolean, own boolean, char_js double, word_js double"])
    order = [*(f.name for f in docs.schema if f.name != "text"), *_COUNTS, "base_failed", "own", "histogram", "reference"]
    rows = referred.select(*order).mapInArrow(_diverged, schema)
    far = ((F.col("n_words") >= options.char_words) & (F.col("char_js") > options.char_distance)) | (
        (F.col("n_words") >= options.word_words) & (F.col("word_js") > options.word_distance)
    )
    return rows.withColumn("kept", ~F.col("base_failed") & ~(F.col("own") & far)).drop("own")
