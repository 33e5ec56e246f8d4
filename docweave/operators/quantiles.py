"""Exact order statistics of a whole column, by counting alone.

A position in the sorted order is found by refining ranges: counts of equal ranges tell which one holds
it, and that range is counted anew between its own least and greatest value, until it holds one value. A
round reads the column once and returns at most ``BINS`` counts for each position; no task sorts or holds
the values. Rows without a number are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from math import ceil, floor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.session import cut_lineage

BINS = 1024


@dataclass
class _Range:
    """Values from ``low`` to ``high``, the first at position ``start``, that hold the wanted positions."""

    low: float
    high: float
    start: int
    wanted: list[int]


def _bins(ranges: list[_Range]) -> Column:
    """Number of the range of a value and of its bin in it; NULL outside all ranges.

    A range whose width is no sound double is halved.
    """
    value = F.col("v")
    number = F.lit(None).cast("int")
    for i, r in enumerate(ranges):
        width, middle = r.high - r.low, r.low / 2 + r.high / 2
        if 1e-300 < width < float("inf"):
            bin_no = F.least(F.floor((value - r.low) / width * BINS), F.lit(BINS - 1)).cast("int")
        else:
            bin_no = (value > (middle if middle < r.high else r.low)).cast("int")
        number = F.when((value >= r.low) & (value <= r.high), i * BINS + bin_no).otherwise(number)
    return number


def order_statistics(rows: DataFrame, value: Column, wanted: Callable[[int], Iterable[int]]) -> tuple[int, dict[int, float]]:
    """How many numbers there are, and those at the wanted positions (from 0) of their sorted order."""
    number = value.cast("double")
    kept = cut_lineage(rows.select(number.alias("v")).filter("v IS NOT NULL AND NOT isnan(v)"))
    n, low, high = kept.agg(F.count(F.lit(1)), F.min("v"), F.max("v")).first()
    places = sorted({p for p in wanted(n) if 0 <= p < n}) if n else []
    found: dict[int, float] = {}
    ranges = [_Range(low, high, 0, places)] if places else []
    while ranges:
        for done in (r for r in ranges if r.low == r.high):
            found |= dict.fromkeys(done.wanted, done.low)
        ranges = [r for r in ranges if r.low < r.high]
        if not ranges:
            break
        counted = kept.withColumn("bin", _bins(ranges)).filter("bin IS NOT NULL").groupBy("bin").agg(
            F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
        ).orderBy("bin").collect()
        narrower = []
        for i, r in enumerate(ranges):
            upto = r.start
            for b in (b for b in counted if b.bin // BINS == i):
                inside = [p for p in r.wanted if upto <= p < upto + b.n]
                if inside:
                    narrower.append(_Range(b.low, b.high, upto, inside))
                upto += b.n
        ranges = narrower
    return n, found


def inclusive(n: int, p: float) -> tuple[int, int, float]:
    """Positions around ``p (n - 1)`` and the weight of the second."""
    place = p * (n - 1)
    return floor(place), ceil(place), place - floor(place)


def exclusive(n: int, p: float) -> tuple[int, int, float]:
    """Positions around ``p (n + 1) - 1``, kept among the first and last pair; the weight may leave 0..1."""
    target = (n + 1) * p
    lower = max(1, min(floor(target), n - 1))
    return lower - 1, lower, target - lower


def quantiles(
    rows: DataFrame, value: Column, asked: list[tuple[Callable[[int, float], tuple[int, int, float]], float]]
) -> list[float | None]:
    """The quantile of each (form, p), NULL where its neighbours do not exist."""
    n, found = order_statistics(rows, value, lambda n: [i for form, p in asked for i in form(n, p)[:2]])
    out: list[float | None] = []
    for form, p in asked:
        lower, upper, weight = form(n, p) if n else (-1, -1, 0.0)
        a, b = found.get(lower), found.get(upper)
        if a is None or b is None:
            out.append(None)
        elif form is inclusive:
            out.append(a if a == b else (1 - weight) * a + weight * b)
        else:
            out.append(a + (b - a) * weight)
    return out
