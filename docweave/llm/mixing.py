"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target in words. A document of a source whose target is ``r`` times its size is
taken ``floor(r)`` times for certain. The words that remain are filled by a sample without
replacement of unequal probabilities: the odds that a document is included are a source's constant
times a weight that grows slowly with its size (``inclusion_odds``), documents are ranked by their
random odds divided by their inclusion odds, and the ranking is cut where the sizes add up to the
remainder. The sample is so of a fixed size in words, up to one document.

The cut is found by counting: the ranks are binned, the bin where the running size passes the
remainder is binned again, and so on; only sums are shuffled. A hot source is never in one task.

Random numbers are digests of ``doc_id`` and text, so reruns agree. Rows that repeat both share
their number; the cut takes all rows of equal rank or none. Null texts have size 0. A null source is a source, the last one. An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.llm.shared import SPACE_CLASS, parked

WEIGHTS = (5, 2, 1)
SHARE_PERCENT, MOST_COPIES = 150, 2
SCALE_BITS, LEVEL_BITS = 48, 12


def word_count(text: Column) -> Column:
    """Number of words, by counting the places where one begins."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_CLASS + "+", " ")
    trimmed = F.trim(marked)
    spaces = F.length(trimmed) - F.length(F.replace(trimmed, F.lit(" "), F.lit("")))
    return F.when(F.length(trimmed) == 0, 0).otherwise(spaces + 1).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = SHARE_PERCENT) -> DataFrame:
    """Targets of sources (source, source_size): shares by weight, none above its limit.

    A source whose limit is less than its share gets the limit, and the excess goes to the others by
    weight. With the sources in the order of limit over weight, those that reach their limit come
    first, so running sums find where they end. The sums run over one row per source.
    """
    place = Window.orderBy(F.col("source").isNull(), "source")
    number = (F.row_number().over(place) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (number + 1).cast("int")).cast("double")
    rows = sizes.withColumn("weight", weight).withColumn("limit", (MOST_COPIES * F.col("source_size")).cast("double"))
    upto = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source")
    everything = Window.partitionBy()
    rows = rows.select(
        "*",
        F.coalesce(F.sum("limit").over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("filled"),
        F.sum("weight").over(upto.rowsBetween(0, Window.unboundedFollowing)).alias("open"),
        (F.sum("source_size").over(everything) * percent / 100).alias("total"),
    ).withColumn("level", (F.col("total") - F.col("filled")) / F.col("open"))
    full = F.col("level") * F.col("weight") >= F.col("limit")
    level = F.max(F.when(~full, F.col("level"))).over(everything)
    return rows.select(
        "source", "source_size",
        F.when(full, F.col("limit")).otherwise(F.least(level * F.col("weight"), F.col("limit"))).alias("target"),
    )


def size_class(size: Column) -> Column:
    """Number of binary digits of a size, at most 20."""
    return F.when(size > 0, F.least(F.floor(F.log2(size.cast("double"))) + 1, F.lit(20))).otherwise(0).cast("int")


def inclusion_odds(klass: Column, constant: Column) -> Column:
    """Odds of one more copy: longer documents, which carry more context, are a little likelier."""
    return constant * (1 + klass.cast("double") / 10)


def _constants(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """Each source's constant: with it, the expected words of the sample are the remainder.

    Found by bisection on the logarithm, over the words of at most 21 size classes of a source.
    """
    classes = rows.groupBy("source", "klass").agg(F.sum("size").alias("words"))
    grouped = classes.groupBy("source").agg(F.collect_list(F.struct("klass", "words")).alias("classes"))
    joined = goals.join(grouped, F.col("__source").eqNullSafe(F.col("source"))).drop("source")

    def expected(middle: Column) -> Column:
        def add(total: Column, c: Column) -> Column:
            odds = inclusion_odds(c["klass"], F.exp(middle))
            return total + c["words"] * odds / (1 + odds)

        return F.aggregate("classes", F.lit(0.0), add)

    def halve(state: Column, _: Column) -> Column:
        middle = (state["low"] + state["high"]) / 2
        under = expected(middle) < F.col("rest")
        return F.struct(
            F.when(under, middle).otherwise(state["low"]).alias("low"),
            F.when(under, state["high"]).otherwise(middle).alias("high"),
        )

    start = F.struct(F.lit(-40.0).alias("low"), F.lit(40.0).alias("high"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(50)), start, halve)
    return joined.withColumn("constant", F.exp((found["low"] + found["high"]) / 2)).drop("classes")


def rank(rows: DataFrame) -> Column:
    """Random odds over inclusion odds, as a long that grows with the ratio."""
    uniform = (F.conv(F.substring(F.md5(F.concat_ws(":", F.col("doc_id").cast("string"), F.col("mark").cast("string"))), 1, 12), 16, 10).cast("double") + 0.5) / 2.0**48
    ratio = uniform / (1 - uniform) / inclusion_odds(F.col("klass"), F.col("constant"))
    return F.floor(ratio / (1 + ratio) * 2.0**SCALE_BITS)


def _cut(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """The least rank of each source that is not taken, by bins of ``LEVEL_BITS`` bits."""
    state = goals.select("__source", "rest", F.lit(0).cast("long").alias("bin"), F.lit(0.0).alias("before"))
    for level in range(1, SCALE_BITS // LEVEL_BITS + 1):
        shift = SCALE_BITS - level * LEVEL_BITS
        held = rows.join(state, F.col("source").eqNullSafe(F.col("__source")))
        if level > 1:
            held = held.filter(F.shiftright("rank", shift + LEVEL_BITS) == F.col("bin"))
        sums = held.groupBy("__source", "rest", "before", F.shiftright("rank", shift).alias("finer")).agg(
            F.sum("size").cast("double").alias("words")
        )
        upto = Window.partitionBy("__source").orderBy("finer").rowsBetween(Window.unboundedPreceding, 0)
        running = sums.withColumn("upto", F.col("before") + F.sum("words").over(upto))  # at most 4096 bins
        passed = running.filter(F.col("upto") > F.col("rest")).groupBy("__source").agg(
            F.min_by(F.struct("finer", (F.col("upto") - F.col("words")).alias("before"), "upto"), "finer").alias("at")
        )
        state = parked(
            state.select("__source", "rest").alias("s").join(
                passed.alias("p"), F.col("s.__source").eqNullSafe(F.col("p.__source")), "left"
            ).select(
                "s.__source", "rest",
                F.coalesce("p.at.finer", F.lit((1 << (SCALE_BITS - shift)) + 1)).alias("bin"),
                F.coalesce("p.at.before", F.lit(0.0)).alias("before"), F.col("p.at.upto").alias("upto"),
            ),
            "cuts",
        )
    # The row at the cut is taken if that brings the sum nearer to the remainder.
    nearer = (F.col("upto") - F.col("rest")) < (F.col("rest") - F.col("before"))
    return state.select(
        F.col("__source").alias("__cut_source"), F.when(nearer, F.col("bin") + 1).otherwise(F.col("bin")).alias("cut")
    )


def mix(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies, taken."""
    rows = parked(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("mark")),
        "sizes",
    )
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    planned = targets(per_source).withColumn("whole", F.floor(rate)).select(
        F.col("source").alias("__source"), "source_size", "target", "whole",
        (F.col("target") - F.col("whole") * F.col("source_size")).alias("rest"),
    )
    rows = rows.withColumn("klass", size_class(F.col("size")))
    planned = parked(_constants(rows, planned), "targets")
    joined = rows.join(planned, F.col("source").eqNullSafe(F.col("__source")))
    ranked = parked(joined.withColumn("rank", rank(joined)).drop("__source", "constant", "klass"), "ranks")
    cuts = _cut(ranked.select("source", "size", "rank"), planned)
    taken = ranked.join(cuts, F.col("source").eqNullSafe(F.col("__cut_source")))
    copies = (F.col("whole") + (F.col("rank") < F.col("cut")).cast("long")).alias("copies")
    return taken.select("doc_id", "mark", "source", "size", "source_size", "target", copies).withColumn(
        "taken", F.col("copies") * F.col("size")
    )
