"""Retrieval quality against a golden set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions.text import blank_to_null, strip
from docweave.operators import quantiles

SEGMENT_LAST_ITEM = 38


def _folded(col: Column) -> Column:
    return F.lower(strip(F.coalesce(col, F.lit(""))))


def accept_sets(golden: DataFrame) -> DataFrame:
    """Golden items with the ids that answer them: the item's own and the accepted copies."""
    extra = (
        F.coalesce("also_accept", F.array().cast("array<string>"))
        if "also_accept" in golden.columns else F.array().cast("array<string>")
    )
    return golden.withColumn("accept", F.array_union(F.array("file_id"), extra))


def gather_answers(pairs: DataFrame) -> DataFrame:
    """One item per question from (n, q, type, file_id) pairs; the lowest id leads.

    The answers are one value of the item, as the golden set states them.
    """
    ids = F.array_sort(F.collect_set("file_id"))
    return pairs.groupBy("n", "q").agg(
        F.min("type").alias("type"), ids[0].alias("file_id"), ids.alias("also_accept")
    )


def score_items(golden: DataFrame, results: DataFrame) -> DataFrame:
    """One row per item: first rank by id, by name and by bundle, hit score, hits and names.

    ``results`` are (n, rank, score, file_id, name, bundle); a question has at most a page of
    them. Items without results are kept.
    """
    found = results.select(
        "n", "rank", "score", F.col("file_id").alias("r_id"), F.col("name").alias("r_name"),
        F.col("bundle").alias("r_bundle"),
    )
    items = accept_sets(golden)
    for name in ("name", "bundle"):
        if name not in items.columns:
            items = items.withColumn(name, F.lit(None).cast("string"))
    joined = items.join(found, "n", "left")
    by_id = F.array_contains("accept", F.col("r_id"))
    by_name = _folded(F.col("r_name")) == _folded(F.col("name"))
    bundle = strip(F.coalesce("bundle", F.lit("")))
    by_bundle = (F.coalesce("bundle", F.lit("")) != "") & (strip(F.coalesce("r_bundle", F.lit(""))) == bundle)
    hit = F.col("rank").isNotNull()
    return joined.groupBy("n", "q", "type").agg(
        F.min(F.when(by_id, F.col("rank"))).alias("rank"),
        F.min(F.when(hit & by_name, F.col("rank"))).alias("same_doc_rank"),
        F.min(F.when(hit & by_bundle, F.col("rank"))).alias("bundle_rank"),
        F.min_by("score", F.when(by_id, F.col("rank"))).alias("hit_score"),
        F.min_by("score", "rank").alias("top_score"),
        F.count_if(hit).alias("n_hits"),
        F.count_distinct(F.when(hit, blank_to_null(_folded(F.col("r_name"))))).alias("distinct_names"),
    )


def metrics(rank: Column) -> list[Column]:
    """n, hits within 1, 3 and 5, their rates and the mean reciprocal rank."""
    n = F.count(F.lit(1))

    def hits(k: int) -> Column:
        return F.count_if(rank <= k)

    return [
        n.alias("n"), hits(1).alias("hit1"), hits(3).alias("hit3"), hits(5).alias("hit5"),
        F.round(hits(1) / n, 3).alias("hit1_rate"), F.round(hits(5) / n, 3).alias("hit5_rate"),
        F.round(F.avg(F.coalesce(1.0 / rank, F.lit(0.0))), 3).alias("mrr"),
    ]


def overall(items: DataFrame) -> DataFrame:
    """Metrics by criterion: the very file, the same document, the same bundle."""
    long = items.select(
        F.inline(F.array(*[
            F.struct(F.lit(label).alias("criterion"), F.col(col).alias("found"))
            for label, col in (("strict", "rank"), ("same_doc", "same_doc_rank"), ("bundle", "bundle_rank"))
        ]))
    )
    return long.groupBy("criterion").agg(*metrics(F.col("found")))


def by_type(items: DataFrame, rank: str = "same_doc_rank") -> DataFrame:
    return items.groupBy(F.coalesce("type", F.lit("?")).alias("type")).agg(*metrics(F.col(rank)))


def slots(items: DataFrame) -> DataFrame:
    """Questions without results, result slots and slots spent on repeated names."""
    return items.agg(
        F.count_if(F.col("n_hits") == 0).alias("empty_results"),
        F.sum("n_hits").alias("slots"),
        F.sum(F.col("n_hits") - F.col("distinct_names")).alias("wasted"),
    )


def by_segment(items: DataFrame, last_old_item: int = SEGMENT_LAST_ITEM, rank: str = "rank") -> DataFrame:
    segment = F.when(F.col("n") <= last_old_item, "old").otherwise("new")
    return items.groupBy(segment.alias("segment")).agg(*metrics(F.col(rank)))


def distance_distribution(items: DataFrame, col: str = "hit_score", p: float = 0.95) -> DataFrame:
    """Least, median, p95 (both forms) and greatest distance of the right answers.

    The exclusive form lies at position (n + 1)p, linear between its neighbours.
    """
    median, within, beyond = quantiles.quantiles(
        items, F.col(col), [(quantiles.inclusive, 0.5), (quantiles.inclusive, p), (quantiles.exclusive, p)]
    )
    return items.agg(F.min(col).alias("min_score"), F.max(col).alias("max_score")).select(
        "min_score", F.lit(median).cast("double").alias("median_score"), F.lit(within).cast("double").alias("p95_inclusive"),
        "max_score", F.lit(beyond).cast("double").alias("p95_exclusive"),
    )
