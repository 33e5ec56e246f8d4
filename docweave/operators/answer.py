"""Context blocks, citations and coverage of search results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.functions import lexical

CONTEXT_SEPARATOR = "\n\n---\n\n"


def context_block(number, label, text):
    return F.concat(F.lit("["), number.cast("string"), F.lit("] "), label, F.lit("\n"), F.coalesce(text, F.lit("")))


def build_answers(results: DataFrame, queries: DataFrame) -> DataFrame:
    """One row per query: context, citations, counts, terms and coverage.

    A query has at most ``top_k_max`` results, so its group is short. Queries without results
    are kept with coverage ``none``; a result that misses no term makes it ``full``.
    """
    source = F.col("source")
    block = F.struct("rank", context_block(F.col("rank"), source["label"], F.col("text")).alias("block"))
    citation = F.struct(
        F.col("rank").alias("n"), source["file_id"].alias("file_id"), source["name"].alias("name"),
        source["label"].alias("label"), source["bundle"].alias("bundle"),
        source["source_uri"].alias("source_uri"),
    )
    grouped = results.groupBy("query_id").agg(
        F.array_join(F.array_sort(F.collect_list(block))["block"], CONTEXT_SEPARATOR).alias("context"),
        F.array_sort(F.collect_list(citation)).alias("citations"),
        F.count(F.lit(1)).alias("document_count"),
        F.flatten(F.collect_list(F.transform("matched_terms", lambda t: F.lower(t)))).alias("__covered"),
        F.max(F.size("missing_terms") == 0).alias("__whole"),
    )
    terms = queries.select("query_id", lexical.query_terms(F.col("query_text")).alias("query_terms"))
    covered = F.coalesce("__covered", F.array().cast("array<string>"))
    count = F.coalesce("document_count", F.lit(0))
    return terms.join(grouped, "query_id", "left").select(
        "query_id",
        F.coalesce("context", F.lit("")).alias("context"),
        F.coalesce("citations", F.array()).alias("citations"),
        count.alias("chunk_count"),
        count.alias("document_count"),
        "query_terms",
        F.filter("query_terms", lambda t: ~F.array_contains(covered, F.lower(t))).alias("uncovered_terms"),
        F.when(count == 0, "none").when(F.col("__whole"), "full").otherwise("partial").alias("coverage"),
    )
