"""Lexical re-ranking of the candidates of each query.

A query has the ``fetch_k`` candidates its caller asked for, so every window here is over a short group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docweave.functions import lexical

SCORE_DIGITS = 9


def term_statistics(candidates: DataFrame, queries: DataFrame) -> DataFrame:
    """Query terms met in candidates: tf, the query's df, n and mean length.

    A candidate meets its query's distinct terms as one array and counts them inside the row, so only
    terms that occur become rows; the length of a text without tokens is 1.
    """
    asked = queries.select("query_id", F.array_distinct(lexical.tokens(F.col("query_text"))).alias("terms"))
    held = candidates.select("query_id", "chunk_id", lexical.tokens(F.col("text")).alias("tokens"))
    met = held.join(asked, "query_id", "left").select(
        "query_id", "chunk_id", F.greatest(F.size("tokens"), F.lit(1)).alias("length"),
        F.filter("tokens", lambda t: F.array_contains("terms", t)).alias("hits"),
    )
    in_query = Window.partitionBy("query_id")
    sized = met.withColumn("n", F.count(F.lit(1)).over(in_query)).withColumn("mean_length", F.avg("length").over(in_query))
    counted = F.transform(F.array_distinct("hits"), lambda t: F.struct(
        t.alias("term"), F.size(F.filter("hits", lambda h: h == t)).cast("bigint").alias("tf")
    ))
    in_term = Window.partitionBy("query_id", "term")
    return sized.select("query_id", "chunk_id", "n", "length", "mean_length", F.inline(counted)).withColumn(
        "df", F.count(F.lit(1)).over(in_term)
    )


def bm25_scores(candidates: DataFrame, queries: DataFrame) -> DataFrame:
    """(query_id, chunk_id, bm25) of the candidates that hold a query term."""
    part = lexical.bm25_term(*(F.col(c) for c in ("n", "df", "tf", "length", "mean_length")))
    return (
        term_statistics(candidates, queries)
        .groupBy("query_id", "chunk_id")
        .agg(F.round(F.sum(part), SCORE_DIGITS).alias("bm25"))
    )


def rrf_rerank(candidates: DataFrame, queries: DataFrame, enabled: bool = True) -> DataFrame:
    """Add bm25, lex_rank, rrf and ``position`` (from 0): ranks fused, never scores.

    Candidates without a query term score 0 and are still ranked.
    """
    if not enabled:
        return candidates.withColumn("position", F.col("vec_rank"))
    scored = candidates.join(
        bm25_scores(candidates, queries), ["query_id", "chunk_id"], "left"
    ).withColumn("bm25", F.coalesce("bm25", F.lit(0.0)))
    in_query = Window.partitionBy("query_id")
    by_words = in_query.orderBy(F.desc("bm25"), "vec_rank")
    ranked = scored.withColumn("lex_rank", F.row_number().over(by_words) - 1).withColumn(
        "rrf", lexical.rrf(F.col("vec_rank"), F.col("lex_rank"))
    )
    by_both = in_query.orderBy(F.desc("rrf"), "vec_rank")
    return ranked.withColumn("position", F.row_number().over(by_both) - 1)
