"""Cutting texts into overlapping chunks, and the study of chunk sizes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docweave.functions import text
from docweave.operators import quantiles

CHUNK_TOKENS = 1024
OVERLAP_TOKENS = 256
CHARS_PER_TOKEN = 0.96
CANDIDATE_TOKENS = (512, 768, 1024, 1536, 2048, 3072)


def span_chars(tokens: int, chars_per_token: float = CHARS_PER_TOKEN) -> int:
    return max(1, int(tokens * chars_per_token))


def fixed_chunks(
    documents: DataFrame, tokens: int = CHUNK_TOKENS, overlap: int = OVERLAP_TOKENS,
    chars_per_token: float = CHARS_PER_TOKEN,
) -> DataFrame:
    """Rows (chunk_no from 0, chunk_text); each text is cut within its own row.

    The last chunk is the first one that reaches the end of the text.
    """
    size, lap = span_chars(tokens, chars_per_token), int(overlap * chars_per_token)
    step = size - lap
    count = F.greatest(F.lit(1), F.ceil((F.length("text") - lap) / step).cast("int"))
    cut = documents.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), count - 1)))
    return cut.withColumn("chunk_text", F.substring(F.col("text"), F.col("chunk_no") * step + 1, F.lit(size)))


def _sizes(candidates: tuple[int, ...], chars_per_token: float) -> Column:
    return F.array(*[
        F.struct(F.lit(c).alias("chunk_tokens"), F.lit(span_chars(c, chars_per_token)).alias("span"))
        for c in candidates
    ])


def chunk_study(
    documents: DataFrame, candidates: tuple[int, ...] = CANDIDATE_TOKENS,
    chars_per_token: float = CHARS_PER_TOKEN,
) -> DataFrame:
    """For each candidate size: tables, tables cut by a chunk border, one-chunk documents, chunks.

    Every document adds up its own counts for every size before anything is shuffled.
    """
    measured = documents.select(
        F.length("text").alias("chars"), text.table_spans(F.col("text")).alias("tables")
    ).select("chars", "tables", F.inline(_sizes(candidates, chars_per_token)))
    cut = F.filter(
        "tables", lambda t: F.floor(t["start"] / F.col("span")) != F.floor((t["end"] - 1) / F.col("span"))
    )
    chunks = F.greatest(F.lit(1), F.ceil(F.col("chars") / F.col("span")))
    totals = measured.groupBy("chunk_tokens", "span").agg(
        F.sum(F.size("tables")).alias("tables"), F.sum(F.size(cut)).alias("split"),
        F.count_if(chunks == 1).alias("single"), F.avg(chunks).alias("avg_chunks"),
        F.count(F.lit(1)).alias("documents"),
    )
    return totals.select(
        "chunk_tokens", F.col("span").alias("span_chars"), "tables", "split",
        F.when(F.col("tables") > 0, F.col("split") / F.col("tables") * 100).otherwise(0.0).alias("split_pct"),
        (F.col("single") / F.col("documents") * 100).alias("single_doc_pct"),
        "avg_chunks",
    )


def best_chunk_size(study: DataFrame) -> DataFrame:
    """The size that cuts the fewest tables; the smaller one of equals."""
    return study.orderBy("split_pct", "chunk_tokens").limit(1)


def length_statistics(documents: DataFrame) -> DataFrame:
    chars = F.length("text")
    (median,) = quantiles.quantiles(documents, chars, [(quantiles.inclusive, 0.5)])
    return documents.agg(
        F.lit(median).cast("double").alias("median_chars"), F.avg(chars).alias("mean_chars"),
        F.min(chars).alias("min_chars"), F.max(chars).alias("max_chars"),
    )
