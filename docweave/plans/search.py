"""Search and answer jobs for a batch of queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.operators import answer as answers
from docweave.operators import postprocess, rerank, retrieve
from docweave.options import SearchOptions
from docweave.session import cut_lineage

_CARRY = ("display_name", "source_uri", "modified_time", "top_k", "has_state")


def with_limits(queries: DataFrame, opts: SearchOptions, top_k: int | None = None) -> DataFrame:
    """Add top_k and fetch_k; a ``top_k`` column wins, and 0 or NULL means the default."""
    asked = F.col("top_k") if "top_k" in queries.columns else F.lit(top_k).cast("int")
    k = F.coalesce(F.nullif(asked, F.lit(0)), F.lit(opts.top_k_default))
    k = F.greatest(F.lit(1), F.least(k, F.lit(opts.top_k_max)) if opts.top_k_max else k)
    fetch = F.greatest(k * opts.fetch_multiplier, k)
    return queries.withColumn("top_k", k).withColumn(
        "fetch_k", F.least(F.lit(opts.fetch_max), fetch) if opts.fetch_max else fetch
    )


def with_optional(chunks: DataFrame) -> DataFrame:
    """Chunk columns that an index may lack, as NULLs."""
    for name in ("source_uri", "modified_time"):
        if name not in chunks.columns:
            chunks = chunks.withColumn(name, F.lit(None).cast("string"))
    return chunks


def candidates(queries: DataFrame, chunks: DataFrame, opts: SearchOptions) -> DataFrame:
    """Candidates of each query with their texts.

    Vectors are scanned first and alone; texts are fetched for the kept rows only. The few
    candidates are then written to the checkpoint folder, so that no later step, and no lost
    executor, makes the scan run again.
    """
    fields = ["display_name", "text", "source_uri", "modified_time"]
    return cut_lineage(retrieve.with_chunk_fields(queries, chunks, fields, opts))


def search(
    queries: DataFrame, chunks: DataFrame, state: DataFrame,
    opts: SearchOptions = SearchOptions(), top_k: int | None = None,
) -> DataFrame:
    """Ranked documents of every query, as (query_id, rank, text, score, …, source)."""
    queries = with_limits(queries, opts, top_k)
    chunks = with_optional(chunks)
    found = candidates(queries, chunks, opts)
    ranked = rerank.rrf_rerank(found, queries, opts.lexical_rerank)
    hits = postprocess.hit_columns(ranked).join(queries.select("query_id", "top_k"), "query_id")
    shown = postprocess.drop_unservable(postprocess.with_state(hits, state), opts.drive_id)
    carry = (*_CARRY, *[c for c in shown.columns if c.startswith("state_")])
    merged = postprocess.merge_hits(shown, opts, carry=carry)
    return postprocess.decorate(merged.join(queries.select("query_id", "query_text"), "query_id"))


def answer(
    queries: DataFrame, chunks: DataFrame, state: DataFrame,
    opts: SearchOptions = SearchOptions(), top_k: int | None = None,
) -> DataFrame:
    """One payload per query: labelled context, citations and coverage."""
    return answers.build_answers(search(queries, chunks, state, opts, top_k), queries)
