"""From ranked chunks to ranked documents.

All windows are over the candidates of a query, or a part of them, so one shuffle on the query
id serves them all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.functions import ids, lexical, paths, text
from docweave.operators import sizes
from docweave.options import SearchOptions

CHUNK_JOINER = "\n\n[...]\n\n"
HIDDEN_STATUSES = ("SKIPPED", "EXCLUDED", "DELETED")
CLEANUP_FAILED = "out_of_folder_scope_cleanup_failed"

def _query():
    return Window.partitionBy("query_id")


def servable(status: Column, error: Column) -> Column:
    """False for documents that must not be shown; a document without state is shown."""
    hidden = status.isin(*HIDDEN_STATUSES) | (
        (status == "FAILED") & F.coalesce(error, F.lit("")).startswith(CLEANUP_FAILED)
    )
    return ~F.coalesce(hidden, F.lit(False))


def with_state(hits: DataFrame, state: DataFrame) -> DataFrame:
    """Join the state of each hit's file; its columns get a ``state_`` prefix.

    The state table is first cut down to the files that were hit.
    """
    fields = [c for c in state.columns if c != "file_id"]
    renamed = sizes.rows_of(state, hits).select("file_id", F.lit(True).alias("has_state"), *[F.col(c).alias(f"state_{c}") for c in fields])
    return hits.join(renamed, "file_id", "left").withColumn("has_state", F.coalesce("has_state", F.lit(False)))


def drop_unservable(hits: DataFrame, drive_id: str | None = None) -> DataFrame:
    """Filter before any cut to the best k, so that hidden files leave no gaps."""
    kept = hits.filter(servable(F.col("state_status"), F.col("state_error")))
    if drive_id:
        kept = kept.filter(~F.col("has_state") | (F.col("state_drive_id") == drive_id))
    return kept


def drop_shadowed_sidecars(hits: DataFrame) -> DataFrame:
    """Drop side-file hits of files that also have a body hit for the query."""
    in_file = Window.partitionBy("query_id", "file_id")
    return (
        hits.withColumn("__body", F.max(~F.col("is_sidecar")).over(in_file))
        .filter(~(F.col("is_sidecar") & F.col("__body")))
        .drop("__body")
    )


def drop_repeated_texts(hits: DataFrame) -> DataFrame:
    """Keep the first hit of each folded text of a query; texts that fold to nothing all stay."""
    folded = text.fingerprint(F.col("text"))
    marked = hits.withColumn("__fp", F.when(folded == "", "").otherwise(F.sha2(folded, 256)))
    first = Window.partitionBy("query_id", "__fp").orderBy("position")
    return (
        marked.withColumn("__nth", F.row_number().over(first))
        .filter((F.col("__fp") == "") | (F.col("__nth") == 1))
        .drop("__fp", "__nth")
    )


def rank_files(hits: DataFrame) -> DataFrame:
    """Add ``ordinal`` (chunk of its file, from 1) and ``file_rank`` (by first hit, from 1)."""
    in_file = Window.partitionBy("query_id", "file_id")
    placed = hits.withColumn("ordinal", F.row_number().over(in_file.orderBy("position"))).withColumn(
        "__first", F.min("position").over(in_file)
    )
    return placed.withColumn("file_rank", F.dense_rank().over(_query().orderBy("__first"))).drop("__first")


def spend_budget(ranked: DataFrame, top_k: Column, opts: SearchOptions) -> DataFrame:
    """Chunks of the best ``top_k`` files within the query's chunk budget.

    Every file keeps its first chunk; what is left goes round the files, one chunk at a time.
    That order is (ordinal, file rank), so the rounds become one row number.
    """
    m = opts.max_chunks_per_file
    chosen = ranked.filter(F.col("file_rank") <= top_k)
    if m:
        chosen = chosen.filter(F.col("ordinal") <= m)
    if not opts.max_total_chunks and not m:
        return chosen
    files = F.col("__files")
    budget = F.lit(opts.max_total_chunks) if opts.max_total_chunks else files * m
    rounds = F.row_number().over(_query().orderBy("ordinal", "file_rank"))
    return (
        chosen.withColumn("__files", F.max("file_rank").over(_query()))
        .withColumn("__round", rounds)
        .filter(F.col("__round") <= F.greatest(budget, files))
        .drop("__files", "__round")
    )


def merge_chunks(hits: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per query and file: its chunk texts in order, fields of its first chunk, rank."""
    ordered = F.array_sort(F.collect_list(F.struct("ordinal", "text")))  # at most a few chunks
    head = [F.min_by(c, "ordinal").alias(c) for c in ("distance", *carry)]
    merged = hits.groupBy("query_id", "file_id", "file_rank").agg(
        F.array_join(ordered["text"], CHUNK_JOINER).alias("text"),
        F.count(F.lit(1)).alias("chunk_count"),
        *head,
    )
    return merged.withColumn("rank", F.row_number().over(_query().orderBy("file_rank"))).drop("file_rank")


def merge_hits(hits: DataFrame, opts: SearchOptions, top_k: int | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """The whole way from ranked chunks to ranked documents.

    A text cut later by the cap still claims its fingerprint, so repeats go first.
    """
    k = F.col("top_k") if "top_k" in hits.columns else F.lit(opts.clamp_top_k(top_k))
    bodies = drop_repeated_texts(drop_shadowed_sidecars(hits))
    return merge_chunks(spend_budget(rank_files(bodies), k, opts), carry)


def decorate(results: DataFrame) -> DataFrame:
    """Result rows as served: rounded score, source fields, label and term coverage.

    Expects the state columns and query_text, display_name, source_uri and hit fields.
    """
    name = paths.display_name(
        F.col("state_name"), F.col("display_name"), F.col("file_id"), F.col("state_path")
    )
    label = paths.citation_label(name, F.col("state_bundle"), F.col("state_path"), F.col("file_id"))
    source = F.struct(
        F.col("file_id"),
        name.alias("name"),
        F.col("state_path").alias("path"),
        F.col("state_bundle").alias("bundle"),
        F.coalesce(text.blank_to_null(F.col("state_source_uri")), F.col("source_uri")).alias("source_uri"),
        F.when(F.col("has_state"), F.col("state_modified_time"))
        .otherwise(F.col("modified_time")).alias("modified_time"),
        F.col("state_drive_id").alias("drive_id"),
        label.alias("label"),
    )
    terms = lexical.query_terms(F.col("query_text"))
    return (
        results.withColumn("query_terms", terms)
        .withColumn("matched_terms", lexical.matched_terms(F.col("query_terms"), F.col("text")))
        .select(
            "query_id", "rank", "text",
            F.round("distance", 6).alias("score"), F.lit("vertex_raw").alias("score_type"),
            "query_terms", "matched_terms",
            F.array_except("query_terms", "matched_terms").alias("missing_terms"),
            source.alias("source"),
        )
    )


def hit_columns(hits: DataFrame, normalise: bool = True) -> DataFrame:
    """File id, side-file flag and clean text of raw hits."""
    uri = F.col("source_uri")
    return hits.withColumn("file_id", ids.extract_file_id(F.col("display_name"), uri)).withColumn(
        "is_sidecar", ids.is_sidecar(F.col("display_name"), uri)
    ).withColumn("text", text.unescape_chunk_text(F.col("text")) if normalise else F.col("text"))
