"""Recovery: what to index again, what to try again and how it ended."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.functions import ids
from docweave.operators import prefix, restarts


def round_robin_page(
    rows: DataFrame, limit: int, cursor: str | None = None, key: str = "file_id", priority: Column | None = None
) -> DataFrame:
    """The next ``limit`` rows by id, after the cursor first and then from the front.

    A sort with a limit keeps ``limit`` rows per task; the page is the feature here.
    """
    ahead = ~(F.col(key) > cursor) if cursor else F.lit(False)
    order = [priority] if priority is not None else []
    return rows.orderBy(*order, ahead, key).limit(limit)


def page_cursor(page: DataFrame, cursor: str | None = None, key: str = "file_id") -> DataFrame:
    """One row: the id the page ends on, from which the next one goes on."""
    ahead = ~(F.col(key) > cursor) if cursor else F.lit(False)
    return page.agg(F.max_by(key, F.struct(ahead, F.col(key))).alias("cursor"))


def reindex_page(state: DataFrame, limit: int, force: bool = False, cursors: dict[str, str] | None = None) -> DataFrame:
    """Documents to index again: parsed ones, and with ``force`` indexed ones in what is left."""
    cursors = cursors or {}
    parsed = round_robin_page(state.filter(F.col("status") == "PARSED"), limit, cursors.get("PARSED"))
    if not force:
        return parsed
    rank = F.when(F.col("status") == "PARSED", 0).otherwise(1)
    ahead = F.lit(False)
    for status, cursor in cursors.items():
        ahead = ahead | ((F.col("status") == status) & (F.col("file_id") <= cursor))
    both = state.filter(F.col("status").isin("PARSED", "INDEXED"))
    return both.orderBy(rank, F.when(ahead, 1).otherwise(0), "file_id").limit(limit)


def reindex_sources(targets: DataFrame, objects: DataFrame, bucket: str) -> DataFrame:
    """All indexable objects of each target: (file_id, uris, uri_count, reason).

    A target without any gets the reason under which it is queued. Objects of one file are a
    handful of names, so their list is short.
    """
    owned = objects.filter((F.col("bucket") == bucket) & ids.is_indexable(F.col("name"))).select(
        ids.object_owner(F.col("name")).alias("file_id"),
        ids.gs_uri(F.lit(bucket), F.col("name")).alias("uri"),
    )
    wanted = owned.join(targets.select("file_id"), "file_id", "left_semi")
    grouped = wanted.groupBy("file_id").agg(F.array_sort(F.collect_list("uri")).alias("uris"))
    return (
        targets.join(grouped, "file_id", "left")
        .withColumn("uris", F.coalesce("uris", F.array().cast("array<string>")))
        .withColumn("uri_count", F.size("uris"))
        .withColumn("reason", F.when(F.col("uri_count") == 0, "reindex_no_source_uri"))
    )


def retry_candidates(state: DataFrame, queue: DataFrame, max_attempts: int) -> DataFrame:
    """Failed documents with their attempts so far; those at the limit are exhausted."""
    attempts = queue.select("file_id", F.col("retry_count").alias("attempts"))
    return (
        state.filter(F.col("status") == "FAILED")
        .join(attempts, "file_id", "left")
        .withColumn("attempts", F.coalesce("attempts", F.lit(0)))
        .withColumn("exhausted", F.col("attempts") >= max_attempts)
        .withColumn("link", ids.drive_link(F.col("source_uri")))
    )


def retry_outcomes(candidates: DataFrame, results: DataFrame) -> DataFrame:
    """``outcome`` of every candidate from the dispositions of its new run.

    ``results`` has file_id, disposition, uri_count, indexed_count. A ready file has recovered
    once all its objects are indexed; everything else that is not a no-op has still failed.
    """
    d = F.col("disposition")
    ready = (d == "GCS_READY") & (F.coalesce("uri_count", F.lit(0)) > 0)
    outcome = (
        F.when(F.col("exhausted"), "exhausted")
        .when(ready & (F.col("indexed_count") == F.col("uri_count")), "recovered")
        .when(d.isin("SKIPPED", "UNCHANGED", "HASH_UNCHANGED"), "recovered")
        .otherwise("still_failed")
    )
    return candidates.join(results, "file_id", "left").withColumn("outcome", outcome)


def retry_totals(outcomes: DataFrame) -> DataFrame:
    o = F.col("outcome")
    fully = (o == "recovered") & (F.col("disposition") == "GCS_READY")
    return outcomes.agg(
        F.count(F.lit(1)).alias("candidates"), F.count_if(o != "exhausted").alias("retried"),
        F.count_if(o == "recovered").alias("recovered"), F.count_if(o == "still_failed").alias("still_failed"),
        F.count_if(o == "exhausted").alias("exhausted"),
        F.coalesce(F.sum(F.when(fully, F.col("indexed_count"))), F.lit(0)).alias("indexed"),
    ).withColumn("ok", F.col("still_failed") == 0)


def reindex_totals(sources: DataFrame, indexed: DataFrame) -> DataFrame:
    """Counters of a reindex run; ``indexed`` has file_id and indexed_count."""
    joined = sources.join(indexed, "file_id", "left").withColumn(
        "indexed_count", F.coalesce("indexed_count", F.lit(0))
    )
    none = F.col("uri_count") == 0
    return joined.agg(
        F.count(F.lit(1)).alias("candidates"), F.count_if(~none).alias("with_uris"),
        F.coalesce(F.sum("indexed_count"), F.lit(0)).alias("indexed"), F.count_if(none).alias("skipped_no_uri"),
        (F.count_if(none) + F.coalesce(F.sum(F.col("uri_count") - F.col("indexed_count")), F.lit(0))).alias("failed"),
    ).withColumn("ok", F.col("failed") == 0)


def import_calls(uris: DataFrame, order: tuple[str, ...], size: int = 25) -> DataFrame:
    """Calls of at most ``size`` URIs in a total order, numbered from 0."""
    return prefix.fixed_batches(prefix.numbered(uris, list(order)), size, name="call_no")


def document_batches(documents: DataFrame, run: str, position: str, count: str, threshold: int) -> DataFrame:
    """Add ``batch_no``: whole documents gathered until a batch holds ``threshold`` objects.

    ``position`` counts from 0 inside a run; documents without objects must be left out.
    """
    block = prefix.row_block(position)
    upto = prefix.running_sum(documents, [run], [position], F.col(count), block, "__upto")
    upto = upto.withColumn("__before", (F.col("__upto") - F.col(count)).cast("bigint"))
    marked = restarts.mark_restarts(
        upto, [run], position, "__before", "__before", threshold, inclusive=True, name="__opens"
    )
    opened = prefix.running_sum(marked, [run], [position], F.col("__opens").cast("int"), block, "batch_no")
    return opened.withColumn("batch_no", F.col("batch_no") - 1).drop("__upto", "__before", "__opens")


PART_SAFETY = 0.85


def pack_pages(pages: DataFrame, limit: int, key: str = "doc", page_no: str = "page_no", size: str = "bytes") -> DataFrame:
    """Add ``part_no`` (from 1) and ``split_error`` to the pages of documents.

    A document within the limit is one part. Else consecutive pages fill parts below 85 % of the
    limit. A single page, a first page over the target or a part over the limit is an error.
    Page numbers count from 1.
    """
    target = int(limit * PART_SAFETY)
    position = (F.col(page_no) - 1).cast("bigint")
    block = prefix.row_block("__pos")
    totals = pages.groupBy(key).agg(
        F.sum(size).alias("__total"), F.count(F.lit(1)).alias("__pages"), F.min_by(size, page_no).alias("__first")
    )
    fits = F.col("__total") <= limit
    placed = pages.join(totals, key)
    # Only documents over the limit are folded; the others are one part.
    rows = placed.filter(~fits).withColumn("__pos", position)
    upto = prefix.running_sum(rows, [key], ["__pos"], F.col(size), block, "__upto")
    upto = upto.withColumn("__upto", F.col("__upto").cast("bigint")).withColumn(
        "__before", (F.col("__upto") - F.col(size)).cast("bigint")
    )
    marked = restarts.mark_restarts(upto, [key], "__pos", "__before", "__upto", target, name="__opens")
    numbered = prefix.running_sum(marked, [key], ["__pos"], F.col("__opens").cast("int"), block, "__part")
    parts = numbered.groupBy(key, "__part").agg(F.sum(size).alias("__part_size"))
    widest = parts.groupBy(key).agg(F.max("__part_size").alias("__widest"))
    whole = placed.filter(fits).withColumn("__part", F.lit(1)).withColumn("__widest", F.lit(None).cast("long"))
    joined = whole.unionByName(numbered.join(widest, key).select(*whole.columns))
    error = (
        F.when(fits, F.lit(None).cast("string"))
        .when(F.col("__pages") <= 1, "single_page_over_limit")
        .when(F.col("__first") > target, "first_page_over_target")
        .when(F.col("__widest") > limit, "part_over_limit")
    )
    return joined.select(
        *pages.columns,
        F.when(fits, F.lit(1)).otherwise(F.col("__part")).cast("int").alias("part_no"),
        error.alias("split_error"),
    )
