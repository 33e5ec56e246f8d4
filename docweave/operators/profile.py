"""Reports on objects, parse runs, documents and logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docweave.functions import ids, values
from docweave.operators import prefix, quantiles, restarts
from docweave.session import cut_lineage

# Statuses of documents whose objects are kept.
LIVE_STATUSES = ("INDEXED", "PARSED", "PENDING", "SKIPPED", "FAILED")
REASON_DELETED = "doc_state=DELETED"
REASON_EXCLUDED = "doc_state=EXCLUDED (대상 폴더 밖)"
REASON_UNKNOWN = "doc_state 에 없음"
NO_BODY = "NO_BODY_EXTRACTOR"
PROBLEM_STATUSES = ("SPLIT_QUEUED", "DLQ", "FAILED")


# --- Objects without a document ------------------------------------------------------

def orphan_verdict(file_id: Column, known: Column, status: Column, only_deleted: bool = False) -> Column:
    """Why an object may go, or NULL: it stays while its document lives or cannot be named."""
    careful = F.lit(only_deleted)
    return (
        F.when((file_id == "") | (file_id == "unknown"), F.lit(None))
        .when(known & status.isin(*LIVE_STATUSES), F.lit(None))
        .when(known & (status == "DELETED"), REASON_DELETED)
        .when(known & (status == "EXCLUDED") & ~careful, REASON_EXCLUDED)
        .when(~known & ~careful, REASON_UNKNOWN)
    )


def orphans(objects: DataFrame, state: DataFrame, only_deleted: bool = False) -> DataFrame:
    """(uri, bucket, file_id, doc_status, reason) of the objects that may go."""
    named = objects.withColumn("file_id", ids.extract_file_id(F.col("name")))
    stored = state.select("file_id", "status", F.lit(True).alias("__known"))
    joined = named.join(stored, "file_id", "left").withColumn("__known", F.coalesce("__known", F.lit(False)))
    verdict = orphan_verdict(F.col("file_id"), F.col("__known"), F.col("status"), only_deleted)
    return joined.withColumn("reason", verdict).filter(F.col("reason").isNotNull()).select(
        ids.gs_uri(F.col("bucket"), F.col("name")).alias("uri"), "bucket", "file_id",
        F.coalesce("status", F.lit("(none)")).alias("doc_status"), "reason",
    )


def orphan_listing(found: DataFrame) -> DataFrame:
    return found.orderBy("uri")


def orphan_report(found: DataFrame, top: int | None = None) -> DataFrame:
    """Counts by bucket, by reason and by extension, from one grouping.

    With ``top``, extensions after the most frequent ones are one row, ``(other)``.
    """
    base = F.regexp_extract("uri", r"([^/]*)\z", 1)
    extension = F.regexp_extract(base, r"[^.].*?(\.[^.]*)\z", 1)
    marked = found.withColumn("extension", F.coalesce(F.nullif(extension, F.lit("")), F.lit("(없음)")))
    facts = F.array(*[
        F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("value")) for kind in ("bucket", "reason", "extension")
    ])
    counts = marked.select(F.inline(facts)).groupBy("kind", "value").agg(F.count(F.lit(1)).alias("objects"))
    place = F.row_number().over(Window.partitionBy("kind").orderBy(F.desc("objects"), "value"))
    placed = counts.withColumn("place", place)
    if top is None:
        return placed
    beyond = (F.col("kind") == "extension") & (F.col("place") > top)
    return placed.groupBy(
        "kind", F.when(beyond, "(other)").otherwise(F.col("value")).alias("value")
    ).agg(F.sum("objects").alias("objects"), F.min("place").alias("place"))


# --- Parse and conversion runs -------------------------------------------------------

def parse_summary(runs: DataFrame) -> DataFrame:
    """One row over a quality table with ok, triggered and ms."""
    ok = F.col("ok")
    ms = F.when(ok, F.col("ms"))
    (median,) = quantiles.quantiles(runs, ms, [(quantiles.inclusive, 0.5)])
    return runs.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("ok"), F.count_if(~ok).alias("fail"),
        F.count_if(ok & ~F.col("triggered")).alias("gate_pass"),
        F.count_if(ok & F.col("triggered")).alias("gate_soft_fail"),
        F.round(F.avg(ms), 1).alias("ms_avg"), F.round(F.sum(ms), 1).alias("ms_sum"),
        F.round(F.lit(median).cast("double"), 1).alias("ms_p50"), F.round(F.max(ms), 1).alias("ms_max"),
    )


def conversion_failures(runs: DataFrame) -> DataFrame:
    """Failures by their reason."""
    return runs.filter(F.col("error").isNotNull()).groupBy(F.col("error").alias("reason")).agg(F.count(F.lit(1)).alias("documents"))


def conversion_sizes(runs: DataFrame) -> DataFrame:
    size = F.when(F.col("error").isNull(), F.length("markdown"))
    (median,) = quantiles.quantiles(runs, size, [(quantiles.inclusive, 0.5)])
    return runs.agg(
        F.count(size).alias("converted"), F.count("error").alias("failed"), F.min(size).alias("min_chars"),
        F.lit(median).cast("double").alias("median_chars"), F.max(size).alias("max_chars"),
    )


# --- Documents -----------------------------------------------------------------------

def status_by_extension(outcomes: DataFrame, statuses: tuple[str, ...]) -> DataFrame:
    """Documents by extension, a column for each of the given outcomes."""
    extension = F.lower(ids.file_suffix(F.col("name")))
    return outcomes.groupBy(extension.alias("extension")).pivot("status", list(statuses)).count().fillna(0)


def searchability(state: DataFrame) -> DataFrame:
    """Documents that cannot be found and those of which only the side text can."""
    hidden = F.col("status").isin("SKIPPED", "EXCLUDED")
    return state.agg(
        F.count(F.lit(1)).alias("documents"), F.count_if(hidden).alias("unsearchable"),
        F.count_if(F.coalesce("error", F.lit("")).startswith(NO_BODY)).alias("sidecar_only"),
    )


def problems(outcomes: DataFrame) -> DataFrame:
    return outcomes.filter(F.col("status").isin(*PROBLEM_STATUSES)).select(
        "file_id", "status", F.col("error").alias("detail")
    )


def hygiene(state: DataFrame, copy_pattern: str, draft_pattern: str) -> DataFrame:
    """Indexed documents whose names mark copies or drafts, and those without a body."""
    name = F.coalesce("path", "name")
    live = state.filter(F.col("status") == "INDEXED")
    return live.agg(
        F.count(F.lit(1)).alias("documents"), F.count_if(name.rlike(copy_pattern)).alias("copies"),
        F.count_if(name.rlike(draft_pattern)).alias("drafts"),
        F.count_if(F.coalesce("error", F.lit("")) != "").alias("without_body"),
    )


def bundle_sizes(state: DataFrame) -> DataFrame:
    """Files per bundle of the indexed documents."""
    live = state.filter((F.col("status") == "INDEXED") & (F.coalesce("bundle", F.lit("")) != ""))
    files = cut_lineage(live.groupBy("bundle").agg(F.count(F.lit(1)).alias("files")))
    (median,) = quantiles.quantiles(files, F.col("files"), [(quantiles.inclusive, 0.5)])
    return files.agg(
        F.count(F.lit(1)).alias("bundles"), F.sum("files").alias("documents"), F.avg("files").alias("mean_files"),
        F.lit(median).cast("double").alias("median_files"), F.max("files").alias("max_files"),
        (F.count_if(F.col("files") >= 2) / F.count(F.lit(1))).alias("share_of_two_or_more"),
    )


# --- Logs ----------------------------------------------------------------------------

def filter_logs(
    logs: DataFrame, services: tuple[str, ...] = (), severity: str | None = None, text: str | None = None,
    fields: tuple[str, ...] = ("message",),
) -> DataFrame:
    """Rows of the services, at or above a severity, that hold a text in any message field."""
    if services:
        logs = logs.filter(F.col("service").isin(*services))
    if severity:
        level = values.SEVERITIES.index(severity.upper())
        # The names at or above the level, so that the filter reaches the scan.
        logs = logs.filter(F.col("severity").isin(*values.SEVERITIES[level:]))
    if text:
        held = F.lit(False)
        for field in fields:
            held = held | F.coalesce(F.contains(F.lower(field), F.lit(text.lower())), F.lit(False))
        logs = logs.filter(held)
    return logs


def repeat_profile(calls: DataFrame) -> DataFrame:
    """Calls, distinct queries, byte-identical repeats and the most frequent one."""
    counts = calls.groupBy("query_text").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.sum("n").alias("calls"), F.count(F.lit(1)).alias("distinct_queries"),
        (F.sum("n") - F.count(F.lit(1))).alias("repeats"), F.max("n").alias("max_repeat"),
    )


def query_bursts(calls: DataFrame, gap_seconds: int) -> DataFrame:
    """(query_text, started, ended, calls) of runs of one query with no longer gap in them.

    Gaps are found in blocks of rows, so one query, in one hour, may make up most of the log.
    """
    keys, order = ["query_text"], ["ts", "event_id"]
    rows, block = prefix.in_even_blocks(calls, [*keys, *order])
    before = prefix.previous_value(rows, keys, order, F.col("ts"), block, "before")
    opens = F.coalesce(
        F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("before").cast("timestamp"))
        > gap_seconds * 1_000_000, F.lit(True),
    )
    numbered = prefix.running_sum(before, keys, order, opens.cast("int"), block, "burst")
    return numbered.groupBy("query_text", "burst").agg(
        F.min("ts").alias("started"), F.max("ts").alias("ended"), F.count(F.lit(1)).alias("calls")
    )


def answered_calls(calls: DataFrame, keys: list[str], ttl_seconds: int, order: tuple[str, str] = ("ts", "event_id")) -> DataFrame:
    """Add ``answered``: false for repeats of a query within the time after its last answer.

    The time runs from the answer, not from the last repeat.
    """
    ts = order[0]
    rows, block = prefix.in_even_blocks(calls, [*keys, *order])
    placed = prefix.running_sum(rows, keys, list(order), F.lit(1), block, "__place").drop("__row")
    timed = placed.withColumn("__position", (F.col("__place") - 1).cast("bigint")).withColumn(
        "__micros", F.unix_micros(F.col(ts).cast("timestamp"))
    ).drop("__place")
    return restarts.mark_restarts(
        timed, keys, "__position", "__micros", "__micros", ttl_seconds * 1_000_000, name="answered"
    ).drop("__position", "__micros")


def silent_periods(events: DataFrame, keys: list[str], limit_seconds: int) -> DataFrame:
    """(keys, since, until) of gaps between successive events that are longer than the limit."""
    order = ["ts", "event_id"]
    rows, block = prefix.in_even_blocks(events, [*keys, *order])
    after = prefix.next_value(rows, keys, order, F.col("ts"), block, "until")
    gap = F.unix_micros(F.col("until").cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp"))
    return after.filter(gap > limit_seconds * 1_000_000).select(*keys, F.col("ts").alias("since"), "until")


def hourly_alerts(logs: DataFrame, pattern: str, level: str = "ERROR") -> DataFrame:
    """The first matching row of each hour and service: a severity reached or a text matched."""
    at_least = values.SEVERITIES[values.SEVERITIES.index(level):]
    hits = logs.filter(F.col("severity").isin(*at_least) | F.col("message").rlike(pattern))
    first = F.min_by(F.struct("event_id", "ts", "severity", "message"), F.struct("ts", "event_id"))
    return hits.groupBy("service", F.window("ts", "1 hour").alias("hour")).agg(
        first.alias("first"), F.count(F.lit(1)).alias("matches")
    ).select("service", F.col("hour.start").alias("hour"), "first.event_id", "first.ts", "first.severity", "matches")
