"""Queries of reports, logs and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from docweave.operators import profile
from docweave.plans.catalog_sync import OBJECTS, PLANNED, full_state, objects, planned, quality, QUALITY, STATE
from docweave.plans.registry import query
from docweave.sources.views import Tables

ORPHANS = f"""{OBJECTS},
found AS (SELECT 'gs://' || bucket || '/' || name AS uri, bucket, split_part(name, '.', 1) AS file_id, coalesce(s.status, '(none)') AS doc_status,
    CASE WHEN s.status = 'DELETED' THEN 'doc_state=DELETED' WHEN s.status = 'EXCLUDED' THEN 'doc_state=EXCLUDED (대상 폴더 밖)'
      WHEN s.file_id IS NULL THEN 'doc_state 에 없음' END AS reason,
    '.' || split_part(name, '.', len(string_split(name, '.'))) AS extension
  FROM objs LEFT JOIN (SELECT file_id, status FROM v_state) s ON s.file_id = split_part(name, '.', 1)),
orphans AS (SELECT * FROM found WHERE reason IS NOT NULL)"""


@query("orphans", "P25 J7 L6", f"WITH {ORPHANS} SELECT uri, file_id, doc_status, reason FROM orphans")
def _(t: Tables):
    return profile.orphan_listing(profile.orphans(objects(t), t.v_state)).select("uri", "file_id", "doc_status", "reason")


@query("orphans_only_deleted", "P25", f"WITH {ORPHANS} SELECT uri, reason FROM orphans WHERE doc_status = 'DELETED'")
def _(t: Tables):
    return profile.orphans(objects(t), t.v_state, only_deleted=True).select("uri", "reason")


@query("orphan_report", "A14 L6", f"""
WITH {ORPHANS}, facts AS (SELECT 'bucket' AS kind, bucket AS value FROM orphans UNION ALL SELECT 'reason', reason FROM orphans UNION ALL SELECT 'extension', extension FROM orphans),
counts AS (SELECT kind, value, count(*) AS objects FROM facts GROUP BY 1, 2)
SELECT kind, value, objects FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY objects DESC, value) AS place FROM counts) x WHERE kind <> 'extension' OR place <= 8
UNION ALL SELECT kind, '(other)', sum(objects) FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY objects DESC, value) AS place FROM counts) x
WHERE kind = 'extension' AND place > 8 GROUP BY 1
""")
def _(t: Tables):
    return profile.orphan_report(profile.orphans(objects(t), t.v_state), top=8).drop("place")


@query("parse_summary", "A15", f"""
WITH {QUALITY}, r AS (SELECT doc_id % 13 <> 0 AS ok, reasons <> '' AS triggered, text_length / 100.0::DOUBLE AS ms FROM q)
SELECT count(*) AS total, count(*) FILTER (ok) AS ok, count(*) FILTER (NOT ok) AS fail, count(*) FILTER (ok AND NOT triggered) AS gate_pass,
  count(*) FILTER (ok AND triggered) AS gate_soft_fail, round(avg(ms) FILTER (ok), 1) AS ms_avg, round(sum(ms) FILTER (ok), 1) AS ms_sum,
  round(quantile_cont(ms, 0.5) FILTER (ok), 1) AS ms_p50, round(max(ms) FILTER (ok), 1) AS ms_max FROM r
""")
def _(t: Tables):
    runs = quality(t).select(
        (F.col("doc_id") % 13 != 0).alias("ok"), "triggered", (F.col("text_length") / 100.0).alias("ms")
    )
    return profile.parse_summary(runs)


CONVERSIONS = """c AS (SELECT text AS markdown, CASE doc_id % 10 WHEN 0 THEN repeat('x', 70) WHEN 1 THEN 'locked ' || lang END AS error FROM documents)"""


def conversions(t: Tables):
    slot = F.col("doc_id") % 10
    error = F.when(slot == 0, F.repeat(F.lit("x"), F.lit(70))).when(slot == 1, F.concat(F.lit("locked "), "lang"))
    return t.documents.select(F.col("text").alias("markdown"), error.alias("error"))


@query("conversion_failures", "A16", f"WITH {CONVERSIONS} SELECT error AS reason, count(*) AS documents FROM c WHERE error IS NOT NULL GROUP BY 1")
def _(t: Tables):
    return profile.conversion_failures(conversions(t))


@query("conversion_sizes", "A16", f"""
WITH {CONVERSIONS} SELECT count(*) FILTER (error IS NULL) AS converted, count(error) AS failed, min(length(markdown)) FILTER (error IS NULL) AS min_chars,
  quantile_cont(length(markdown), 0.5) FILTER (error IS NULL) AS median_chars, max(length(markdown)) FILTER (error IS NULL) AS max_chars FROM c
""")
def _(t: Tables):
    return profile.conversion_sizes(conversions(t))


OUTCOME_NAMES = ("GCS_READY", "SKIPPED", "EXCLUDED", "UNCHANGED", "HASH_UNCHANGED", "DELETE_PENDING", "SPLIT_QUEUED", "DLQ", "FAILED")


@query("status_by_extension", "A17", f"""
WITH {PLANNED} SELECT lower(regexp_extract(name, '\\.[^.]*$')) AS extension, {', '.join(f"count(*) FILTER (disposition = '{s}') AS {s}" for s in OUTCOME_NAMES)}
FROM planned GROUP BY 1
""")
def _(t: Tables):
    rows = planned(t).select("name", F.col("disposition").alias("status"))
    return profile.status_by_extension(rows, OUTCOME_NAMES)


@query("searchability", "A17", """
SELECT count(*) AS documents, count(*) FILTER (status IN ('SKIPPED', 'EXCLUDED')) AS unsearchable, count(*) FILTER (status = 'FAILED') AS sidecar_only FROM v_state
""")
def _(t: Tables):
    marked = t.v_state.withColumn("error", F.when(F.col("status") == "FAILED", "NO_BODY_EXTRACTOR:x").otherwise(F.col("error")))
    return profile.searchability(marked)


@query("problem_documents", "A17", f"WITH {PLANNED} SELECT file_id, disposition AS status, reason AS detail FROM planned WHERE disposition IN ('SPLIT_QUEUED', 'DLQ', 'FAILED')")
def _(t: Tables):
    return profile.problems(planned(t).select("file_id", F.col("disposition").alias("status"), F.col("reason").alias("error")))


@query("corpus_hygiene", "A19", f"""
WITH {STATE} SELECT count(*) AS documents, count(*) FILTER (regexp_matches(coalesce(path, name), '[05]\\.pdf$')) AS copies,
  count(*) FILTER (regexp_matches(coalesce(path, name), 'name 1')) AS drafts, count(*) FILTER (coalesce(error, '') <> '') AS without_body FROM st WHERE status = 'INDEXED'
""")
def _(t: Tables):
    return profile.hygiene(full_state(t), r"[05]\.pdf\z", "name 1")


@query("bundle_sizes", "A19", """
WITH b AS (SELECT bundle, count(*) AS files FROM v_state WHERE status = 'INDEXED' AND bundle <> '' GROUP BY 1)
SELECT count(*) AS bundles, sum(files) AS documents, round(avg(files), 6) AS mean_files, quantile_cont(files, 0.5) AS median_files, max(files) AS max_files,
  round(count(*) FILTER (files >= 2) / count(*), 6) AS share_of_two_or_more FROM b
""")
def _(t: Tables):
    rows = profile.bundle_sizes(t.v_state)
    return rows.withColumns({c: F.round(c, 6) for c in ("mean_files", "share_of_two_or_more")})


@query("filtered_logs", "P26", """
SELECT event_id, service, severity FROM v_logs WHERE service IN ('sync', 'parser') AND severity IN ('WARNING', 'ERROR') AND (contains(message, '7') OR contains(query_text, '7'))
""")
def _(t: Tables):
    rows = profile.filter_logs(t.v_logs, ("sync", "parser"), "warning", "7", ("message", "query_text"))
    return rows.select("event_id", "service", "severity")


@query("repeat_queries", "A20", """
WITH c AS (SELECT query_text, count(*) AS n FROM v_logs WHERE service = 'search' GROUP BY 1)
SELECT sum(n) AS calls, count(*) AS distinct_queries, sum(n) - count(*) AS repeats, max(n) AS max_repeat FROM c
""")
def _(t: Tables):
    return profile.repeat_profile(t.v_logs.filter(F.col("service") == "search"))


@query("query_bursts", "A20 X9", """
WITH g AS (SELECT query_text, ts, event_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY query_text ORDER BY ts, event_id) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens FROM v_logs),
n AS (SELECT *, sum(opens) OVER (PARTITION BY query_text ORDER BY ts, event_id) AS burst FROM g)
SELECT query_text, burst, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS started, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS ended, count(*) AS calls FROM n GROUP BY 1, 2
""")
def _(t: Tables):
    bursts = profile.query_bursts(t.v_logs, 6 * 3600)
    return bursts.select(
        "query_text", "burst", F.date_format("started", "yyyy-MM-dd HH:mm:ss").alias("started"),
        F.date_format("ended", "yyyy-MM-dd HH:mm:ss").alias("ended"), "calls",
    )


@query("query_sessions", "X9", """
WITH g AS (SELECT query_text, ts, event_id, CASE WHEN ts - lag(ts) OVER (PARTITION BY query_text ORDER BY ts, event_id) <= INTERVAL 1 HOUR THEN 0 ELSE 1 END AS opens FROM v_logs),
n AS (SELECT *, sum(opens) OVER (PARTITION BY query_text ORDER BY ts, event_id) AS burst FROM g)
SELECT query_text, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS started, count(*) AS calls FROM n GROUP BY query_text, burst
""")
def _(t: Tables):
    sessions = t.v_logs.groupBy("query_text", F.session_window("ts", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("calls"))
    return sessions.select("query_text", F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("started"), "calls")


@query("answered_calls", "X6", """
WITH RECURSIVE calls AS (SELECT query_text, epoch_us(ts) AS us, event_id, row_number() OVER (PARTITION BY query_text ORDER BY ts, event_id) AS i FROM v_logs),
fold AS (SELECT query_text, event_id, i, us AS answered_at, TRUE AS answered FROM calls WHERE i = 1
  UNION ALL SELECT c.query_text, c.event_id, c.i, CASE WHEN c.us - f.answered_at > 14400000000 THEN c.us ELSE f.answered_at END, c.us - f.answered_at > 14400000000
  FROM fold f JOIN calls c ON c.query_text = f.query_text AND c.i = f.i + 1)
SELECT query_text, event_id, answered FROM fold
""")
def _(t: Tables):
    calls = t.v_logs.select("query_text", "ts", "event_id")
    return profile.answered_calls(calls, ["query_text"], 4 * 3600).select("query_text", "event_id", "answered")


@query("silent_periods", "X7", """
WITH s AS (SELECT service, ts, event_id, lead(ts) OVER (PARTITION BY service ORDER BY ts, event_id) AS until FROM v_logs WHERE severity = 'WARNING')
SELECT service, strftime(ts, '%Y-%m-%d %H:%M:%S') AS since, strftime(until, '%Y-%m-%d %H:%M:%S') AS until FROM s WHERE until - ts > INTERVAL 30 MINUTE
""")
def _(t: Tables):
    done = t.v_logs.filter(F.col("severity") == "WARNING")
    gaps = profile.silent_periods(done, ["service"], 30 * 60)
    return gaps.select("service", *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("since", "until")])


@query("hourly_alerts", "X8", """
WITH h AS (SELECT *, date_trunc('hour', ts) AS hour FROM v_logs WHERE severity = 'ERROR' OR contains(message, '"k": 9')),
f AS (SELECT *, row_number() OVER (PARTITION BY service, hour ORDER BY ts, event_id) AS nth, count(*) OVER (PARTITION BY service, hour) AS matches FROM h)
SELECT service, strftime(hour, '%Y-%m-%d %H:%M:%S') AS hour, event_id, severity, matches FROM f WHERE nth = 1
""")
def _(t: Tables):
    alerts = profile.hourly_alerts(t.v_logs, r'"k": 9')
    return alerts.select("service", F.date_format("hour", "yyyy-MM-dd HH:mm:ss").alias("hour"), "event_id", "severity", "matches")
