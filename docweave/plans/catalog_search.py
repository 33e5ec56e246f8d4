"""Queries of search, answers and retrieval quality.

The test vectors lie far apart, so the threshold is 0.80 here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.functions import lexical, paths
from docweave.operators import answer as answers
from docweave.operators import evaluate, postprocess, rerank, retrieve
from docweave.options import SearchOptions
from docweave.plans import search as jobs
from docweave.plans.catalog_text import FINGERPRINT_SQL, LABEL_SQL, TOKENS_SQL, file_id_sql, terms_sql
from docweave.plans.registry import query
from docweave.sources.views import Tables

LIMITS = {"top_k_max": 20, "fetch_max": 60, "max_chunks_per_file": 3, "max_total_chunks": 15}
OPTS = SearchOptions(distance_threshold=0.80, **LIMITS)


def state_of(t: Tables) -> DataFrame:
    return t.v_state.withColumn("source_uri", F.lit(None).cast("string"))


def chunks_of(t: Tables) -> DataFrame:
    return jobs.with_optional(t.v_chunks)


# Each step of a search as one common table expression.
NEAR = """
near_all AS (
  SELECT q.query_id, c.chunk_id, abs(round(list_cosine_distance(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 6)) AS distance
  FROM v_queries q, v_chunks c),
near AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, chunk_id) - 1 AS vec_rank
                 FROM near_all WHERE distance <= 0.80) x WHERE vec_rank < 15)"""
CANDIDATES = f"""{NEAR},
cand AS MATERIALIZED (
  SELECT n.query_id, n.chunk_id, n.distance, n.vec_rank, c.display_name, c.text, {TOKENS_SQL.format('c.text')} AS tokens
  FROM near n JOIN v_chunks c USING (chunk_id))"""
BM25 = f"""{CANDIDATES},
sized AS (SELECT *, greatest(len(tokens), 1) AS length, count(*) OVER (PARTITION BY query_id) AS n,
                 avg(greatest(len(tokens), 1)) OVER (PARTITION BY query_id) AS mean_length FROM cand),
tf AS (SELECT query_id, chunk_id, n, length, mean_length, term, count(*) AS tf
       FROM (SELECT query_id, chunk_id, n, length, mean_length, unnest(tokens) AS term FROM sized) x GROUP BY ALL),
asked AS (SELECT query_id, unnest(list_distinct({TOKENS_SQL.format('query_text')})) AS term FROM v_queries),
stats AS (SELECT tf.*, count(*) OVER (PARTITION BY query_id, term) AS df FROM tf JOIN asked USING (query_id, term)),
bm AS (SELECT query_id, chunk_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * (tf * 2.5)
         / (tf + 1.5 * (1 - 0.75 + 0.75 * length / mean_length))), 9) AS bm25 FROM stats GROUP BY 1, 2)"""
RANKED = f"""{BM25},
lex AS (SELECT c.query_id, c.chunk_id, c.distance, c.vec_rank, c.display_name, c.text, coalesce(b.bm25, 0.0) AS bm25,
          row_number() OVER (PARTITION BY c.query_id ORDER BY coalesce(b.bm25, 0.0) DESC, c.vec_rank) - 1 AS lex_rank
        FROM cand c LEFT JOIN bm b USING (query_id, chunk_id)),
fused AS (SELECT *, 1.0::DOUBLE / (60.0::DOUBLE + vec_rank) + 1.0::DOUBLE / (60.0::DOUBLE + lex_rank) AS rrf FROM lex),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rrf DESC, vec_rank) - 1 AS position FROM fused)"""
HITS = rf"""{RANKED},
hits AS (SELECT query_id, chunk_id, distance, position, display_name, {file_id_sql('display_name')} AS file_id,
           display_name LIKE '%.meta.md' AS is_sidecar,
           trim(regexp_replace(text, '\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(9) || chr(10)) AS text FROM ranked)"""
SERVABLE = f"""{HITS},
coerced AS (SELECT * REPLACE (status AS status) FROM v_state),
served AS (SELECT h.*, s.file_id IS NOT NULL AS has_state, s.name AS s_name, s.path AS s_path, s.bundle AS s_bundle,
             s.modified_time AS s_time, s.drive_id AS s_drive
           FROM hits h LEFT JOIN coerced s USING (file_id)
           WHERE NOT coalesce(s.status IN ('SKIPPED', 'EXCLUDED', 'DELETED') OR (s.status = 'FAILED'
             AND coalesce(s.error, '') LIKE 'out_of_folder_scope_cleanup_failed%'), FALSE))"""
UNSHADOWED = f"""{SERVABLE},
bodies AS (SELECT * FROM (SELECT *, bool_or(NOT is_sidecar) OVER (PARTITION BY query_id, file_id) AS body FROM served) x
           WHERE NOT (is_sidecar AND body))"""
UNIQUE = f"""{UNSHADOWED},
uniq AS (SELECT * FROM (SELECT *, {FINGERPRINT_SQL.format('text')} AS fp,
           row_number() OVER (PARTITION BY query_id, {FINGERPRINT_SQL.format('text')} ORDER BY position) AS nth FROM bodies) x
         WHERE fp = '' OR nth = 1)"""
FILES = f"""{UNIQUE},
first_seen AS (SELECT *, row_number() OVER (PARTITION BY query_id, file_id ORDER BY position) AS ordinal,
            min(position) OVER (PARTITION BY query_id, file_id) AS first_position FROM uniq),
files AS (SELECT *, dense_rank() OVER (PARTITION BY query_id ORDER BY first_position) AS file_rank FROM first_seen)"""


def spent_sql(budget: str) -> str:
    return f"""{FILES},
chosen AS (SELECT *, max(file_rank) OVER (PARTITION BY query_id) AS n_files,
             row_number() OVER (PARTITION BY query_id ORDER BY ordinal, file_rank) AS round_no
           FROM files WHERE ordinal <= 3 AND file_rank <= 5),
spent AS (SELECT * FROM chosen WHERE round_no <= greatest({budget}, n_files))"""


SPENT = spent_sql("15")
MERGED = f"""{SPENT},
merged AS (SELECT query_id, file_id, string_agg(text, chr(10) || chr(10) || '[...]' || chr(10) || chr(10) ORDER BY ordinal) AS text,
             count(*) AS chunk_count, min_by(distance, ordinal) AS distance, min_by(display_name, ordinal) AS display_name,
             min_by(has_state, ordinal) AS has_state, min_by(s_name, ordinal) AS s_name, max(s_path) AS s_path, max(s_bundle) AS s_bundle,
             max(s_time) AS s_time, max(s_drive) AS s_drive,
             row_number() OVER (PARTITION BY query_id ORDER BY min(file_rank)) AS rank FROM spent GROUP BY query_id, file_id)"""
NAME_SQL = """CASE WHEN nullif(s_name, '') IS NULL AND regexp_matches(coalesce(nullif(display_name, ''), file_id), '\\.(pdf|md|txt|pptx|xlsx)$')
  THEN coalesce(nullif(s_path, ''), coalesce(nullif(display_name, ''), file_id))
  ELSE coalesce(nullif(s_name, ''), nullif(display_name, ''), file_id) END"""
RESULTS = f"""{MERGED},
named AS (SELECT m.*, {NAME_SQL} AS name, q.query_text FROM merged m JOIN v_queries q USING (query_id)),
results AS (SELECT query_id, rank, text, distance AS score, file_id, name, s_path AS path, s_bundle AS bundle, s_time AS modified_time,
    s_drive AS drive_id, {LABEL_SQL.format(name='name', bundle='s_bundle', path='s_path', file_id='file_id')} AS label,
    {terms_sql('query_text')} AS terms, {TOKENS_SQL.format('text')} AS tokens FROM named),
covered AS (SELECT *, list_filter(terms, lambda w: list_contains(tokens, lower(w))) AS matched,
                   list_filter(terms, lambda w: NOT list_contains(tokens, lower(w))) AS missing FROM results)"""


def candidates(t: Tables) -> DataFrame:
    return jobs.candidates(jobs.with_limits(t.v_queries, OPTS), chunks_of(t), OPTS)


def ranked(t: Tables) -> DataFrame:
    return rerank.rrf_rerank(candidates(t), t.v_queries)


def served(t: Tables) -> DataFrame:
    hits = postprocess.hit_columns(ranked(t))
    return postprocess.drop_unservable(postprocess.with_state(hits, state_of(t)))


def results(t: Tables) -> DataFrame:
    return jobs.search(t.v_queries, t.v_chunks, state_of(t), OPTS)


@query("nearest_chunks", "J11 L1 W1 P20 C11", f"WITH {NEAR} SELECT query_id, chunk_id, distance, vec_rank FROM near")
def _(t: Tables):
    return retrieve.nearest_chunks(t.v_queries, t.v_chunks, OPTS)


@query("nearest_chunks_default_threshold", "P20", f"""
WITH {NEAR.replace('0.80', '0.30')} SELECT query_id, chunk_id, distance, vec_rank FROM near
""")
def _(t: Tables):
    return retrieve.nearest_chunks(t.v_queries, t.v_chunks, SearchOptions(**LIMITS))


@query("search_limits", "P21", """
SELECT event_id, CASE WHEN k = 0 THEN 5 ELSE least(greatest(k, 1), 20) END AS top_k,
       least(60, 3 * CASE WHEN k = 0 THEN 5 ELSE least(greatest(k, 1), 20) END) AS fetch_k
FROM (SELECT event_id, CAST(user_id % 30 AS INTEGER) - 2 AS k FROM events) x
""")
def _(t: Tables):
    asked = t.events.select("event_id", ((F.col("user_id") % 30).cast("int") - 2).alias("top_k"))
    return jobs.with_limits(asked, SearchOptions(**LIMITS))


@query("bm25_statistics", "A6 J12", f"""
WITH {BM25} SELECT query_id, chunk_id, term, tf, df, n, length, round(mean_length, 6) AS mean_length FROM stats
""")
def _(t: Tables):
    return rerank.term_statistics(candidates(t), t.v_queries).select(
        "query_id", "chunk_id", "term", "tf", "df", "n", "length", F.round("mean_length", 6).alias("mean_length")
    )


@query("bm25_scores", "C10 J12", f"WITH {BM25} SELECT query_id, chunk_id, round(bm25, 5) AS bm25 FROM bm")
def _(t: Tables):
    scores = rerank.bm25_scores(candidates(t), t.v_queries)
    return scores.select("query_id", "chunk_id", F.round("bm25", 5).alias("bm25"))


@query("rank_fusion", "W1 W2 W3", f"""
WITH {RANKED} SELECT query_id, chunk_id, vec_rank, lex_rank, round(rrf, 6) AS rrf, position FROM ranked
""")
def _(t: Tables):
    return ranked(t).select(
        "query_id", "chunk_id", "vec_rank", "lex_rank", F.round("rrf", 6).alias("rrf"), "position"
    )


@query("servable_hits", "P19 J5 L2", f"WITH {SERVABLE} SELECT query_id, chunk_id, file_id, has_state FROM served")
def _(t: Tables):
    return served(t).select("query_id", "chunk_id", "file_id", "has_state")


@query("unshadowed_hits", "J6", f"WITH {UNSHADOWED} SELECT query_id, chunk_id, is_sidecar FROM bodies")
def _(t: Tables):
    return postprocess.drop_shadowed_sidecars(served(t)).select("query_id", "chunk_id", "is_sidecar")


@query("unrepeated_hits", "W4", f"WITH {UNIQUE} SELECT query_id, chunk_id, position FROM uniq")
def _(t: Tables):
    bodies = postprocess.drop_shadowed_sidecars(served(t))
    return postprocess.drop_repeated_texts(bodies).select("query_id", "chunk_id", "position")


@query("file_ranks", "W5 W6", f"WITH {FILES} SELECT query_id, chunk_id, ordinal, file_rank FROM files")
def _(t: Tables):
    unique = postprocess.drop_repeated_texts(postprocess.drop_shadowed_sidecars(served(t)))
    return postprocess.rank_files(unique).select("query_id", "chunk_id", "ordinal", "file_rank")


@query("chunk_budget", "W7", f"WITH {spent_sql('7')} SELECT query_id, chunk_id, ordinal, file_rank FROM spent")
def _(t: Tables):
    unique = postprocess.drop_repeated_texts(postprocess.drop_shadowed_sidecars(served(t)))
    tight = SearchOptions(distance_threshold=0.80, **LIMITS | {"max_total_chunks": 7})
    spent = postprocess.spend_budget(postprocess.rank_files(unique), F.lit(5), tight)
    return spent.select("query_id", "chunk_id", "ordinal", "file_rank")


@query("merged_documents", "W8 W9", f"WITH {MERGED} SELECT query_id, rank, file_id, chunk_count, distance, text FROM merged")
def _(t: Tables):
    return postprocess.merge_hits(served(t), OPTS).select(
        "query_id", "rank", "file_id", "chunk_count", "distance", "text"
    )


@query("display_names", "P27", f"""
WITH x AS (SELECT c.chunk_id, c.display_name, {file_id_sql('display_name')} AS file_id FROM v_chunks c),
y AS (SELECT x.*, s.name AS s_name, s.path AS s_path FROM x LEFT JOIN v_state s USING (file_id))
SELECT chunk_id, {NAME_SQL} AS name FROM y
""")
def _(t: Tables):
    hits = postprocess.with_state(postprocess.hit_columns(chunks_of(t), normalise=False), state_of(t))
    name = paths.display_name(
        F.col("state_name"), F.col("display_name"), F.col("file_id"), F.col("state_path")
    )
    return hits.select("chunk_id", name.alias("name"))


def _flat(rows: DataFrame) -> DataFrame:
    source = F.col("source")
    return rows.select(
        "query_id", "rank", "text", "score", source["file_id"].alias("file_id"), source["name"].alias("name"),
        source["path"].alias("path"), source["bundle"].alias("bundle"),
        source["modified_time"].alias("modified_time"), source["drive_id"].alias("drive_id"),
        source["label"].alias("label"), F.array_join("matched_terms", " ").alias("matched"),
        F.array_join("missing_terms", " ").alias("missing"),
    )


@query("search_results", "P28 C8 C9 search", f"""
WITH {RESULTS} SELECT query_id, rank, text, score, file_id, name, path, bundle, modified_time, drive_id, label,
  array_to_string(matched, ' ') AS matched, array_to_string(missing, ' ') AS missing FROM covered
""")
def _(t: Tables):
    return _flat(results(t))


@query("answer_payload", "A7 C6 answer", f"""
WITH {RESULTS},
grouped AS (SELECT query_id, string_agg('[' || CAST(rank AS VARCHAR) || '] ' || label || chr(10) || text,
              chr(10) || chr(10) || '---' || chr(10) || chr(10) ORDER BY rank) AS context, count(*) AS document_count,
              string_agg(file_id, ' ' ORDER BY rank) AS cited, flatten(list(list_transform(matched, lambda w: lower(w)))) AS found,
              bool_or(len(missing) = 0) AS whole FROM covered GROUP BY 1)
SELECT q.query_id, coalesce(context, '') AS context, coalesce(document_count, 0) AS document_count, coalesce(cited, '') AS cited,
       array_to_string(list_filter({terms_sql('q.query_text')}, lambda w: NOT list_contains(coalesce(found, []), lower(w))), ' ') AS uncovered,
       CASE WHEN document_count IS NULL THEN 'none' WHEN whole THEN 'full' ELSE 'partial' END AS coverage
FROM v_queries q LEFT JOIN grouped USING (query_id)
""")
def _(t: Tables):
    payload = answers.build_answers(results(t), t.v_queries)
    cited = F.array_join(F.transform("citations", lambda c: c["file_id"]), " ")
    return payload.select(
        "query_id", "context", "document_count", cited.alias("cited"),
        F.array_join("uncovered_terms", " ").alias("uncovered"), "coverage",
    )


EVALUATED = f"""{RESULTS},
items AS (SELECT n, q, min(type) AS type, list(DISTINCT file_id) AS accept FROM v_golden GROUP BY 1, 2),
golden AS (SELECT i.*, s.name, s.bundle FROM items i LEFT JOIN v_state s ON s.file_id = list_min(i.accept)),
joined AS (SELECT g.n, g.q, g.type, g.accept, g.name AS g_name, g.bundle AS g_bundle, c.rank, c.score, c.file_id, c.name, c.bundle
           FROM golden g LEFT JOIN covered c ON c.query_id = g.n),
scored AS (SELECT n, q, type,
    min(rank) FILTER (list_contains(accept, file_id)) AS rank,
    min(rank) FILTER (lower(trim(coalesce(name, ''))) = lower(trim(coalesce(g_name, '')))) AS same_doc_rank,
    min(rank) FILTER (coalesce(g_bundle, '') <> '' AND trim(coalesce(bundle, '')) = trim(g_bundle)) AS bundle_rank,
    min_by(score, rank) FILTER (list_contains(accept, file_id)) AS hit_score, min_by(score, rank) AS top_score,
    count(rank) AS n_hits, count(DISTINCT nullif(lower(trim(coalesce(name, ''))), '')) FILTER (rank IS NOT NULL) AS distinct_names
  FROM joined GROUP BY n, q, type)"""


def metrics_sql(rank: str) -> str:
    return f"""count(*) AS n, count(*) FILTER ({rank} <= 1) AS hit1, count(*) FILTER ({rank} <= 3) AS hit3,
  count(*) FILTER ({rank} <= 5) AS hit5, round(count(*) FILTER ({rank} <= 1) / count(*), 3) AS hit1_rate,
  round(count(*) FILTER ({rank} <= 5) / count(*), 3) AS hit5_rate,
  round(avg(coalesce(1.0::DOUBLE / {rank}, 0.0)), 3) AS mrr"""


def scored(t: Tables) -> DataFrame:
    items = evaluate.gather_answers(t.v_golden)
    golden = items.join(t.v_state.select("file_id", "name", "bundle"), "file_id", "left")
    source = F.col("source")
    found = results(t).select(
        F.col("query_id").alias("n"), "rank", "score", source["file_id"].alias("file_id"),
        source["name"].alias("name"), source["bundle"].alias("bundle"),
    )
    return evaluate.score_items(golden, found)


@query("golden_pairs", "U4 v_golden", "SELECT n, q, type, file_id FROM v_golden")
def _(t: Tables):
    return t.v_golden


@query("golden_items", "J13 U4", f"""
WITH {EVALUATED} SELECT n, type, rank, same_doc_rank, bundle_rank, hit_score, top_score, n_hits, distinct_names FROM scored
""")
def _(t: Tables):
    return scored(t).drop("q")


@query("golden_metrics", "A8", f"""
WITH {EVALUATED}, long AS (SELECT 'strict' AS criterion, rank AS found FROM scored UNION ALL
  SELECT 'same_doc', same_doc_rank FROM scored UNION ALL SELECT 'bundle', bundle_rank FROM scored)
SELECT criterion, {metrics_sql('found')} FROM long GROUP BY criterion
""")
def _(t: Tables):
    return evaluate.overall(scored(t))


@query("golden_metrics_by_type", "A9", f"WITH {EVALUATED} SELECT type, {metrics_sql('same_doc_rank')} FROM scored GROUP BY type")
def _(t: Tables):
    return evaluate.by_type(scored(t))


@query("golden_slots", "A9", f"""
WITH {EVALUATED} SELECT count(*) FILTER (n_hits = 0) AS empty_results, sum(n_hits) AS slots,
  sum(n_hits - distinct_names) AS wasted FROM scored
""")
def _(t: Tables):
    return evaluate.slots(scored(t))


@query("golden_metrics_by_segment", "A10", f"""
WITH {EVALUATED} SELECT CASE WHEN n <= 38 THEN 'old' ELSE 'new' END AS segment, {metrics_sql('rank')} FROM scored GROUP BY 1
""")
def _(t: Tables):
    return evaluate.by_segment(scored(t))


@query("hit_distances", "A11", f"""
WITH {EVALUATED}, h AS (SELECT hit_score AS v, row_number() OVER (ORDER BY hit_score) AS i, count(*) OVER () AS n
  FROM scored WHERE hit_score IS NOT NULL),
p AS (SELECT *, (n + 1) * 0.95::DOUBLE AS target, greatest(1, least(floor((n + 1) * 0.95::DOUBLE), n - 1)) AS j FROM h)
SELECT min(v) AS min_score, quantile_cont(v, 0.5) AS median_score, quantile_cont(v, 0.95) AS p95_inclusive, max(v) AS max_score,
  round(max(v) FILTER (i = j) + (max(v) FILTER (i = j + 1) - max(v) FILTER (i = j)) * (max(target) - max(j)), 6) AS p95_exclusive
FROM p
""")
def _(t: Tables):
    rows = evaluate.distance_distribution(scored(t))
    return rows.withColumn("p95_exclusive", F.round("p95_exclusive", 6))
