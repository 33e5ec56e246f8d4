"""SQL text of the views, in the form DuckDB runs.

``Tables`` derives the same views with the DataFrame API.
"""

VIEWS = {
    "v_folders": """
SELECT concat('R', CAST(r_regionkey AS STRING)) AS folder_id, CAST(NULL AS STRING) AS parent_id, r_name AS name FROM region
UNION ALL SELECT concat('N', CAST(n_nationkey AS STRING)), concat('R', CAST(n_regionkey AS STRING)), n_name FROM nation
UNION ALL SELECT concat('C', CAST(c_custkey AS STRING)), concat('N', CAST(c_nationkey AS STRING)), c_name FROM customer
""",
    "v_files": """
SELECT concat('file_', lpad(CAST(o_orderkey AS STRING), 8, '0')) AS file_id,
       concat('C', CAST(o_custkey AS STRING)) AS parent_id,
       concat('drive_', CAST(o_custkey % 3 AS STRING)) AS drive_id,
       concat('order ', CAST(o_orderkey AS STRING),
              CASE o_orderkey % 8 WHEN 0 THEN '.pdf' WHEN 1 THEN '.hwp' WHEN 2 THEN '.HWPX' WHEN 3 THEN '.xlsx'
                   WHEN 4 THEN '.txt' WHEN 5 THEN '.zip' WHEN 6 THEN '' ELSE '.png' END) AS name,
       CASE o_orderkey % 8 WHEN 0 THEN 'application/pdf' WHEN 1 THEN 'application/x-hwp' WHEN 2 THEN 'application/octet-stream'
            WHEN 3 THEN 'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet' WHEN 4 THEN 'text/plain'
            WHEN 5 THEN 'application/zip' WHEN 6 THEN 'application/vnd.google-apps.document' ELSE 'image/png' END AS mime_type,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(floor(o_totalprice * 200) AS BIGINT) END AS size_bytes,
       CAST(o_orderdate AS STRING) AS modified_time, o_orderstatus = 'P' AS trashed
FROM orders
""",
    "v_chunks": """
SELECT doc_id AS chunk_id, CAST(floor(doc_id / 3) AS BIGINT) AS f,
       concat('doc_', lpad(CAST(CAST(floor(doc_id / 3) AS BIGINT) AS STRING), 8, '0'),
              CASE WHEN doc_id % 3 = 2 AND CAST(floor(doc_id / 3) AS BIGINT) % 4 = 0 THEN '.meta.md'
                   WHEN CAST(floor(doc_id / 3) AS BIGINT) % 5 = 1 THEN concat('.part', CAST(doc_id % 3 + 1 AS STRING), '.pdf')
                   ELSE '.md' END) AS display_name,
       d.text AS text, e.embedding AS embedding
FROM documents d CROSS JOIN (SELECT count(*) AS n FROM embeddings) k JOIN embeddings e ON e.vec_id = d.doc_id % k.n
""",
    "v_queries": """
SELECT b.item_id AS query_id, b.text AS query_text, e.embedding AS embedding
FROM benchmark b CROSS JOIN (SELECT count(*) AS n FROM embeddings) k JOIN embeddings e ON e.vec_id = b.item_id % k.n
""",
    "v_state": """
SELECT concat('doc_', lpad(CAST(f AS STRING), 8, '0')) AS file_id, concat('drive_', CAST(f % 3 AS STRING)) AS drive_id,
       CASE WHEN f % 20 = 7 THEN 'content.txt' WHEN f % 20 = 8 THEN '' ELSE concat('name ', CAST(f AS STRING), '.pdf') END AS name,
       CASE f % 20 WHEN 0 THEN 'DELETED' WHEN 1 THEN 'SKIPPED' WHEN 2 THEN 'EXCLUDED' WHEN 3 THEN 'FAILED' WHEN 4 THEN 'FAILED'
            WHEN 5 THEN 'PARSED' WHEN 9 THEN 'NEW_VALUE' ELSE 'INDEXED' END AS status,
       CASE f % 20 WHEN 2 THEN 'out_of_folder_scope' WHEN 3 THEN 'out_of_folder_scope_cleanup_failed: x' WHEN 4 THEN 'timeout' END AS error,
       CASE WHEN f % 7 = 0 THEN '' ELSE concat('bundle ', CAST(f % 13 AS STRING)) END AS bundle,
       CASE WHEN f % 9 = 0 THEN NULL ELSE concat('root/bundle ', CAST(f % 13 AS STRING), '/name ', CAST(f AS STRING), '.pdf') END AS path,
       CASE WHEN f % 3 = 0 THEN 'STUDENT' WHEN f % 3 = 1 THEN 'STAFF' END AS audience,
       concat('2024-01-', lpad(CAST(f % 28 + 1 AS STRING), 2, '0'), ' 00:00:00') AS modified_time
FROM (SELECT DISTINCT CAST(floor(doc_id / 3) AS BIGINT) AS f FROM documents) x WHERE f % 20 <> 6
""",
    "v_changes": """
SELECT event_id AS seq, concat('drive_', CAST(user_id % 3 AS STRING)) AS drive_id,
       CASE WHEN event_id % 97 = 0 THEN '' ELSE concat('doc_', lpad(CAST(user_id AS STRING), 8, '0')) END AS file_id,
       concat('C', CAST(user_id AS STRING)) AS parent_id, event_type = 'error' AS removed,
       CASE event_id % 5 WHEN 0 THEN 'application/pdf' WHEN 1 THEN 'application/haansofthwp' WHEN 2 THEN 'text/html'
            WHEN 3 THEN 'image/png' ELSE 'application/vnd.google-apps.spreadsheet' END AS mime_type,
       CAST(CAST(floor(value * 200000) AS BIGINT) AS STRING) AS size, ts AS event_ts
FROM events
""",
    "v_golden": """
SELECT b.item_id AS n, b.text AS q, d.lang AS type,
       concat('doc_', lpad(CAST(CAST(floor(d.doc_id / 3) AS BIGINT) AS STRING), 8, '0')) AS file_id
FROM benchmark b JOIN documents d ON contains(d.text, b.text)
""",
    "v_cells": """
SELECT t.table_id, t.row_no, c.col_no,
       CASE c.col_no WHEN 1 THEN CASE WHEN t.l_returnflag = 'N' THEN '' ELSE t.l_returnflag END
            WHEN 2 THEN CAST(t.l_partkey AS STRING) WHEN 3 THEN '' ELSE CAST(t.l_suppkey AS STRING) END AS cell_text,
       CASE WHEN c.col_no = 1 AND t.l_returnflag = 'R' THEN 2 ELSE 1 END AS row_span,
       CASE WHEN c.col_no = 2 AND t.l_linestatus = 'F' THEN 2 ELSE 1 END AS col_span
FROM (SELECT l_orderkey AS table_id, l_returnflag, l_linestatus, l_partkey, l_suppkey,
             row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS row_no
      FROM lineitem) t CROSS JOIN (SELECT 1 AS col_no UNION ALL SELECT 2 UNION ALL SELECT 3 UNION ALL SELECT 4) c
""",
    "v_pages_bytes": """
SELECT l_orderkey AS doc, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice) AS page_no,
       CAST(floor(l_extendedprice * 100) AS BIGINT) AS bytes FROM lineitem
""",
    "v_logs": """
SELECT event_id, ts, CASE user_id % 3 WHEN 0 THEN 'sync' WHEN 1 THEN 'parser' ELSE 'search' END AS service,
       CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'WARNING' ELSE 'INFO' END AS severity,
       props AS message, concat(event_type, ' ', CAST(user_id AS STRING)) AS query_text, 5 AS top_k FROM events
""",
}
