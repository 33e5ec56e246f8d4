"""Queries of the column expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from docweave.functions import hashing, ids, lexical, paths, text, values
from docweave.operators import chunking
from docweave.plans.registry import query
from docweave.sources.views import Tables

SUFFIX_SQL = (
    r"(?i)(\.meta\.md|\.markdown|\.md|\.pdf|\.txt|\.html|\.htm|\.hwpx|\.hwp|\.docx|\.doc|\.pptx"
    r"|\.xlsx|\.xls|\.csv|\.rtf|\.bin)$"
)


def file_id_sql(name: str) -> str:
    base = f"trim(regexp_extract({name}, '[^/]*$'), ' \t\n\r')"
    stem = rf"regexp_replace(regexp_replace({base}, '{SUFFIX_SQL}', ''), '(?i)\.part[0-9]+$', '')"
    return f"(CASE WHEN {base} = '' THEN 'unknown' ELSE {stem} END)"


TOKENS_SQL = "regexp_extract_all(lower({0}), '[가-힣]+|[a-zA-Z]+|[0-9]+')"
WORDS_SQL = "regexp_extract_all({0}, '[가-힣]+|[a-zA-Z]+|[0-9]+')"


def terms_sql(text_sql: str) -> str:
    """Words of two or more characters, the first spelling of each."""
    long_words = f"list_filter({WORDS_SQL.format(text_sql)}, lambda w: length(w) >= 2)"
    low = f"list_transform({long_words}, lambda w: lower(w))"
    return f"list_filter({long_words}, lambda w, i: list_position({low}, lower(w)) = i)"


FINGERPRINT_SQL = r"trim(regexp_replace(lower({0}), '\s+', ' ', 'g'))"


@query("extract_file_id", "C1", f"""
WITH names AS (
  SELECT 'chunk ' || CAST(chunk_id AS VARCHAR) AS item, 'gs://bucket/sub/' || display_name AS name FROM v_chunks
  UNION ALL SELECT 'file ' || file_id, name FROM v_files)
SELECT item, {file_id_sql('name')} AS file_id FROM names
""")
def _(t: Tables):
    chunks = t.v_chunks.select(
        F.concat(F.lit("chunk "), F.col("chunk_id").cast("string")).alias("item"),
        F.concat(F.lit("gs://bucket/sub/"), "display_name").alias("name"),
    )
    files = t.v_files.select(F.concat(F.lit("file "), "file_id").alias("item"), "name")
    return chunks.unionByName(files).select("item", ids.extract_file_id(F.col("name")).alias("file_id"))


@query("sidecar_flag", "C2", """
SELECT chunk_id, display_name LIKE '%.meta.md' AS is_sidecar FROM v_chunks
""")
def _(t: Tables):
    return t.v_chunks.select("chunk_id", ids.is_sidecar(F.col("display_name")).alias("is_sidecar"))


@query("unescape_page_text", "C3", r"""
SELECT page_id, trim(regexp_replace(regexp_replace(
  replace(replace(replace(replace(html, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&'),
  '\r\n?', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(9) || chr(10) || chr(13)) AS page_text
FROM pages
""")
def _(t: Tables):
    return t.pages.select("page_id", text.unescape_chunk_text(F.col("html")).alias("page_text"))


@query("text_fingerprint", "C4", f"""
SELECT doc_id, {FINGERPRINT_SQL.format('text')} AS fingerprint FROM documents
""")
def _(t: Tables):
    return t.documents.select("doc_id", text.fingerprint(F.col("text")).alias("fingerprint"))


LABEL_SQL = """
CASE WHEN trim(coalesce({name}, '')) = '' THEN coalesce(nullif(trim(coalesce({bundle}, '')), ''), {file_id})
     WHEN trim(coalesce({bundle}, '')) <> '' AND trim({bundle}) <> trim({name})
          AND NOT contains(trim({name}), trim({bundle})) THEN trim({bundle}) || ' / ' || trim({name})
     WHEN trim(coalesce({bundle}, '')) <> '' THEN trim({name})
     WHEN lower(regexp_replace(trim({name}), '\\.[^.]*$', '')) IN ('content', 'index', 'body', 'untitled')
          AND trim(coalesce({path}, '')) <> '' THEN trim({path})
     ELSE trim({name}) END
"""


@query("citation_label", "C5", f"""
SELECT file_id, {LABEL_SQL.format(name='name', bundle='bundle', path='path', file_id='file_id')} AS label FROM v_state
""")
def _(t: Tables):
    label = paths.citation_label(*(F.col(c) for c in ("name", "bundle", "path", "file_id")))
    return t.v_state.select("file_id", label.alias("label"))


@query("text_tokens", "C7", f"""
SELECT doc_id, len({TOKENS_SQL.format('text')}) AS token_count,
       sha256(array_to_string({TOKENS_SQL.format('text')}, ' ')) AS token_hash FROM documents
""")
def _(t: Tables):
    tokens = lexical.tokens(F.col("text"))
    return t.documents.select(
        "doc_id", F.size(tokens).alias("token_count"), F.sha2(F.array_join(tokens, " "), 256).alias("token_hash")
    )


@query("query_terms", "C8", f"""
SELECT item_id, array_to_string({terms_sql('text')}, ' ') AS terms FROM benchmark
""")
def _(t: Tables):
    return t.benchmark.select("item_id", F.array_join(lexical.query_terms(F.col("text")), " ").alias("terms"))


@query("term_coverage", "C9", f"""
WITH pairs AS (
  SELECT a.conv_id, a.turn, {terms_sql('a.text')} AS terms,
         list_distinct({TOKENS_SQL.format('b.text')}) AS tokens
  FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1)
SELECT conv_id, turn,
       array_to_string(list_filter(terms, lambda w: list_contains(tokens, lower(w))), ' ') AS matched,
       array_to_string(list_filter(terms, lambda w: NOT list_contains(tokens, lower(w))), ' ') AS missing
FROM pairs
""")
def _(t: Tables):
    asked = t.conversations.select("conv_id", "turn", lexical.query_terms(F.col("text")).alias("terms"))
    reply = t.conversations.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("reply"))
    pairs = asked.join(reply, ["conv_id", "turn"]).withColumn(
        "found", lexical.matched_terms(F.col("terms"), F.col("reply"))
    )
    return pairs.select(
        "conv_id", "turn", F.array_join("found", " ").alias("matched"),
        F.array_join(F.array_except("terms", "found"), " ").alias("missing"),
    )


@query("content_hash", "C12", """
SELECT doc_id, 'sha256:' || sha256(text) AS content_hash FROM documents
""")
def _(t: Tables):
    return t.documents.select("doc_id", hashing.sha256(F.col("text")).alias("content_hash"))


@query("content_hash_recipes", "C13", """
SELECT c.chunk_id, c.chunk_id % 3 AS kind,
       CASE c.chunk_id % 3 WHEN 0 THEN 'sha256:' || sha256(c.text)
         WHEN 1 THEN 'sha256:' || sha256('sha256:' || sha256(c.text) || '|' || s.path || '|' || s.bundle)
         ELSE 'sha256:' || sha256(s.file_id || '|' || s.path || '|' || s.bundle) END AS content_hash
FROM v_chunks c JOIN v_state s ON s.file_id = 'doc_' || lpad(CAST(c.f AS VARCHAR), 8, '0')
WHERE s.path IS NOT NULL
""")
def _(t: Tables):
    state = t.v_state.filter(F.col("path").isNotNull()).select("file_id", "path", "bundle")
    chunks = t.v_chunks.withColumn("file_id", ids.extract_file_id(F.col("display_name")))
    kind = F.col("chunk_id") % 3
    body, path, side = F.col("text"), F.col("path"), F.col("bundle")
    recipe = (
        F.when(kind == 0, hashing.text_hash(body))
        .when(kind == 1, hashing.binary_hash(body, path, side))
        .otherwise(hashing.sidecar_hash(F.col("file_id"), path, side))
    )
    return chunks.join(state, "file_id").select("chunk_id", kind.alias("kind"), recipe.alias("content_hash"))


@query("nfc_text", "C14", """
SELECT doc_id, sha256(nfc_normalize(text)) AS text_hash FROM documents
""")
def _(t: Tables):
    return t.documents.select("doc_id", F.sha2(text.nfc(F.col("text")), 256).alias("text_hash"))


ROMAN_SQL = r"m{0,4}(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})"
# A page-number line without look-ahead: some numeral letter or digit must be there.
NOISE_SQL = (
    rf"(regexp_full_match({{0}}, '(?i)\s*(?:-\s*(?:[0-9]{{{{1,4}}}}|{ROMAN_SQL.replace('{', '{{').replace('}', '}}')})\s*-?"
    rf"|(?:[0-9]{{{{1,4}}}}|{ROMAN_SQL.replace('{', '{{').replace('}', '}}')})\s*-|[0-9]{{{{1,3}}}}"
    rf"|{ROMAN_SQL.replace('{', '{{').replace('}', '}}')})\s*') AND regexp_matches({{0}}, '(?i)[0-9mdclxvi]')"
    r" OR regexp_full_match({0}, '\s*Page\s+[0-9]+(?:\s+of\s+[0-9]+)?\s*'))"
)


def cleaned_sql(col: str) -> str:
    kept = f"list_filter(string_split({col}, chr(10)), lambda line: NOT {NOISE_SQL.format('line')})"
    joined = f"regexp_replace(array_to_string({kept}, chr(10)), '\\n{{3,}}', chr(10) || chr(10), 'g')"
    return f"trim({joined}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"


@query("strip_noise", "C15", f"""
WITH numbered AS (
  SELECT doc_id, '- ' || CAST(doc_id % 5000 AS VARCHAR) || ' -' || chr(10) || replace(text, '. ', chr(10) || 'iv' || chr(10))
         || chr(10) || 'Page ' || CAST(doc_id AS VARCHAR) || ' of 9' AS text FROM documents)
SELECT doc_id, {cleaned_sql('text')} AS clean_text FROM numbered
""")
def _(t: Tables):
    number = F.col("doc_id").cast("string")
    paged = F.concat(
        F.lit("- "), (F.col("doc_id") % 5000).cast("string"), F.lit(" -\n"),
        F.replace("text", F.lit(". "), F.lit("\niv\n")), F.lit("\nPage "), number, F.lit(" of 9"),
    )
    return t.documents.select("doc_id", text.strip_noise(paged).alias("clean_text"))


@query("cleanup_markdown", "C16", f"""
SELECT doc_id, {cleaned_sql('nfc_normalize(text)')} AS clean_text FROM documents
""")
def _(t: Tables):
    return t.documents.select("doc_id", text.cleanup_markdown(F.col("text")).alias("clean_text"))


@query("path_context", "C18", """
SELECT 'C' || CAST(c_custkey AS VARCHAR) AS folder_id, r_name || '/' || n_name || '/' || c_name || '/untitled' AS path,
       c_name AS bundle
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
""")
def _(t: Tables):
    rows = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).join(
        t.region, F.col("r_regionkey") == F.col("n_regionkey")
    )
    folders = F.array(F.concat(F.lit(" "), "r_name"), F.lit(" "), F.col("n_name"), F.col("c_name"))
    context = paths.path_context(folders, F.lit("  "))
    return rows.select(
        F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("folder_id"),
        context["path"].alias("path"), context["bundle"].alias("bundle"),
    )


LTRIM_SQL = r"regexp_replace({0}, '^\s+', '')"


@query("breadcrumb_markdown", "C20", rf"""
WITH x AS (
  SELECT c.chunk_id, s.path, s.bundle, s.name, CASE WHEN c.chunk_id % 4 = 0 THEN '' ELSE c.text END AS body
  FROM v_chunks c JOIN v_state s ON s.file_id = 'doc_' || lpad(CAST(c.f AS VARCHAR), 8, '0')),
y AS (SELECT chunk_id, body, coalesce(nullif(trim(name), ''), 'untitled') AS title, bundle,
             coalesce(nullif(trim(path), ''), coalesce(nullif(trim(name), ''), 'untitled')) AS path FROM x),
z AS (SELECT *, coalesce(nullif(trim(bundle), ''),
                CASE WHEN contains(path, '/') THEN regexp_replace(path, '/[^/]*$', '') ELSE '' END) AS b FROM y)
SELECT chunk_id, CASE WHEN NOT regexp_matches(body, '\S')
  THEN '# ' || title || chr(10) || chr(10) || '자료묶음: ' || b || chr(10) || '경로: ' || path || chr(10) || chr(10)
       || '이 파일은 자료묶음 `' || b || '` 소속입니다. 동일 경로의 관련 PDF/PPTX/HWP와 함께 참조하세요.' || chr(10)
  ELSE '# ' || title || chr(10) || chr(10) || CASE WHEN b <> '' THEN '자료묶음: ' || b || chr(10) || chr(10) ELSE '' END
       || {LTRIM_SQL.format('body')} END AS markdown
FROM z
""")
def _(t: Tables):
    chunks = t.v_chunks.withColumn("file_id", ids.extract_file_id(F.col("display_name")))
    body = F.when(F.col("chunk_id") % 4 == 0, "").otherwise(F.col("text"))
    markdown = paths.breadcrumb_markdown(F.col("path"), F.col("bundle"), F.col("name"), body)
    return chunks.join(t.v_state, "file_id").select("chunk_id", markdown.alias("markdown"))


@query("strip_breadcrumb", "C19", rf"""
SELECT doc_id, CASE doc_id % 3 WHEN 2 THEN '# ' || source || chr(10) || text
  ELSE {LTRIM_SQL.format('text')} END AS body
FROM documents WHERE NOT (doc_id % 3 <> 2 AND NOT regexp_matches(text, '\S'))
""")
def _(t: Tables):
    doc = F.col("doc_id")
    body, source = text.lstrip(F.col("text")), F.col("source")
    titled = F.concat(F.lit("# "), source, F.lit("\n\n"))
    labels = F.concat(F.lit(f"{paths.BUNDLE_LABEL} "), source, F.lit(f"\n{paths.PATH_LABEL} x/y\n\n"))
    front = F.concat(F.lit("---\npath: x/y\nbundle: "), source, F.lit("\n---\n\n"))
    headed = (
        F.when(doc % 3 == 0, F.concat(titled, labels, body))
        .when(doc % 3 == 1, F.concat(front, titled, labels, body))
        .otherwise(F.concat(F.lit("# "), source, F.lit("\n"), F.col("text")))
    )
    rows = t.documents.filter((doc % 3 == 2) | ~text.is_blank(F.col("text")))
    return rows.select("doc_id", paths.strip_breadcrumb(headed).alias("body"))


@query("object_uri", "C21", """
WITH u AS (SELECT chunk_id, CASE WHEN chunk_id % 10 = 9 THEN 'gs://' || display_name
                 ELSE 'gs://b' || CAST(chunk_id % 2 AS VARCHAR) || '/x/' || display_name END AS uri FROM v_chunks)
SELECT chunk_id, CASE WHEN chunk_id % 10 <> 9 THEN split_part(uri, '/', 3) END AS bucket,
       CASE WHEN chunk_id % 10 <> 9 THEN 'x/' || split_part(uri, '/', 5) END AS object_name FROM u
""")
def _(t: Tables):
    chunk = F.col("chunk_id")
    bucket = F.concat(F.lit("b"), (chunk % 2).cast("string"))
    name = F.concat(F.lit("x/"), F.col("display_name"))
    uri = F.when(chunk % 10 == 9, F.concat(F.lit("gs://"), "display_name")).otherwise(ids.gs_uri(bucket, name))
    return t.v_chunks.select(
        "chunk_id", ids.uri_bucket(uri).alias("bucket"), ids.uri_object(uri).alias("object_name")
    )


@query("drive_size", "C22", """
SELECT seq, CASE WHEN seq % 50 <> 0 THEN CAST(size AS BIGINT) END AS size_bytes FROM v_changes
""")
def _(t: Tables):
    wire = F.when(F.col("seq") % 50 == 0, F.concat("size", F.lit(" bytes"))).otherwise(F.col("size"))
    return t.v_changes.select("seq", ids.drive_size(wire).alias("size_bytes"))


@query("cell_format", "C23", r"""
SELECT p_partkey, CASE WHEN p_retailprice = floor(p_retailprice) THEN CAST(CAST(p_retailprice AS BIGINT) AS VARCHAR)
         ELSE regexp_replace(CAST(p_retailprice AS VARCHAR), '0+$', '') END AS price,
       regexp_replace(CAST(CAST(p_retailprice * 10000 + 12345678.5 AS DECIMAL(18,2)) AS VARCHAR), '\.?0+$', '') AS large,
       CAST(CAST(p_size AS BIGINT) AS VARCHAR) AS integral, CASE WHEN p_size > 25 THEN 'TRUE' ELSE 'FALSE' END AS flag,
       p_brand || '\| ' || p_type AS cell
FROM part
""")
def _(t: Tables):
    price = F.col("p_retailprice")
    raw = F.concat(F.lit(" "), "p_brand", F.lit("|\r"), "p_type", F.lit("\n"))
    return t.part.select(
        "p_partkey",
        values.cell_number(price).alias("price"),
        values.cell_number(F.round(price * 10000 + 12345678.5, 2)).alias("large"),
        values.cell_number(F.col("p_size").cast("double")).alias("integral"),
        values.cell_boolean(F.col("p_size") > 25).alias("flag"),
        values.cell_text(raw).alias("cell"),
    )


@query("column_number", "C24", """
SELECT n_nationkey, (ascii(upper(n_name)) - 64) * 676 + (ascii(upper(substring(n_name, 2, 1))) - 64) * 26
       + ascii(upper(substring(n_name, 3, 1))) - 64 AS column_no FROM nation
""")
def _(t: Tables):
    letters = F.upper(F.substring("n_name", 1, 3))
    return t.nation.select("n_nationkey", ids.column_number(letters).alias("column_no"))


@query("fixed_chunks", "C25", """
WITH d AS (SELECT doc_id, text, greatest(1, CAST(ceil((length(text) - 245) / 738.0) AS INTEGER)) AS n FROM documents)
SELECT doc_id, CAST(i AS INTEGER) AS chunk_no, substring(text, CAST(i * 738 + 1 AS BIGINT), 983) AS chunk_text
FROM (SELECT doc_id, text, unnest(range(n)) AS i FROM d) x
""")
def _(t: Tables):
    return chunking.fixed_chunks(t.documents).select("doc_id", "chunk_no", "chunk_text")


@query("canonical_text", "C26", r"""
SELECT doc_id, sha256(regexp_replace(nfc_normalize(text), '[*~`#\\\s]+', '', 'g')) AS canonical_hash FROM documents
""")
def _(t: Tables):
    return t.documents.select("doc_id", F.sha2(text.canonical(F.col("text")), 256).alias("canonical_hash"))


@query("reason_limits", "C27", """
SELECT doc_id, left(text, 2000) AS reason, left(text, 1000) AS job_error, left(text, 500) AS error, left(text, 60) AS prefix
FROM documents
""")
def _(t: Tables):
    body = F.col("text")
    return t.documents.select(
        "doc_id",
        F.left(body, F.lit(values.REASON_CHARS)).alias("reason"),
        F.left(body, F.lit(values.JOB_ERROR_CHARS)).alias("job_error"),
        F.left(body, F.lit(values.ERROR_CHARS)).alias("error"),
        F.left(body, F.lit(values.REASON_PREFIX_CHARS)).alias("prefix"),
    )


@query("rejection_reason", "C28", """
SELECT event_id, CASE event_id % 3 WHEN 0 THEN event_type WHEN 1 THEN event_type ELSE 'PARSE_REJECTED' END AS error_kind,
       CASE event_id % 3 WHEN 0 THEN event_type || ':{"detail":{"error":"' || event_type || '"}}'
         WHEN 1 THEN event_type || ':{"error":"' || event_type || '"}' ELSE 'PARSE_REJECTED:' || props END AS reason
FROM events
""")
def _(t: Tables):
    kind = F.col("event_type")
    slot = F.col("event_id") % 3
    detail = (
        F.when(slot == 0, F.concat(F.lit('{"detail":{"error":"'), kind, F.lit('"}}')))
        .when(slot == 1, F.concat(F.lit('{"error":"'), kind, F.lit('"}')))
        .otherwise(F.col("props"))
    )
    return t.events.select(
        "event_id", values.rejection_kind(detail).alias("error_kind"),
        values.rejection_reason(detail).alias("reason"),
    )
