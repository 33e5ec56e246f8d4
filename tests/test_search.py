"""Retrieval, re-ranking and merging against plain models."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave.operators import answer, postprocess, rerank, retrieve
from docweave.options import SearchOptions
from docweave.plans import search as jobs


def vectors(n, dims, seed, copies=1):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // copies + 1, dims)).astype(np.float32)
    return [[float(x) for x in base[i % len(base)]] for i in range(n)]


def nearest_model(queries, chunks, k, threshold):
    out = set()
    for q, qv in queries:
        rows = []
        for c, cv in chunks:
            a, b = np.array(qv), np.array(cv)
            d = abs(round(1 - float(a @ b) / (np.linalg.norm(a) * np.linalg.norm(b)), 6))
            if d <= threshold:
                rows.append((d, c))
        out |= {(q, c, d, i) for i, (d, c) in enumerate(sorted(rows)[:k])}
    return out


@pytest.mark.parametrize("opts", [
    SearchOptions(distance_threshold=0.9),
    SearchOptions(distance_threshold=0),
    SearchOptions(distance_threshold=0.9, query_block_rows=4),
])
@pytest.mark.parametrize("as_text", [False, True])
def test_nearest_chunks(spark, opts, as_text):
    def key(i):
        return f"k{i:04d}" if as_text else i

    kind = "string" if as_text else "bigint"
    chunks = [(key(i), v) for i, v in enumerate(vectors(300, 8, 1, copies=10))]  # many ties
    queries = [(i, v) for i, v in enumerate(vectors(9, 8, 2))]
    found = retrieve.nearest_chunks(
        spark.createDataFrame(queries, "query_id bigint, embedding array<float>"),
        spark.createDataFrame(chunks, f"chunk_id {kind}, embedding array<float>").repartition(5), opts,
    )
    got = {(r.query_id, r.chunk_id, r.distance, r.vec_rank) for r in found.collect()}
    threshold = opts.distance_threshold or math.inf
    assert got == nearest_model(queries, chunks, 15, threshold)


def test_bounds_spare_products_and_lose_nothing():
    """Chunks around 40 directions, queries near some: most groups are never multiplied."""
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(40, 16))
    chunks = np.concatenate([c + 0.1 * draw.normal(size=(200, 16)) for c in centres])
    queries = retrieve._unit_rows(centres[::4] + 0.1 * draw.normal(size=(10, 16)))
    for threshold in (0.3, np.inf):
        best, products = retrieve._Best(np.full(10, 15)), 0
        for lo in range(0, len(chunks), 4000):
            products += retrieve._measure(best, queries, chunks[lo:lo + 4000], np.arange(lo, lo + 4000), threshold)
        assert products < 0.5 * len(queries) * len(chunks)
        distance = np.abs(np.round(1 - queries @ retrieve._unit_rows(chunks).T, 6))
        for q in range(10):
            order = np.lexsort((np.arange(len(chunks)), distance[q]))[:15]
            wanted = [(i, distance[q, i]) for i in order.tolist() if distance[q, i] <= threshold]
            mine = best.query == q
            assert list(zip(best.chunk[mine].tolist(), best.distance[mine].tolist(), strict=True)) == wanted


def test_no_chunk_vector_is_shuffled(spark):
    queries = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(40)], "query_id bigint, embedding array<float>")
    chunks = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(50)], "chunk_id bigint, embedding array<float>")
    found = retrieve.nearest_chunks(queries, chunks, SearchOptions(query_block_rows=16))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Exchange" in line and "embedding" in line]
    assert found.select("query_id").distinct().count() == 40


def test_fetch_limits(spark):
    free = SearchOptions()
    assert [free.clamp_top_k(k) for k in (None, 0, 1, 99)] == [5, 5, 1, 99]
    assert [free.fetch_k(k) for k in (None, 1, 99)] == [15, 3, 297]
    opts = SearchOptions(top_k_max=20, fetch_max=60)
    assert [opts.clamp_top_k(k) for k in (None, 0, 1, 99)] == [5, 5, 1, 20]
    assert [opts.fetch_k(k) for k in (None, 1, 20)] == [15, 3, 60]


def tokens_model(s):
    out = []
    for m in re.findall(r"[가-힣]+|[a-zA-Z]+|\d+", s.lower()):
        out.append(m)
        if len(m) > 1 and "가" <= m[0] <= "힣":
            out += [m[i:i + 2] for i in range(len(m) - 1)]
    return out


def bm25_model(query, docs):
    toks = [tokens_model(d) for d in docs]
    lens = [len(t) or 1 for t in toks]
    mean, n = sum(lens) / len(lens), len(docs)
    df = Counter(w for t in toks for w in set(t))
    out = []
    for t, ln in zip(toks, lens):
        tf = Counter(t)
        out.append(round(sum(
            math.log(1 + (n - df[w] + .5) / (df[w] + .5)) * tf[w] * 2.5 / (tf[w] + 1.5 * (.25 + .75 * ln / mean))
            for w in set(tokens_model(query)) if tf[w]
        ), 9))
    return out


def test_bm25_and_fusion_with_hangul(spark):
    docs = ["학사일정 안내입니다", "수강신청 정정기간과 학사 일정", "", "AI 교육 AI", "said train"]
    cand = spark.createDataFrame([(1, i, i, d) for i, d in enumerate(docs)], "query_id int, chunk_id int, vec_rank int, text string")
    queries = spark.createDataFrame([(1, "학사일정이 AI")], "query_id int, query_text string")
    got = {r.chunk_id: r for r in rerank.rrf_rerank(cand, queries).collect()}
    model = bm25_model("학사일정이 AI", docs)
    assert [got[i].bm25 for i in range(5)] == pytest.approx(model, abs=1e-8)
    lex = {c: p for p, c in enumerate(sorted(range(5), key=lambda i: (-model[i], i)))}
    order = sorted(range(5), key=lambda i: (-(1 / (60 + i) + 1 / (60 + lex[i])), i))
    assert [got[i].position for i in order] == list(range(5))


def merge_model(hits, k, m, budget):
    """Rounds of dealing written out; hits are (file, sidecar, text) in order."""
    body = {f for f, side, _ in hits if not side}
    seen, groups = set(), {}
    for i, (f, side, t) in enumerate(hits):
        if side and f in body:
            continue
        fp = " ".join(t.lower().split())[:180]
        if fp and fp in seen:
            continue
        seen.add(fp)
        groups.setdefault(f, [])
        if len(groups[f]) < m:
            groups[f].append(i)
    chosen = list(groups)[:k]
    left = max(budget or len(chosen) * m, len(chosen)) - len(chosen)
    take = {f: 1 for f in chosen}
    for _ in range(m - 1):
        for f in chosen:
            if left > 0 and take[f] < len(groups[f]):
                take[f] += 1
                left -= 1
    return [(f, tuple(groups[f][:take[f]])) for f in chosen]


@pytest.mark.parametrize("k, m, budget", [(5, 3, 15), (3, 3, 4), (4, 2, 0), (2, 3, 1), (20, 3, 15)])
def test_merge_against_dealing_rounds(spark, k, m, budget):
    rng = random.Random(k * 100 + budget)
    rows, model = [], {}
    for q in range(60):
        hits = [
            (f"f{rng.randint(0, 7)}", rng.random() < 0.2, rng.choice(["", "same text", f"Text  {rng.randint(0, 12)}"]))
            for _ in range(rng.randint(1, 25))
        ]
        model[q] = merge_model(hits, k, m, budget)
        rows += [(q, i, f"{q}:{i}", f, side, t, 0.1 * i) for i, (f, side, t) in enumerate(hits)]
    frame = spark.createDataFrame(rows, "query_id int, position int, tag string, file_id string, is_sidecar boolean, text string, distance double")
    opts = SearchOptions(max_chunks_per_file=m, max_total_chunks=budget, top_k_max=99)
    body = postprocess.drop_repeated_texts(postprocess.drop_shadowed_sidecars(frame))
    spent = postprocess.spend_budget(postprocess.rank_files(body), F.lit(k), opts).collect()
    for q, want in model.items():
        got = {}
        for r in sorted((r for r in spent if r.query_id == q), key=lambda r: (r.file_rank, r.ordinal)):
            got.setdefault(r.file_id, []).append(r.position)
        assert [(f, tuple(p)) for f, p in got.items()] == want


def test_search_fills_the_page_past_hidden_files(spark):
    chunks = [(i, f"f{i}.md", f"text {i}", [1.0, i / 100]) for i in range(12)]
    state = [(f"f{i}", "DELETED" if i < 2 else "INDEXED", None, "d1" if i % 2 else "d2") for i in range(11)]
    frame = spark.createDataFrame(chunks, "chunk_id int, display_name string, text string, embedding array<float>")
    states = spark.createDataFrame(state, "file_id string, status string, error string, drive_id string").selectExpr(
        "*", "'' as name", "cast(null as string) as path", "'b' as bundle", "'t' as modified_time", "'' as source_uri",
    )
    queries = spark.createDataFrame([(1, "text", [1.0, 0.0])], "query_id int, query_text string, embedding array<float>")
    found = jobs.search(queries, frame, states, SearchOptions(), top_k=5).orderBy("rank").collect()
    assert [r.source.file_id for r in found] == ["f2", "f3", "f4", "f5", "f6"]
    one_drive = jobs.search(queries, frame, states, SearchOptions(drive_id="d1"), top_k=20).collect()
    assert {r.source.file_id for r in one_drive} == {"f3", "f5", "f7", "f9", "f11"}  # f11 has no state


def test_answer_coverage(spark):
    rows = [(1, 1, "본문 A", ["AI"], ["일정"], "f1"), (1, 2, "본문 B", ["일정"], ["AI"], "f2"), (2, 1, "C", ["x1"], [], "f3")]
    results = spark.createDataFrame(
        rows, "query_id int, rank int, text string, matched_terms array<string>, missing_terms array<string>, file_id string"
    ).selectExpr("*", "named_struct('file_id', file_id, 'name', file_id, 'label', file_id, 'bundle', '', 'source_uri', '') as source")
    queries = spark.createDataFrame([(1, "AI 일정 없음"), (2, "xy"), (3, "zz")], "query_id int, query_text string")
    got = {r.query_id: r for r in answer.build_answers(results, queries).collect()}
    assert got[1].coverage == "partial" and got[1].uncovered_terms == ["없음"]
    assert got[1].context == "[1] f1\n본문 A\n\n---\n\n[2] f2\n본문 B"
    assert got[2].coverage == "full" and got[3].coverage == "none" and got[3].citations == []
