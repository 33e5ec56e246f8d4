"""Blocked ordered computations and folds against plain loops, with blocks of a few rows."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave.operators import evaluate, prefix, profile, quantiles, recover, restarts


@pytest.fixture
def tiny_blocks(monkeypatch):
    monkeypatch.setattr(prefix, "BLOCK_ROWS", 7)
    monkeypatch.setattr(restarts, "FAN", 3)
    monkeypatch.setattr(restarts.mark_restarts, "__defaults__", (False, 7, "restarts"))


def test_prefix_forms(spark):
    rng = random.Random(5)
    rows = [(k, i, rng.choice([None, rng.randint(0, 9)])) for k in "ab" for i in range(40) if rng.random() < 0.8]
    frame = spark.createDataFrame(rows, "k string, i int, v int")
    block = F.floor(F.col("i") / 6)
    out = prefix.running_sum(frame, ["k"], ["i"], F.coalesce("v", F.lit(0)), block, "s")
    out = prefix.last_value(out, ["k"], ["i"], F.col("v"), block, "l")
    out = prefix.previous_value(out, ["k"], ["i"], F.col("i"), block, "p")
    out = prefix.next_value(out, ["k"], ["i"], F.col("i"), block, "n")
    got = {(r.k, r.i): (r.s, r.l, r.p, r.n) for r in out.collect()}
    want = {}
    for k in "ab":
        mine = [(i, v) for kk, i, v in rows if kk == k]
        total, last = 0, None
        for j, (i, v) in enumerate(mine):
            total, last = total + (v or 0), v if v is not None else last
            before = mine[j - 1][0] if j else None
            after = mine[j + 1][0] if j + 1 < len(mine) else None
            want[k, i] = (total, last, before, after)
    assert got == want


def test_numbering_over_partitions(spark):
    names = [f"u{i:05d}" for i in range(503)]
    random.Random(1).shuffle(names)
    frame = spark.createDataFrame([(n,) for n in names], "uri string").repartition(9)
    got = {r.uri: (r.position, r.call_no) for r in recover.import_calls(frame, ("uri",)).collect()}
    assert got == {n: (i, i // 25) for i, n in enumerate(sorted(names))}


def pack_model(sizes, limit):
    target = int(limit * 0.85)
    if sum(sizes) <= limit:
        return [1] * len(sizes), None
    if len(sizes) == 1:
        return None, "single_page_over_limit"
    if sizes[0] > target:
        return None, "first_page_over_target"
    parts, part, held = [], 1, 0
    for s in sizes:
        if held and held + s > target:
            part, held = part + 1, 0
        held += s
        parts.append(part)
    totals = {}
    for p, s in zip(parts, sizes):
        totals[p] = totals.get(p, 0) + s
    return parts, "part_over_limit" if max(totals.values()) > limit else None


def test_page_packing(spark, tiny_blocks):
    rng = random.Random(3)
    docs = {d: [rng.randint(1, 120 if d % 5 == 0 else 40) for _ in range(rng.randint(1, 60))] for d in range(50)}
    rows = [(d, i + 1, s) for d, sizes in docs.items() for i, s in enumerate(sizes)]
    out = recover.pack_pages(spark.createDataFrame(rows, "doc bigint, page_no int, bytes bigint"), 100).collect()
    for d, sizes in docs.items():
        parts, error = pack_model(sizes, 100)
        mine = sorted((r for r in out if r.doc == d), key=lambda r: r.page_no)
        assert {r.split_error for r in mine} == {error}
        if parts:
            assert [r.part_no for r in mine] == parts


def test_whole_document_batches(spark, tiny_blocks):
    rng = random.Random(4)
    rows, want = [], {}
    for run in range(6):
        held, batch = 0, 0
        for i in range(rng.randint(1, 90)):
            n = rng.randint(1, 3)
            rows.append((f"r{run}", i, n))
            want[f"r{run}", i] = batch
            held += n
            if held >= 10:
                held, batch = 0, batch + 1
    frame = spark.createDataFrame(rows, "run string, position bigint, n bigint")
    got = {(r.run, r.position): r.batch_no for r in recover.document_batches(frame, "run", "position", "n", 10).collect()}
    assert got == want


def test_answers_are_kept_for_a_while(spark, tiny_blocks):
    rng = random.Random(8)
    rows, want, event = [], {}, 0
    for q in ("a", "b", "c"):
        now, last = 0, None
        for _ in range(200):
            now += rng.choice([0, 5, 30, 61, 400])
            rows.append((q, 5, now, event))
            want[event] = last is None or now - last > 60
            last = now if want[event] else last
            event += 1
    frame = spark.createDataFrame(rows, "query_text string, top_k int, s bigint, event_id bigint").withColumn("ts", F.timestamp_seconds("s"))
    got = {r.event_id: r.answered for r in profile.answered_calls(frame, ["query_text", "top_k"], 60).collect()}
    assert got == want


def test_one_key_of_two_million_rows(spark):
    """Maps of 1,954 blocks are composed in two levels."""
    rows = spark.range(2_000_000).select(
        F.lit(None).cast("string").alias("k"), F.col("id").alias("position"), (F.col("id") * 3).alias("at")
    )
    marked = restarts.mark_restarts(rows, ["k"], "position", "at", "at", 299, block_rows=1024)
    # From 0 the next restart is the first row beyond 299: every 100 rows.
    assert marked.filter(F.col("restarts") != (F.col("position") % 100 == 0)).count() == 0
    assert marked.filter("restarts").count() == 20_000


@pytest.mark.parametrize("inclusive", [False, True])
def test_maps_of_blocks_compose(inclusive):
    draw = np.random.default_rng(2)
    for _ in range(200):
        n, limit = int(draw.integers(2, 40)), int(draw.integers(0, 9))
        base = np.cumsum(draw.integers(0, 4, n))
        cuts = np.sort(draw.choice(np.arange(1, n), min(n - 1, 3), replace=False))
        parts = [restarts.block_map(b, b, limit, inclusive) for b in np.split(base, cuts)]
        left = parts[0]
        for part in parts[1:]:
            left = restarts.composed(left, part, limit, inclusive)
        right = parts[-1]
        for part in parts[-2::-1]:
            right = restarts.composed(part, right, limit, inclusive)
        for entry in range(int(base[0]) - 12, int(base[0]) + 1):
            at = restarts._first_beyond(base, 0, entry, limit, inclusive)
            marks = restarts._walk(base, base, at, limit, inclusive)
            want = base[marks[-1]] if marks else entry
            for tests, ends in (left, right):
                assert restarts.mapped(tests, ends, np.array([entry]), limit, inclusive)[0] == want


def test_all_rows_of_one_key_in_one_hour(spark, monkeypatch):
    """Blocks are cut at row numbers: rows of one key and one moment are in many."""
    monkeypatch.setattr(prefix, "BLOCK_ROWS", 10)
    rows = [(None if i % 3 else "q", 1000 + i // 40, i) for i in range(300)] + [("q", 5000, 999)]
    frame = spark.createDataFrame(rows, "query_text string, s bigint, event_id bigint").withColumn("ts", F.timestamp_seconds("s"))
    held, block = prefix.in_even_blocks(frame, ["query_text", "ts", "event_id"])
    assert held.groupBy(block.alias("b")).count().agg(F.max("count")).first()[0] == 10
    bursts = {(r.query_text, r.calls) for r in profile.query_bursts(frame, 60).collect()}
    assert bursts == {(None, 200), ("q", 100), ("q", 1)}
    silent = profile.silent_periods(frame, ["query_text"], 60).collect()
    assert [(r.query_text, r.since.timestamp(), r.until.timestamp()) for r in silent] == [("q", 1007, 5000)]


@pytest.mark.parametrize("values", [
    [], [4.0], [1.0, 2.0], [7.0] * 50, [0.1 * i for i in range(999)], [float(i % 7) for i in range(500)],
    [-1.5e308, 1.5e308, 0.0, 5e-324, 3.5], [None, 2.0, None, 8.0, float("nan"), 4.0], list(np.random.default_rng(1).normal(size=3000)),
])
def test_quantiles_by_counting(spark, monkeypatch, values):
    monkeypatch.setattr(quantiles, "BINS", 8)
    frame = spark.createDataFrame([(None if v is None else float(v), "x") for v in values], "v double, other string").repartition(3)
    sound = sorted(v for v in values if v is not None and v == v)
    n, found = quantiles.order_statistics(frame, F.col("v"), lambda n: range(0, n, max(1, n // 10)))
    assert n == len(sound) and found == {i: sound[i] for i in range(0, n, max(1, n // 10))}
    got = evaluate.distance_distribution(frame.filter("NOT isnan(v) OR v IS NULL"), "v").first()
    if len(sound) > 1 and sound[-1] < 1e300:
        wanted = statistics.quantiles(sound, n=100, method="exclusive")[94], statistics.quantiles(sound, n=100, method="inclusive")[94]
        assert (got.p95_exclusive, got.p95_inclusive) == pytest.approx(wanted)
        assert got.median_score == pytest.approx(statistics.median(sound))
    elif len(sound) < 2:
        assert got.p95_exclusive is None and got.median_score == (sound[0] if sound else None)


def test_bursts_and_silence(spark):
    rows = [("q", t, i) for i, t in enumerate([0, 10, 3700, 3750, 90_000])]
    frame = spark.createDataFrame(rows, "query_text string, s bigint, event_id bigint").withColumn("ts", F.timestamp_seconds("s"))
    assert sorted(r.calls for r in profile.query_bursts(frame, 60).collect()) == [1, 2, 2]
    assert profile.silent_periods(frame, ["query_text"], 86_000).count() == 1


@pytest.mark.parametrize("rows", [65_536, 65_537, 65_538])
def test_batches_around_the_border_of_a_block(spark, rows):
    frame = spark.range(rows).select(F.lit(1).alias("run"), F.col("id").alias("position"), F.lit(1).cast("long").alias("n"))
    found = recover.document_batches(frame, "run", "position", "n", 10)
    assert found.filter(F.col("batch_no") != F.floor(F.col("position") / 10)).count() == 0
