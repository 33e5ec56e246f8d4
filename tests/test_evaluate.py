"""Retrieval metrics on literal rows."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from docweave.operators import evaluate
from docweave.sources import views
from docweave.sources.views import containing


def test_items_and_metrics(spark):
    golden = spark.createDataFrame(
        [(1, "q", "t", "f1", "N1", "b1", None), (2, "q", "t", "f9", "N9", None, ["f2"]), (40, "q", None, "f3", "n3", "b3", None)],
        "n int, q string, type string, file_id string, name string, bundle string, also_accept array<string>",
    )
    results = spark.createDataFrame(
        [(1, 1, .1, "f5", " n1 ", "x"), (1, 2, .2, "f1", "N1", "b1"), (2, 1, .3, "f2", "other", ""), (2, 2, .4, "f7", "other", "")],
        "n int, rank int, score double, file_id string, name string, bundle string",
    )
    items = evaluate.score_items(golden, results)
    got = {r.n: (r["rank"], r.same_doc_rank, r.bundle_rank, r.hit_score, r.top_score, r.n_hits, r.distinct_names) for r in items.collect()}
    assert got == {1: (2, 1, 2, .2, .1, 2, 1), 2: (1, None, None, .3, .3, 2, 1), 40: (None, None, None, None, None, 0, 0)}
    strict = evaluate.overall(items).filter("criterion = 'strict'").first()
    assert (strict.n, strict.hit1, strict.hit3, strict.hit1_rate, strict.mrr) == (3, 1, 2, 0.333, 0.5)
    waste = evaluate.slots(items).first()
    assert (waste.empty_results, waste.slots, waste.wasted) == (1, 4, 2)
    assert {r.segment: r.n for r in evaluate.by_segment(items).collect()} == {"old": 2, "new": 1}
    assert {r.type for r in evaluate.by_type(items).collect()} == {"t", "?"}


@pytest.mark.parametrize("n", [2, 3, 10, 57, 200])
def test_exclusive_percentile(spark, n):
    rng = random.Random(n)
    values = [round(rng.random(), 2) for _ in range(n)]
    frame = spark.createDataFrame([(v,) for v in values], "hit_score double")
    got = evaluate.distance_distribution(frame).first().p95_exclusive
    assert got == pytest.approx(statistics.quantiles(values, n=100)[94])


def test_containment_join(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab c") for _ in range(rng.randint(0, 400))) for _ in range(60)]
    passages = [t[i:i + n] for t in texts if len(t) > 200 for i, n in [(rng.randint(0, 100), rng.choice([1, 5, 18, 19, 40, 78, 79, 80]))]]
    passages += ["zz", "ab" * 50]
    left = spark.createDataFrame(list(enumerate(texts)), "doc int, text string")
    right = spark.createDataFrame(list(enumerate(passages)), "item int, passage string")
    got = {(r.doc, r.item) for r in containing(left, "doc", "text", right, "passage").collect()}
    assert got == {(d, i) for d, t in enumerate(texts) for i, p in enumerate(passages) if p in t}


def test_many_short_passages_have_rare_keys(spark):
    """A key is the window of a passage that the fewest texts hold, so none of them meets all texts."""
    rng = random.Random(6)
    texts = ["common start " + "".join(rng.choices("abcdefgh ", k=rng.choice([30, 90]))) for _ in range(120)] + ["", None]
    passages = [f"common {''.join(rng.choices('abcdefgh', k=5))}" for _ in range(9_900)]
    passages += [t[i:i + n] for t in texts[:60] for i, n in ((3, 1), (14, 2), (20, 5), (11, 12), (13, 17), (0, 18))] + ["", None]
    left = spark.createDataFrame(list(enumerate(texts)), "doc int, text string")
    right = spark.createDataFrame(list(enumerate(passages)), "item int, passage string")
    got = [(r.doc, r.item) for r in containing(left, "doc", "text", right, "passage").collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(d, i) for d, t in enumerate(texts) for i, p in enumerate(passages) if p and t and p in t}
    cut = left.select("doc", F.explode(views._windows("text", F.lit(6))).alias("key"))
    own = right.filter(F.length("passage") >= 6).distinct()
    keys = views._rarest(cut, own.withColumn("windows", views._windows("passage", F.lit(6))), "passage", F.lit(1))
    assert cut.join(keys, "key").groupBy("key").agg(F.count_distinct("doc").alias("n")).agg(F.max("n")).first()[0] < 60
