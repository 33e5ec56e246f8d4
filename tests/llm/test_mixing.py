import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from docweave.llm import mixing


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def filled(sizes):
    """Targets by resharing the excess until no source is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= 2 * sizes[s]}
        if not full:
            return target | {s: level * weight[s] for s in open_}
        target |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        open_ -= full
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100, None: 10}, {"x": 5}, {"a": 1000, "b": 1, "c": 1}, {"a": 0, "b": 7}, {"é": 3, "z": 90, "A": 20, "b": 4},
])
def test_targets(spark, sizes):
    table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    found = {r.source: r.target for r in mixing.targets(table).collect()}
    assert found == pytest.approx(filled(sizes))


def test_sizes_targets_and_copies(docs, rows):
    found = mixing.mix(docs).collect()
    assert sorted((r.doc_id or -1, r["size"]) for r in found) == sorted((d or -1, words(t)) for d, t, *_ in rows)
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in found:
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
        assert r.copies in (0, 1, 2)
    wanted = filled(sizes)
    for r in found:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(wanted[r.source])
    for source in sizes:
        assert abs(taken[source] - wanted[source]) <= largest[source]


def test_reruns_agree_whatever_the_partitions(docs):
    columns = ["doc_id", "size", "copies"]
    one = sorted(map(repr, mixing.mix(docs).select(columns).collect()))
    assert one == sorted(map(repr, mixing.mix(docs.repartition(7)).select(columns).collect()))


def test_inclusion_follows_the_odds(spark):
    """Over many documents, size classes are taken as often as their inclusion odds say, and the cut is exact."""
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 3).alias("source"),
        F.repeat(F.lit("w "), F.when(F.col("id") % 2 == 0, 2).otherwise(32).cast("int")).alias("text"),
    )
    mix = mixing.mix(docs).filter("source = 's2'").groupBy("size").agg(F.avg("copies").alias("rate")).collect()
    rate = {r["size"]: r.rate % 1 for r in mix}
    odds = {k: v / (1 - v) for k, v in rate.items()}
    assert odds[32] / odds[2] == pytest.approx(1.6 / 1.2, rel=0.25)
    total = mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).collect()
    assert all(abs(r.t - r.g) <= 32 for r in total)


def test_word_count(docs, rows):
    found = sorted(r.n for r in docs.select(mixing.word_count(F.col("text")).alias("n")).collect())
    assert found == sorted(words(t) for _, t, *_ in rows)


def test_empty_table(no_docs):
    assert mixing.mix(no_docs).count() == 0
