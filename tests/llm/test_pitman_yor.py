import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from docweave.llm import pitman_yor


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def test_base_columns_match_brute_force(docs, rows):
    found = pitman_yor.score(docs).collect()
    seen = Counter(w for d, t, *_ in rows if not held_out(d) for w in tokens(t))
    total = sum(seen.values())
    wanted = sorted(
        (d or -1, held_out(d), len(tokens(t)), sum(seen[w] > 0 for w in tokens(t)), total,
         round(sum(math.log10((seen[w] + 1) / (total + len(seen) + 1)) for w in tokens(t)), 6))
        for d, t, *_ in rows
    )
    got = sorted((r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found)
    assert got == wanted
    assert all(r.score < 0 for r in found)


def test_model_beats_the_base_on_held_out_text(spark):
    """Text in which each word depends on the one before."""
    draw = random.Random(1)
    follow = {f"w{i}": [f"w{draw.randrange(40)}" for _ in range(3)] for i in range(40)}
    rows = []
    for i in range(300):
        word, text = "w0", []
        for _ in range(60):
            word = draw.choice(follow[word])
            text.append(word)
        rows.append((i, " ".join(text)))
    found = pitman_yor.score(spark.createDataFrame(rows, "doc_id long, text string")).filter("held_out").collect()
    n = sum(r.n_tokens for r in found)
    base, model = (-sum(r[c] for r in found) / n for c in ("base_score", "score"))
    assert model < 0.75 * base
    assert model < math.log10(3) * 1.35


def test_seating_keeps_the_bounds_and_grows_slowly():
    counts = np.array([1, 2, 10, 1000, 10_000_000])
    base = np.full(5, 0.01)
    draws = np.array([pitman_yor.seat(counts, base, 50.0, 0.5, np.random.default_rng(k)) for k in range(20)])
    assert (draws >= 1).all() and (draws <= counts).all()
    assert draws[:, 0].max() == 1 and draws[:, 4].mean() > draws[:, 2].mean()


def test_predictive_probabilities_add_up():
    counts, base = np.array([5, 0, 3, 1]), np.array([0.1, 0.4, 0.3, 0.2])
    assert pitman_yor.predictive(counts, np.array([2, 0, 1, 1]), base, 0.6).sum() == pytest.approx(1)


def test_reruns_agree(docs):
    first, second = (sorted((r.doc_id or -1, r.n_tokens, round(r.score, 6)) for r in pitman_yor.score(d).collect()) for d in (docs, docs.repartition(5)))
    assert first == second


def test_empty_table(no_docs):
    assert pitman_yor.score(no_docs).count() == 0


def chain(n_words, n_texts, size):
    """Text in which each of many words has one that follows it."""
    draw = random.Random(2)
    rows = []
    for i in range(n_texts):
        at = draw.randrange(n_words)
        rows.append((i, " ".join(f"w{(at + k) * 7 % n_words}" for k in range(size))))
    return rows


def digits_a_token(found):
    held = [r for r in found if r.held_out]
    return [-sum(r[c] for r in held) / sum(r.n_tokens for r in held) for c in ("base_score", "score")]


def test_contexts_without_a_floor(spark):
    """Each word is one in 5,000 of the tokens, and is always followed by the same one."""
    rows = chain(5000, 700, 60)
    base, model = digits_a_token(pitman_yor.score(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert base > 3.5
    assert model < 0.35 * base


def test_rare_words_meet_in_buckets_as_frequent_ones_do(spark, monkeypatch):
    docs = spark.createDataFrame(chain(300, 120, 60), "doc_id long, text string")
    all_frequent = digits_a_token(pitman_yor.score(docs).collect())
    for support in (0.01, 1.0):  # the end alone is broadcast, and nothing
        monkeypatch.setattr(pitman_yor, "SUPPORT", support)
        found = digits_a_token(pitman_yor.score(docs).collect())
        assert found[0] == pytest.approx(all_frequent[0])
        assert found[1] == pytest.approx(all_frequent[1], rel=0.02)


def test_tables_of_finished_sweeps_are_removed(spark, tmp_path, monkeypatch):
    """Of the sweeps, only the tables of those that are averaged stay until the texts are scored."""
    from docweave.llm import shared

    monkeypatch.setattr(shared, "checkpoint_folder", lambda _: str(tmp_path))
    docs = spark.createDataFrame([(i, f"a b a b c{i % 3}") for i in range(20)], "doc_id long, text string")
    assert pitman_yor.score(docs).count() == 20
    assert len(list(tmp_path.glob("seats-*"))) == 2 * pitman_yor.SAMPLES
