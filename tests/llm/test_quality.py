import math
import re

import numpy as np
import pyarrow as pa
import pytest

from docweave.llm import quality

WORD = r"[^\x20\x09-\x0D]+"


def counts(text):
    text = text or ""
    words = re.findall(WORD, text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    seen, dup_lines = set(), 0
    for line in text.split("\n"):
        if re.search(WORD, line):
            dup_lines += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup_lines, len(covered)


def test_counts_match_brute_force(docs, rows):
    held = [r for r in rows if len(r[1] or "") < 20000]
    found = quality.judged(docs.filter("n_chars IS NULL OR n_chars < 20000").select("doc_id", "text", "lang")).collect()
    got = sorted((r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found)
    assert got == sorted((r[0] or -1, *counts(r[1])) for r in held)
    for r in found:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_repeats_of_lines_and_windows():
    texts = ["a b c d e f g h\na b c d e f g h\n\n \nx", "w " * 9, " x\nx\n x", "one line"]
    found = quality.measure(pa.array(texts))
    for i, text in enumerate(texts):
        assert tuple(int(found[c][i]) for c in quality._COUNTS) == counts(text)


def test_distance_matches_the_definition():
    draw = np.random.default_rng(0)
    p, q = draw.integers(0, 5, (20, 6)).astype(float), draw.integers(0, 5, (20, 6)).astype(float)
    p[:, 0] += 1
    q[:, 0] += 1
    for x, y, found in zip(p, q, quality.js_distance(p, q), strict=True):
        x, y = x / x.sum(), y / y.sum()
        m = (x + y) / 2
        terms = sum(a * math.log2(a / c) for a, c in zip(x, m, strict=True) if a) + sum(b * math.log2(b / c) for b, c in zip(y, m, strict=True) if b)
        assert found == pytest.approx(math.sqrt(max(terms / 2, 0)))
    assert quality.js_distance(np.zeros((1, 3)), np.ones((1, 3)))[0] == 0
    assert quality.js_distance(np.array([[1.0, 0]]), np.array([[0, 1.0]]))[0] == pytest.approx(1)


def test_outliers_go_and_clean_or_short_documents_stay(spark):
    prose = "the river runs to the sea and it is wide in the summer, with boats on it and a bridge of stone"
    shouted = "RIVER!! STONE!! BOAT!! SUMMER!! BRIDGE!! " * 12
    rows = [(i, " ".join(f"{w}{'x' * (i % 3)}" if k % 5 == i % 5 else w for k, w in enumerate((prose + " ") .split() * 3)) + f" {i}", "en") for i in range(40)]
    rows = [(i, " ".join(dict.fromkeys(t.split())) + f" w{i} the a{i} of b{i} and c{i} to d{i} in e{i} for f{i} it g{i} was h{i} on k{i} as l{i} is m{i} by n{i} o{i} p{i} q{i} r{i}", g) for i, t, g in rows]
    rows += [(100, " ".join(f"{w}{i}" for i, w in enumerate(shouted.split())), "en"), (101, "SHORT!! TEXT!!", "en")]
    found = {r.doc_id: r for r in quality.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(found[i].kept for i in range(40))
    assert not found[100].base_failed and found[100].char_js > 0.34 and not found[100].kept
    assert found[101].base_failed


def test_rare_languages_use_all_documents(spark, docs):
    measured = quality.judged(docs.select("doc_id", "text", "lang"), quality.QualityOptions(support=2.0)).collect()
    assert len(measured) == docs.count()


def test_empty_table(no_docs):
    assert quality.judged(no_docs.select("doc_id", "text", "lang")).count() == 0


def test_a_rare_language_is_held_against_itself(spark):
    """Two clean documents of a language among 2,500, and one that names none, differ from the rest in their letters."""
    english = "the river runs to the sea and it is wide in the summer with boats on it and a bridge of stone"
    rows = [(i, f"{english} {i} {' '.join(f'{w}{i}' for w in english.split())}", "en") for i in range(2500)]
    draw = np.random.default_rng(0)
    russian = ["".join(map(chr, draw.integers(0x430, 0x450, 3 + i % 6))) for i in range(140)]
    rows += [(9000, " ".join(russian[:90]), "ru"), (9001, " ".join(russian[50:]), "ru"), (9002, " ".join(russian), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for support in (1e-3, 2.0):
        found = {r.doc_id: r for r in quality.judged(docs, quality.QualityOptions(support=support)).collect()}
        assert len(found) == len(rows)
        assert found[9000].char_js < 0.34 and found[9001].char_js < 0.34 < found[9002].char_js
        assert all(found[i].kept for i in (0, 9000, 9001, 9002))
