import random

import numpy as np
import pyarrow as pa
import pytest

from docweave.llm import bottom_k
from tests.llm.test_ngram_join import brute_force

NAMED = "doc_id long, text string, n_shingles int, component_id string, id long, sketch string"


def found(docs, width=bottom_k.WIDTH, percent=bottom_k.PERCENT):
    return sorted((tuple(r) for r in bottom_k.near_duplicates(docs, width, percent).collect()), key=repr)


def expected(rows, width=bottom_k.WIDTH, percent=bottom_k.PERCENT):
    return sorted(((d, n, c, d is None or c is None or d == c) for d, n, c in brute_force(rows, width, percent)), key=repr)


@pytest.mark.parametrize(("width", "percent"), [(2, 80), (3, 60)])
def test_matches_brute_force(docs, rows, width, percent):
    assert found(docs, width, percent) == expected(rows, width, percent)


def test_short_texts_and_a_common_passage(spark):
    draw = random.Random(3)
    shared = [f"p{i}" for i in range(30)]
    rows = []
    for i in range(150):
        words = draw.choices([f"w{j}" for j in range(40)], k=draw.choice([2, 5, 6, 7, 20, 30, 40, 60]))
        words += shared if i % 3 == 0 else []
        rows.append((i, " ".join(words), 1, "x", 2, "y"))
        if i % 4 == 0:
            words[draw.randrange(len(words))] = "other"
            rows.append((1000 + i, " ".join(words), 1, "x", 2, "y"))
    assert found(spark.createDataFrame(rows, NAMED).repartition(3)) == expected(rows)


def test_overlaps_of_a_cell():
    draw = np.random.default_rng(7)
    sketch = np.sort(draw.integers(0, 40, (9, bottom_k.K)).astype(np.uint32), axis=1)
    sketch = np.stack([np.append(u := np.unique(r), np.full(bottom_k.K - len(u), bottom_k._FILL)) for r in sketch])
    sketch[3] = bottom_k._FILL
    overlaps = bottom_k.Overlaps(sketch)
    sets = [set(r.tolist()) - {int(bottom_k._FILL)} for r in sketch]
    for i in range(9):
        assert overlaps.count(i).tolist() == [len(sets[i] & s) for s in sets]


def test_each_pair_of_a_list_meets_once(spark, monkeypatch):
    monkeypatch.setattr(bottom_k, "BLOCK_MEMBERS", 3)
    draw = random.Random(2)
    roots = {i: draw.choice([0, 0, 0, 1, 2, i]) for i in range(20)}
    members = spark.createDataFrame([(7, i) for i in range(20)] + [(8, i) for i in range(20)] + [(9, 1), (9, 2), (9, 3)], "key long, id long")
    links = spark.createDataFrame([(i, r) for i, r in roots.items() if i != r], "node long, root long")
    sketches = spark.createDataFrame([(i, 1, [i]) for i in range(20)], "id long, n long, sketch array<int>")
    cells = {}
    for r in bottom_k._left_over(members, links, sketches).collect():
        cells.setdefault((r.key, r.low, r.high), []).append(r)
    met = []
    for rows in cells.values():
        ids, root, side, minor = (np.array([r[c] for r in rows]) for c in ("id", "root", "side", "minor"))
        met += [frozenset((int(ids[i]), int(ids[j]))) for i, at in bottom_k.meetings(ids, root, side, minor) for j in at]
    real = {i: roots[i] for i in range(20)}
    assert len(met) == len(set(met)) and set(met) == {frozenset((i, j)) for i in range(20) for j in range(i) if real[i] != real[j]}
    assert len({key for key, _, _ in cells}) == 1  # lists with the same members are one


def test_chains_and_large_groups_in_small_blocks(spark, monkeypatch):
    """Copies of one text that differ from each other more than from their neighbours."""
    monkeypatch.setattr(bottom_k, "BLOCK_MEMBERS", 4)
    draw = random.Random(5)
    words = [f"t{i}" for i in range(90)]
    rows = []
    for i in range(60):
        rows.append((i, " ".join(words)))
        for _ in range(draw.choice([1, 2, 3])):
            words[draw.randrange(90)] = f"new{i}"
    got = found(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert got == expected(rows)
    assert len({r[2] for r in got}) < 60


def test_no_rows(no_docs):
    assert bottom_k.near_duplicates(no_docs).collect() == []


def test_union_sketches_keep_linked_pairs_and_drop_others():
    draw = np.random.default_rng(1)
    for n in (5, 20, 90, 110, 300, 4000):
        for _ in range(40):
            base = draw.integers(0, 1 << 63, 2 * n).astype(np.uint64)
            off = n // 10
            x, y = np.sort(base[:n]), np.sort(base[off:n + off])
            link = 100 * (n - off) >= 80 * (n + off)
            z = np.sort(base[n:])
            rows = [
                np.append((v[:bottom_k.K] >> np.uint64(32)).astype(np.uint32), np.full(max(bottom_k.K - len(v), 0), bottom_k._FILL))[None]
                for v in (x, y, z)
            ]
            size = np.array([n])
            if link:
                assert bottom_k.may_link(size, size, rows[0], rows[1], 80).all()
            assert not bottom_k.may_link(size, size, rows[0], rows[2], 80).any()


def test_bounds_of_lists():
    assert bottom_k.floor_of(80, 32) == 9 and bottom_k.floor_of(100) == bottom_k.K
    assert [bottom_k.listed(n, 80) for n in (1, 3, 4, 10, 25)] == [0, 0, 1, 3, 6]
    assert bottom_k.listed(1000, 80, 32) == 32 - 9 + 1


def test_a_pair_of_many_lists_is_compared_in_the_first(monkeypatch):
    """Members of ten lists that are too far apart to link, two of them from the fourth list on."""
    draw = np.random.default_rng(11)
    base = draw.integers(0, 1 << 63, 400).astype(np.uint64)
    sets = [np.sort(np.append(draw.permutation(base)[34:], draw.integers(0, 1 << 63, 34).astype(np.uint64))) for _ in range(8)]
    keys = {i: list(range(3 if i > 5 else 0, 10)) for i in range(8)}
    batches = []
    for key in range(10):
        rows = [(i, side) for i in range(8) if key in keys[i] for side in (0, 1)]
        ids = np.array([i for i, _ in rows])
        batches.append(pa.record_batch([
            pa.array(np.full(len(rows), key)), *(pa.array(np.zeros(len(rows), np.int32)) for _ in range(2)),
            pa.array(ids), pa.array(ids), pa.array(np.array([s for _, s in rows], np.int32)), pa.array([True] * len(rows)),
            pa.array([keys[i] for i in ids], pa.list_(pa.int64())), pa.array(np.full(len(rows), 400)),
            pa.array([(sets[i][:bottom_k.K] >> np.uint64(32)).astype(np.uint32).view(np.int32).tolist() for i in ids], pa.list_(pa.int32())),
            pa.array([sets[i].tobytes() for i in ids], pa.binary()),
        ], names=[*bottom_k._CELL, "items"]))
    compared, linked = [], bottom_k._linked

    def recorded(x, y, percent):
        compared.append(frozenset(next(i for i in range(8) if np.array_equal(sets[i], v)) for v in (x, y)))
        return linked(x, y, percent)

    monkeypatch.setattr(bottom_k, "_linked", recorded)
    assert not sum(b.num_rows for b in bottom_k._settled(80)(iter(batches)))
    short = [np.append(s[:bottom_k.K] >> np.uint64(32), []).astype(np.uint32)[None] for s in sets]
    likely = [frozenset((i, j)) for i in range(8) for j in range(i) if bottom_k.may_link(400, np.array([400]), short[i], short[j], 80)[0]]
    assert sorted(map(sorted, compared)) == sorted(map(sorted, likely)) and len(likely) > 20
    suspects = list(bottom_k._suspects(80)(iter(batches)))
    assert [b.column("key")[0].as_py() for b in suspects] == [0, 3]
