import math
import random

import numpy as np
import pytest

from docweave.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, score int, block string"


def make(seed: int = 5, n: int = 260, d: int = 6) -> list[tuple]:
    draw = random.Random(seed)
    rows = [
        (i, [np.float32(draw.gauss(0.4 if j == i % 3 else 0, 0.5)).item() for j in range(d)], draw.randrange(4), i, "x")
        for i in range(n)
    ]
    rows[3] = (3, rows[4][1], rows[4][2], 0, "tie")
    rows[50] = (50, rows[100][1], rows[100][2], 0, "anchors alike")
    return rows + [
        (300, None, 1, 0, "x"), (350, [0.1] * d, None, 0, "x"), (400, [0.1, None] + [0.0] * (d - 2), 1, 0, "x"),
        (450, [math.nan] + [0.1] * (d - 1), 1, 0, "x"), (500, [math.inf] + [0.1] * (d - 1), 1, 0, "x"),
        (None, [0.1] * d, 1, 0, "x"), (550, [0.2, 0.4], 2, 0, "short"), (600, [], 2, 0, "empty"),
        (650, [0.3] * d, 9, 0, "alone"), (651, [0.3] * d, 3, 0, "twice"), (651, [0.3] * d, 3, 0, "twice"),
        (652, [400.0] * d, 1, 0, "large"),
    ]


def brute(rows: list[tuple]) -> set[tuple]:
    known = {}
    for vec_id, x, label, *_ in rows:
        if vec_id is None or x is None or label is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        row = (label, [math.floor(256 * v) for v in x])
        known[vec_id] = min(row, known.get(vec_id, row))
    found = set()
    for a, (label, x) in known.items():
        if a % 50:
            continue
        scores = sorted((-sum(p * q for p, q in zip(x, y, strict=False)), b, other) for b, (other, y) in known.items() if b != a)
        for minus, p, _ in [s for s in scores if s[2] == label][:5]:
            fits = [s for s in scores if s[2] != label and 50 * -minus <= -100 * s[0] <= 95 * -minus]
            found |= {(a, p, r, n, -minus, -s) for r, (s, n, _) in enumerate(fits[:3], 1)}
    return found


@pytest.mark.parametrize(("block_rows", "round_anchors"), [(7, 3), (64, 1000)])
def test_equal_to_brute_force(spark, block_rows, round_anchors):
    rows = make()
    got = hn.mine(spark.createDataFrame(rows, SCHEMA).repartition(3), 50, block_rows, round_anchors).collect()
    assert len(got) == len({tuple(r) for r in got})
    assert {tuple(r) for r in got} == brute(rows)


def test_no_rows_and_rows_alone(spark):
    assert hn.mine(spark.createDataFrame([], SCHEMA)).collect() == []
    assert hn.mine(spark.createDataFrame([(50, [1.0], 1, 0, "x"), (51, [1.0], 2, 0, "x")], SCHEMA)).collect() == []


def test_the_curve_visits_each_cell_once_and_steps_to_a_neighbour():
    for axes, bits in ((2, 4), (3, 3), (8, 1)):
        cells = np.stack([m.ravel() for m in np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij")], axis=1)
        place = hn.hilbert(cells, bits)
        assert sorted(place.tolist()) == list(range(len(cells)))
        walk = cells[np.argsort(place)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_and_leave_blocks_out():
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(20, 8)) * 400
    blocks = [np.rint(c + draw.normal(size=(50, 8)) * 8) for c in centres]
    low, high = (np.stack([getattr(b, f)(axis=0) for b in blocks]) for f in ("min", "max"))
    anchors = np.rint(centres + draw.normal(size=(20, 8)) * 8)
    least, most = hn.reach(anchors, low, high)
    products = np.stack([(anchors @ b.T) for b in blocks], axis=1)
    assert (products >= least[..., None]).all() and (products <= most[..., None]).all()
    fifth = -np.sort(-products.reshape(20, -1), axis=1)[:, 4]
    assert (most < fifth[:, None]).mean() > 0.8


def test_best_keeps_ties_by_smaller_id():
    best = hn.Best(2, 2)
    best.add(np.array([0, 0, 1]), np.array([5.0, 5.0, 1.0]), np.array([9, 7, 3]))
    best.add(np.array([0, 0]), np.array([5.0, 4.0]), np.array([8, 1]))
    assert list(zip(best.slot.tolist(), best.score.tolist(), best.id.tolist(), strict=True)) == [(0, 5, 7), (0, 5, 8), (1, 1, 3)]
    assert best.floor.tolist() == [5, -math.inf]
