import random

import numpy as np
import pyarrow as pa
import pytest

from docweave.llm import ngram_join
from docweave.llm.components import components


def shingles(text, width):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        lower = lower.replace(blank, " ")
    words = [w for w in lower.split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(max(len(words) - width + 1, 1)))


def brute_force(rows, width, percent):
    sets = [shingles(text, width) for _, text, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(
        ((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, *_) in enumerate(rows)), key=repr
    )


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80)])
def test_matches_brute_force(docs, rows, width, percent):
    found = sorted((tuple(r) for r in ngram_join.join(docs, width, percent).collect()), key=repr)
    assert found == brute_force(rows, width, percent)


def test_chains_of_near_copies(spark):
    """Each text is linked with the next alone, and all meet in one component."""
    draw = random.Random(5)
    words = [f"t{i}" for i in range(120)]
    rows = []
    for i in range(40):
        rows.append((i, " ".join(words)))
        words[draw.randrange(120)] = f"new{i}"
        words[draw.randrange(120)] = f"other{i}"
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = sorted((tuple(r) for r in ngram_join.join(docs).collect()), key=repr)
    assert found == brute_force(rows, 4, 85)


def test_empty_table(no_docs):
    assert ngram_join.join(no_docs).count() == 0


@pytest.mark.parametrize("size", [7, 13, 40, 160, 900])
def test_sets_at_the_limit_share_a_signature(size):
    """Pairs whose similarity is just enough share a signature, whatever the shingles are."""
    draw = random.Random(size)
    for trial in range(30):
        words = [f"{trial}.{draw.random()}" for _ in range(size)]
        gone = size - -(-85 * size // 100)
        texts = pa.array([" ".join(words), " ".join(words[:size - gone])])
        sets = ngram_join.Sets(texts, 1)
        both = sets.sizes.min()
        assert 100 * both >= 85 * sets.sizes.max()
        ids = sets.ids()
        if ids[0] == ids[1]:
            continue
        keys, owners = ngram_join.signatures(sets, ids, 85)
        assert set(keys[owners == ids[0]].tolist()) & set(keys[owners == ids[1]].tolist())


def test_histograms_never_rule_out_a_link():
    draw = np.random.default_rng(1)
    for _ in range(50):
        x = draw.integers(0, 4, (1, ngram_join.CLASSES)).astype(np.uint8)
        y = np.maximum(x.astype(int) - (draw.random(x.shape) < 0.05), 0).astype(np.uint8)
        n_x, n_y = int(x.sum()), int(y.sum())
        if 100 * n_y >= 85 * n_x:
            assert ngram_join._may_link(np.array([n_x]), np.array([n_y]), x, y, 85)[1][0]


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 3), (20, 21), (30, 31), (31, 32), (32, 33), (33, 34), (34, 35), (35, 36)]
    found = {tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {(2, 1), (3, 1), (9, 1), (21, 20), *((i, 30) for i in range(31, 37))}


def test_a_pair_of_many_cells_is_given_once():
    """Members share many signatures: a task that meets them in a hundred cells gives each pair once."""
    rng = np.random.default_rng(5)
    members, cells = 30, 100
    classes = np.tile(rng.integers(0, 4, ngram_join.CLASSES), (members, 1)).astype(np.uint8)
    classes[np.arange(members), np.arange(members)] += rng.integers(0, 30, members).astype(np.uint8)
    n, ids = classes.sum(axis=1).astype(np.int64), rng.permutation(members).astype(np.int64)
    batches = [pa.record_batch([
        pa.array(np.full(members, key)), pa.array(np.zeros(members, np.int32)), pa.array(np.zeros(members, np.int32)),
        pa.array(np.zeros(members, np.int32)), pa.array(ids), pa.array(ids // 2), pa.array(n),
        pa.array([c.tobytes() for c in classes], pa.binary()),
    ], names=["key", "low", "high", "side", "id", "root", "n", "classes"]) for key in range(cells)]

    def apart(i, j):
        return int(np.abs(classes[i].astype(int) - classes[j].astype(int)).sum())

    may = {
        (min(ids[i], ids[j]), max(ids[i], ids[j])): apart(i, j) for i in range(members) for j in range(i)
        if ids[i] // 2 != ids[j] // 2 and apart(i, j) * 180 <= (n[i] + n[j]) * 20
        and min(n[i], n[j]) * 100 >= max(n[i], n[j]) * 80
    }
    given = [row for b in ngram_join._across(80, False)(iter(batches)) for row in zip(*(c.to_pylist() for c in b.columns))]
    assert len(given) == len(set(given)) and set(given) == set(may) and len(may) > 50
    near = [row for b in ngram_join._across(80, True)(iter(batches)) for row in zip(*(c.to_pylist() for c in b.columns))]
    assert len(near) == len(set(near)) and set(near) <= set(may)
    for root in {i // 2 for pair in may for i in pair}:
        of = {pair: gap for pair, gap in may.items() if root in (pair[0] // 2, pair[1] // 2)}
        assert any(pair in near and gap == min(of.values()) for pair, gap in of.items())


def test_tables_of_finished_steps_are_removed(spark, tmp_path, monkeypatch):
    """Only what the labels are read from stays, and the links."""
    from docweave.llm import shared

    monkeypatch.setattr(shared, "checkpoint_folder", lambda _: str(tmp_path))
    words = [f"w{i}" for i in range(60)]
    docs = spark.createDataFrame([(i, " ".join(words[:59] + [f"x{i}"])) for i in range(5)], "doc_id long, text string")
    assert {r.component_id for r in ngram_join.join(docs).collect()} == {0}
    assert {path.name.split("-")[0] for path in tmp_path.iterdir()} == {"signatures", "links"}


def test_whole_sets_are_made_for_likely_pairs_only(spark, monkeypatch):
    """Documents that share a signature but differ in too many shingles cost no whole set."""
    tables = []

    def recorded(df, name):
        tables.append((name, parked(df, name)))
        return tables[-1][1]

    parked = ngram_join.parked
    monkeypatch.setattr(ngram_join, "parked", recorded)
    monkeypatch.setattr(ngram_join, "unparked", lambda *_: None)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words[:199] + [f"x{i}"])) for i in range(3)]
    rows += [(10 + i, " ".join(words[:150] + [f"y{i}-{k}" for k in range(50)])) for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in ngram_join.join(docs).collect()}
    assert found == {0: 0, 1: 0, 2: 0, 10: 10, 11: 11, 12: 12, 13: 13}
    assert not [name for name, df in tables if "items" in df.columns and name != "items"]
    assert max(df.count() for name, df in tables if name == "items") == 3
    assert next(df for name, df in tables if name == "sets").count() == 7


def test_shuffle_files_go_with_the_write_of_a_table(spark):
    """Without waiting for the driver to collect its garbage, and other queries keep their setting."""
    from time import sleep

    from docweave.llm.shared import SHUFFLES_GO, parked

    def files() -> set[str]:
        manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {f for f in manager.getAllFiles().mkString(" ").split() if "/shuffle_" in f}

    before, setting = files(), spark.conf.get(SHUFFLES_GO)
    table = parked(spark.range(1000).repartition(3, "id"), "numbers")
    for _ in range(50):
        if not files() - before:
            break
        sleep(0.1)
    assert not files() - before
    assert table.count() == 1000 and spark.conf.get(SHUFFLES_GO) == setting


@pytest.mark.parametrize("blocks", [1, 4])
def test_whole_sets_travel_once_for_all_pairs_of_a_cell(spark, monkeypatch, blocks):
    """However many pairs a set has, it goes to as many cells as its group has blocks, at most."""
    draw, members = random.Random(7), 40
    sets = {i: sorted(draw.sample(range(80), 50)) for i in (*range(members), 1000, 1001)}
    pairs = [(i, j) for j in range(members) for i in range(j)] + [(1000, 1001)]
    if blocks > 1:
        monkeypatch.setattr(ngram_join, "BLOCK_BYTES", members * 50 * 8 // blocks)
    held = spark.createDataFrame(
        [(i, len(v), bytearray(np.array(v, np.uint64).tobytes())) for i, v in sets.items()], "id long, n long, items binary"
    )
    placed = ngram_join._placed(spark.createDataFrame(pairs, "x long, y long").repartition(3), held)
    cells = {}
    for row in placed.collect():
        cells.setdefault((row.key, row.low, row.high), set()).update((row.x, row.y))
    assert {key for key, _, _ in cells} == {0, 1000}
    assert max(sum(i in cell for cell in cells.values()) for i in sets) == blocks
    found = sorted(tuple(r) for r in ngram_join._verified(placed, held).collect())
    assert found == sorted((x, y, len(set(sets[x]) & set(sets[y])), 50, 50) for x, y in pairs)
