from collections import Counter

import corpus_pipeline
import __spark_entry__
from docweave.llm import pieces


def test_stages_follow_their_operators(spark, docs, rows, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    now, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, str(tmp_path))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{len(seen)}")
        now = spark.read.parquet(f"{tmp_path}/{len(seen)}")
        seen.append([tuple(r)[:5] for r in now.collect()])
    quality, exact, near, mixed, encoded = seen
    for before, after in ((rows, quality), (quality, exact), (exact, near)):
        assert not Counter(after) - Counter(map(tuple, before))
    squeeze = lambda text: "".join((text or "").split())
    assert len({squeeze(t) for _, t, *_ in quality}) == len(exact) == len({squeeze(t) for _, t, *_ in exact})
    assert set(mixed) <= set(near) and max(Counter(mixed).values()) <= 2
    assert Counter(mixed) == Counter(encoded)
    decoded = {r.text for r in pieces.decode(now, pieces.default_model()).collect()}
    assert decoded == {t for _, t, *_ in mixed}


def test_run_gives_the_rows_of_the_last_stage(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == [*docs.columns, "ids"] and out.count() > 0


def test_tables_of_finished_stages_are_removed(spark, docs, tmp_path, monkeypatch):
    """Of the stages' tables only the one that the last stage reads stays, and the input."""
    from docweave.llm import shared

    (tmp_path / "in").mkdir()
    monkeypatch.setattr(shared, "checkpoint_folder", lambda _: str(tmp_path))
    docs.write.parquet(f"{tmp_path}/in/documents.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/in").count() > 0
    left = {path.name.rsplit("-", 1)[0] for path in tmp_path.iterdir()}
    assert left & {name.replace(" ", "-") for name, _ in corpus_pipeline.STAGES} == {"mixing"}
    assert spark.read.parquet(f"{tmp_path}/in/documents.parquet").count() == docs.count()


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert len([k for k in names if k.startswith(f"op{n}_")]) == 1


def test_near_copies_go_and_texts_that_share_an_id_stay(spark):
    base = " ".join(f"w{i}" for i in range(60))
    copy, other = base.replace("w59", "changed"), " ".join(f"o{i}" for i in range(60))
    third = other.replace("o0", "changed")
    rows = [(1, base), (2, copy), (2, other), (None, third), (3, other + " more"), (None, ""), (4, None), (5, "x"), (6, "y")]
    docs = spark.createDataFrame([(d, t, "en", "s", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near(spark, docs, "")
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter([(1, base), (2, other), (None, ""), (4, None), (5, "x"), (6, "y")])
