"""Jobs with a durable cursor over keyed tables, on literal rows."""

import pytest
from pyspark.sql import functions as F

from docweave import schemas
from docweave.options import SyncOptions
from docweave.plans import jobs, sync
from docweave.sources import store

OPTS = SyncOptions(sync_roots=("a",), max_changes=2, max_pages=10)


def now():
    return F.lit("2024-06-01").cast("timestamp")


@pytest.fixture
def folders(spark):
    return spark.createDataFrame([("root", None, "Drive"), ("a", "root", "A")], "folder_id string, parent_id string, name string")


def table(spark, schema, rows):
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def opened(spark, path, **rows):
    tables = store.TableStore(spark, str(path / "tables"), store.JOB_TABLES, buckets=4)
    tables.load({n: table(spark, s, rows.get(n, [])) for n, s in store.JOB_TABLES.items()})
    return tables


def feed(spark, rows):
    base = dict(drive_id="d", name="n.txt", mime_type="text/plain", removed=False, trashed=False, parents=["a"], modified_time="t1")
    return table(spark, schemas.CHANGE, [base | r for r in rows])


def measure(frame):
    return frame.groupBy("file_id").agg(
        F.lit(10).cast("bigint").alias("raw_bytes"), F.lit(10).cast("bigint").alias("md_bytes"),
        F.concat(F.lit("h"), F.max("file_id")).alias("content_hash"),
    )


def status(tables):
    return {r.file_id: r.status for r in tables.read("state").collect()}


def test_pages_go_on_behind_the_last_commit(spark, tmp_path, folders, monkeypatch):
    tables = opened(spark, tmp_path)
    rows = [dict(seq=i, file_id=f"f{i}") for i in range(1, 6)] + [dict(seq=9, file_id="x", drive_id="e", parents=["nowhere"])]
    changes = feed(spark, rows)
    whole, calls = sync.plan_changes, []

    def stops(*args):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("stopped")
        return whole(*args)

    monkeypatch.setattr(sync, "plan_changes", stops)
    with pytest.raises(OSError):
        jobs.daily_pages(tables, changes, folders, measure, "s", OPTS, now())
    assert jobs.cursors(tables) == {"token:d": "2"} and status(tables) == {"f1": "INDEXED", "f2": "INDEXED"}
    monkeypatch.setattr(sync, "plan_changes", whole)
    report = {(r.drive_id, r.page): (r.commit, r.listed) for r in jobs.daily_pages(tables, changes, folders, measure, "s", OPTS, now()).collect()}
    # The drive in doubt is refused, keeps its token and does not hold up the other.
    assert report == {("d", 1): (True, 2), ("e", 1): (False, 1), ("d", 2): (True, 1)}
    assert jobs.cursors(tables) == {"token:d": "5"}
    assert status(tables) == {f"f{i}": "INDEXED" for i in range(1, 6)}
    assert sorted(r.uri for r in tables.read("staff_index").collect()) == [f"gs://s/f{i}.md" for i in range(1, 6)]


def failed(name, **more):
    return dict(file_id=name, drive_id="d", name=f"{name}.txt", mime_type="text/plain", status="FAILED", modified_time="t1", error="timeout") | more


def test_retries(spark, tmp_path, folders, monkeypatch):
    states = [failed("f1"), failed("f2"), failed("f3"), failed("pic", mime_type="image/png"), failed("out"), dict(file_id="ok", status="INDEXED")]
    queue = [dict(file_id="f1", reason="old", retry_count=2), dict(file_id="f2", reason="old", retry_count=3), dict(file_id="pic", reason="old")]
    tables = opened(spark, tmp_path, state=states, retry_queue=queue)
    lookup = spark.createDataFrame(
        [("f1", 1, "a"), ("f2", 2, "a"), ("f3", 3, "nowhere"), ("pic", 4, "a"), ("out", 5, "root")], "file_id string, seq long, parent_id string"
    )
    whole = sync.plan_changes

    def dies(*args):
        raise OSError("parser down")

    monkeypatch.setattr(sync, "plan_changes", dies)
    with pytest.raises(OSError):
        jobs.retry_failed(tables, lookup, folders, measure, "s", OPTS, now())
    attempts = {r.file_id: r.retry_count for r in tables.read("retry_queue").collect()}
    assert attempts == {"f1": 3, "f2": 3, "f3": 1, "pic": 1, "out": 1}  # recorded before they are made
    monkeypatch.setattr(sync, "plan_changes", whole)
    tables = opened(spark, tmp_path / "again", state=states, retry_queue=queue)
    totals = jobs.retry_failed(tables, lookup, folders, measure, "s", OPTS, now()).first()
    assert totals.asDict() == dict(candidates=5, retried=4, recovered=2, still_failed=2, exhausted=1, indexed=1, ok=False)
    assert status(tables) == {"f1": "INDEXED", "f2": "FAILED", "f3": "FAILED", "pic": "SKIPPED", "out": "EXCLUDED", "ok": "INDEXED"}
    left = {r.file_id: (r.reason, r.retry_count) for r in tables.read("retry_queue").collect()}
    assert left == {"f2": ("old", 3), "f3": ("folder_scope_unknown", 1)}
    assert [r.uri for r in tables.read("staff_index").collect()] == ["gs://s/f1.md"]


def test_the_cursor_moves_past_exhausted_files(spark, tmp_path, folders):
    tables = opened(
        spark, tmp_path, state=[failed(f"f{i}", mime_type="image/png") for i in (1, 2, 3)],
        retry_queue=[dict(file_id=f, retry_count=3) for f in ("f1", "f2")],
    )
    lookup = spark.createDataFrame([(f"f{i}", i, "a") for i in (1, 2, 3)], "file_id string, seq long, parent_id string")
    first, second = (jobs.retry_failed(tables, lookup, folders, measure, "s", OPTS, now(), limit=2).first() for _ in range(2))
    assert (first.exhausted, first.retried) == (2, 0) and second.retried == 1
    assert jobs.cursors(tables) == {"retry-failed": "f1"}  # f3, then f1 from the front


def test_reindexing(spark, tmp_path):
    states = [dict(file_id=f"f{i}", status=s, audience=a, name=f"n{i}") for i, s, a in (
        (1, "PARSED", "STUDENT"), (2, "PARSED", "STAFF"), (3, "PARSED", "STAFF"), (4, "INDEXED", "STUDENT"), (5, "FAILED", "STAFF"))]
    objects = [dict(bucket="s", name=n) for n in ("f1.pdf", "f1.meta.md", "f2.part1.pdf", "f2.part2.pdf", "f4.md", "f5.md")]
    tables = opened(
        spark, tmp_path, state=states, objects=objects, retry_queue=[dict(file_id="f1", reason="old")],
        staff_index=[dict(file_id="f1", uri="gs://s/f1.old"), dict(file_id="f4", uri="gs://s/f4.old")],
    )
    lossy = lambda sent: sent.filter("uri <> 'gs://s/f2.part2.pdf' AND file_id <> 'f4'")
    totals = jobs.reindex_pending(tables, "s", OPTS, now(), imported=lossy).first()
    assert totals.asDict() == dict(candidates=3, with_uris=2, indexed=3, skipped_no_uri=1, failed=2, ok=False)
    assert status(tables) == {"f1": "INDEXED", "f2": "PARSED", "f3": "PARSED", "f4": "INDEXED", "f5": "FAILED"}
    assert {r.file_id: r.reason for r in tables.read("retry_queue").collect()} == {"f3": "reindex_no_source_uri"}
    assert sorted(r.uri for r in tables.read("staff_index").collect()) == ["gs://s/f1.meta.md", "gs://s/f1.pdf", "gs://s/f2.part1.pdf", "gs://s/f4.old"]
    assert {r.file_id for r in tables.read("student_index").collect()} == {"f1"}
    forced = jobs.reindex_pending(tables, "s", OPTS, now(), force=True, imported=lossy).first()
    assert (forced.candidates, forced.with_uris) == (4, 3) and status(tables)["f4"] == "PARSED"


def test_the_cursor_moves_past_files_without_objects(spark, tmp_path):
    tables = opened(
        spark, tmp_path, state=[dict(file_id=f"f{i}", status="PARSED") for i in (1, 2, 3)], objects=[dict(bucket="b", name="f3.pdf")]
    )
    first, second = (jobs.reindex_pending(tables, "b", OPTS, now(), limit=2).first() for _ in range(2))
    assert first.skipped_no_uri == 2 and second.with_uris == 1
    assert [r.uri for r in tables.read("staff_index").collect()] == ["gs://b/f3.pdf"]
