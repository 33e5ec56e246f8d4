"""Streams over files, run to the end of what is there."""

import random
import time

import pytest
from pyspark.sql import functions as F

from docweave import schemas
from docweave.operators import profile
from docweave.options import SyncOptions
from docweave.plans import sync
from docweave.sources import readers, store
from docweave.streaming import changes, monitors

FOLDERS = [("root", None, "Drive"), ("a", "root", "A")]
OPTS = SyncOptions(sync_roots=("a",), student_roots=())


def write_feed(spark, folder, number, rows):
    names = [f.name for f in schemas.CHANGE.fields]
    base = dict(drive_id="d", name="n.txt", mime_type="text/plain", removed=False, trashed=False, parents=["a"])
    frame = spark.createDataFrame([tuple({**base, **r}.get(n) for n in names) for r in rows], schemas.CHANGE)
    frame.coalesce(1).write.mode("append").parquet(str(folder))


def empty_tables(spark):
    index = "file_id string, uri string"
    return {
        "state": spark.createDataFrame([], schemas.STATE), "retry_queue": spark.createDataFrame([], schemas.RETRY_QUEUE),
        "split_queue": spark.createDataFrame([], schemas.SPLIT_QUEUE), "objects": spark.createDataFrame([], schemas.OBJECT),
        "staff_index": spark.createDataFrame([], index), "student_index": spark.createDataFrame([], index),
    }


def measure(frame):
    return frame.groupBy("file_id").agg(
        F.lit(10).cast("bigint").alias("raw_bytes"), F.lit(10).cast("bigint").alias("md_bytes"),
        F.concat(F.lit("h"), F.max("md5_checksum")).alias("content_hash"),
    )


def run(spark, feed, tables, folders, checkpoint):
    query = changes.run_changes(
        changes.read_feed(spark, str(feed)), tables, folders, measure, "s", OPTS, str(checkpoint), F.lit("2024-06-01").cast("timestamp")
    )
    query.awaitTermination()


def test_change_stream(spark, tmp_path):
    feed, checkpoint = tmp_path / "feed", tmp_path / "cp"
    folders = spark.createDataFrame(FOLDERS, "folder_id string, parent_id string, name string")
    tables = store.TableStore(spark, str(tmp_path / "tables"), changes.TABLES, buckets=4)
    assert tables.version() is None
    tables.load(empty_tables(spark))
    write_feed(spark, feed, 1, [dict(seq=1, file_id="f1", modified_time="t1", md5_checksum="1"), dict(seq=2, file_id="f2", modified_time="t1", md5_checksum="1")])
    run(spark, feed, tables, folders, checkpoint)
    assert tables.version() == 1
    assert sorted(r.uri for r in tables.read("staff_index").collect()) == ["gs://s/f1.md", "gs://s/f2.md"]
    # A change of f1, a removal of f2 and a stale one of f1 that must not undo the newer.
    write_feed(spark, feed, 2, [
        dict(seq=3, file_id="f2", removed=True), dict(seq=4, file_id="f1", modified_time="t2", md5_checksum="2"),
    ])
    run(spark, feed, tables, folders, checkpoint)
    assert tables.version() == 2
    state = {r.file_id: (r.status, r.content_hash) for r in tables.read("state").collect()}
    assert state == {"f1": ("INDEXED", "h2"), "f2": ("DELETED", "h1")}
    # A batch whose scope is in doubt is refused: nothing is published and the offset stays.
    write_feed(spark, feed, 3, [dict(seq=5, file_id="f3", modified_time="t1", md5_checksum="1", parents=["nowhere"])])
    with pytest.raises(Exception, match="refused"):
        run(spark, feed, tables, folders, checkpoint)
    assert tables.version() == 2
    known = folders.unionByName(spark.createDataFrame([("nowhere", "a", "N")], "folder_id string, parent_id string, name string"))
    run(spark, feed, tables, known, checkpoint)
    assert tables.version() == 3 and tables.read("state").filter("file_id = 'f3'").first().path == "Drive/A/N/n.txt"


def test_an_equal_page_changes_nothing_and_a_lost_row_refuses(spark, tmp_path, monkeypatch):
    folders = spark.createDataFrame(FOLDERS, "folder_id string, parent_id string, name string")
    tables = store.TableStore(spark, str(tmp_path / "tables"), changes.TABLES, buckets=4)
    tables.load(empty_tables(spark))
    feed = tmp_path / "feed"
    write_feed(spark, feed, 1, [dict(seq=1, file_id="f1", modified_time="t1", md5_checksum="1"), dict(seq=2, file_id="f2", modified_time="t1", md5_checksum="1")])
    page = spark.read.schema(schemas.CHANGE).parquet(str(feed))
    stamp = F.lit("2024-06-01").cast("timestamp")
    whole = sync.apply_changes

    def losing(*args):
        after = whole(*args)
        return after | {"staff_index": after["staff_index"].filter("file_id <> 'f2'")}

    monkeypatch.setattr(sync, "apply_changes", losing)
    with pytest.raises(changes.BatchRefused):
        changes.apply_batch(page, 0, tables, folders, measure, "s", OPTS, stamp)
    assert tables.version() == 0
    monkeypatch.setattr(sync, "apply_changes", whole)
    changes.apply_batch(page, 0, tables, folders, measure, "s", OPTS, stamp)
    again = sync.plan_changes(page, tables.read("state"), folders, measure(page), OPTS)
    assert {r.disposition for r in again.collect()} <= {"UNCHANGED", "HASH_UNCHANGED"}
    # A crash between stage and publish: the page is staged, then comes again.
    write_feed(spark, tmp_path / "next", 1, [dict(seq=3, file_id="f1", removed=True)])
    after = spark.read.schema(schemas.CHANGE).parquet(str(tmp_path / "next"))
    published = store.TableStore.publish
    monkeypatch.setattr(store.TableStore, "publish", lambda *_: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        changes.apply_batch(after, 1, tables, folders, measure, "s", OPTS, stamp)
    assert tables.version() == 1 and tables.read("staff_index").count() == 2
    monkeypatch.setattr(store.TableStore, "publish", published)
    changes.apply_batch(after, 1, tables, folders, measure, "s", OPTS, stamp)
    assert tables.version() == 2 and [r.uri for r in tables.read("staff_index").collect()] == ["gs://s/f2.md"]
    before = {n: sorted(map(str, tables.read(n).collect())) for n in changes.TABLES}
    assert tables.compact()
    assert {n: sorted(map(str, tables.read(n).collect())) for n in changes.TABLES} == before


def log_stream(spark, tmp_path, rows, schema):
    folder = tmp_path / "logs"
    frame = spark.createDataFrame(rows, schema).withColumn("ts", F.timestamp_seconds("s")).drop("s")
    for part in range(2):
        frame.filter(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(frame.drop("part").schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def drain(spark, frame, name, tmp_path):
    query = frame.writeStream.format("memory").queryName(name).outputMode("append").option(
        "checkpointLocation", str(tmp_path / f"cp-{name}")
    ).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.table(name).collect()


def wait_for(spark, name, rows, seconds=90):
    until = time.monotonic() + seconds
    while time.monotonic() < until:
        found = spark.table(name).collect()
        if len(found) >= rows:
            return found
        time.sleep(0.5)
    raise AssertionError(f"{name}: {spark.table(name).collect()}")


def follow(spark, frame, name, checkpoint, rows):
    """Run a stream with timers, which never ends by itself, until it has given so many rows."""
    query = frame.writeStream.format("memory").queryName(name).outputMode("append").option(
        "checkpointLocation", str(checkpoint)).trigger(processingTime="1 second").start()
    try:
        return wait_for(spark, name, rows)
    finally:
        query.stop()


def test_silence_is_alerted_when_all_input_stops(spark, tmp_path):
    """Gaps in the log, then a success just now, then nothing: the timer alone must fire, once."""
    folder, now = tmp_path / "successes", int(time.time())
    schema = "service string, s bigint"

    def put(*rows):
        spark.createDataFrame(rows, schema).select("service", F.timestamp_seconds("s").alias("ts")).coalesce(1).write.mode(
            "append").parquet(str(folder))

    put(("sync", now - 100), ("sync", now - 97), ("sync", now), ("other", now + 3600), ("other", None))
    stream = spark.readStream.schema("service string, ts timestamp").parquet(str(folder))
    query = monitors.silence_alerts(stream, 10, 0).writeStream.format("memory").queryName("silence").outputMode("append").option(
        "checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="1 second").start()

    def since():
        return [(r.service, int(r.since.timestamp())) for r in spark.table("silence").collect()]

    try:
        wait_for(spark, "silence", 1)
        assert since()[0] == ("sync", now - 97)  # the gap in the log
        last = int(time.time())
        put(("sync", last), ("sync", now - 50))  # a success moves the timer, a late row does not
        until = time.monotonic() + 90
        while ("sync", last) not in since() and time.monotonic() < until:
            time.sleep(0.5)
        assert time.time() >= last + 10  # no input came, the timer alone fired
        put(("sync", int(time.time()) + 600))  # the end of an alerted silence is no alert
        time.sleep(5)
        found = since()
        assert found.count(("sync", last)) == 1 and set(found) <= {("sync", now - 97), ("sync", now), ("sync", last)}
        assert query.exception() is None
    finally:
        query.stop()


def test_hourly_alerts_and_sessions(spark, tmp_path):
    rows = [("sync", "ERROR", "x", "q", 10, 0), ("sync", "INFO", "pageToken NOT committed", "q", 20, 0), ("sync", "INFO", "fine", "q", 30, 0), ("sync", "INFO", "end", "z", 90_000, 1)]
    stream = log_stream(spark, tmp_path, rows, "service string, severity string, message string, query_text string, s bigint, part int")
    alerts = drain(spark, monitors.hourly_alerts(stream, "NOT committed"), "hourly", tmp_path)
    assert [(r.matches, r.first_ts.second) for r in alerts] == [(2, 10)]
    bursts = drain(spark, monitors.query_bursts(stream), "bursts", tmp_path)
    assert [(r.query_text, r.calls) for r in bursts] == [("q", 3)]


def test_repeats_are_suppressed_across_batches(spark, tmp_path):
    draw = random.Random(3)
    seconds = sorted(draw.randrange(4000) for _ in range(300))
    rows = [(draw.choice(["q", "r", None]), s, i, 0 if i < 140 else 1) for i, s in enumerate(seconds)]
    rows += [("edge", s, 1000 + i, i // 3) for i, s in enumerate([0, 60, 61, 121, 122])]
    stream = log_stream(spark, tmp_path, rows, "query_text string, s bigint, event_id bigint, part int")
    batch = spark.createDataFrame(rows, "query_text string, s bigint, event_id bigint, part int").withColumn("ts", F.timestamp_seconds("s"))
    wanted = profile.answered_calls(batch, ["query_text"], 60).filter("answered").collect()
    answered = sorted(r.event_id for r in wanted)
    got = follow(spark, monitors.suppress_repeats(stream, ["query_text"], 60), "answers", tmp_path / "cp", len(answered))
    assert sorted(r.event_id for r in got) == answered
    assert sorted(r.event_id for r in got if r.query_text == "edge") == [1000, 1002, 1004]


def test_the_state_of_an_expired_key_is_gone(spark, tmp_path):
    folder = tmp_path / "calls"

    def put(name, second):
        spark.createDataFrame([(name, second, second)], "query_text string, s bigint, event_id bigint").withColumn(
            "ts", F.timestamp_seconds("s")).drop("s").coalesce(1).write.mode("append").parquet(str(folder))

    put("old", 10)
    stream = spark.readStream.schema("query_text string, event_id bigint, ts timestamp").parquet(str(folder))
    query = monitors.suppress_repeats(stream, ["query_text"], 1, 1).writeStream.format("memory").queryName("expiring").outputMode(
        "append").option("checkpointLocation", str(tmp_path / "cp")).trigger(processingTime="1 second").start()
    try:
        wait_for(spark, "expiring", 1)
        time.sleep(3)
        put("new", 20)
        wait_for(spark, "expiring", 2)
    finally:
        query.stop()
    state = spark.read.format("statestore").option("stateVarName", "last").load(str(tmp_path / "cp"))
    assert "old" not in [r[0] for r in state.select("key.query_text").collect()]


def stored(tables, name="x", **more):
    return sorted(tuple(r) for r in tables.read(name, **more).collect())


def pairs(spark, rows):
    return spark.createDataFrame(rows, "file_id string, v int")


def test_pages_of_a_keyed_table(spark, tmp_path):
    schema = pairs(spark, []).schema
    tables = store.TableStore(spark, str(tmp_path / "t"), {"x": schema, "y": schema}, buckets=4)
    assert tables.version() is None
    tables.load({"x": pairs(spark, [(f"f{i}", i) for i in range(20)]), "y": pairs(spark, [])})
    start = stored(tables)
    assert tables.version() == 0 and len(start) == 20 and stored(tables, "y") == []
    keys = spark.createDataFrame([("f3",), ("f4",), ("new",)], "file_id string")
    page = {"x": pairs(spark, [("f3", 30), ("f3", 31), ("new", 1)]), "y": pairs(spark, [("new", 9)])}
    # What a step that failed has staged is not seen, and its retry replaces it.
    tables.stage(1, {"x": pairs(spark, [("f9", -1)]), "y": pairs(spark, [])}, spark.createDataFrame([("f9",)], "file_id string"))
    assert stored(tables) == start
    tables.stage(1, page, keys)
    assert stored(tables) == start
    tables.publish(1)
    tables.publish(1)
    after = sorted([r for r in start if r[0] not in ("f3", "f4")] + [("f3", 30), ("f3", 31), ("new", 1)])
    assert stored(tables) == after and stored(tables, "y") == [("new", 9)]
    assert stored(tables, keys=keys) == [("f3", 30), ("f3", 31), ("new", 1)]
    assert stored(tables, version=0) == start
    tables.stage(2, {"x": pairs(spark, [("f4", 4)]), "y": pairs(spark, [])}, keys.filter("file_id <> 'f3'"))
    tables.publish(2)
    last = sorted([r for r in after if r[0] != "new"] + [("f4", 4)])
    assert stored(tables) == last and stored(tables, "y") == []
    # Only touched buckets get a new base, and the pages go.
    touched = tables.compact()
    assert 0 < len(touched) <= 3 and tables.compact() == []
    assert stored(tables) == last and stored(tables, "y") == []
    assert not list((tmp_path / "t" / "x" / "pages").glob("__v=*"))
    bases = {(p.parent.name, p.name) for p in (tmp_path / "t" / "x" / "base").glob("*/__v=*")}
    assert {b for b, v in bases if v == "__v=2"} <= {f"__bucket={b}" for b in touched}
    assert len({b for b, _ in bases}) == len(bases)  # one base for each bucket
    tables.stage(3, {"x": pairs(spark, []), "y": pairs(spark, [])}, keys.filter("file_id = 'f4'"))
    tables.publish(3)
    assert stored(tables) == [r for r in last if r[0] != "f4"]


def test_bytes_written_follow_the_page(spark, tmp_path):
    schema = pairs(spark, []).schema
    tables = store.TableStore(spark, str(tmp_path / "t"), {"x": schema})
    tables.load({"x": spark.range(50_000).select(F.concat(F.lit("file-"), F.col("id").cast("string")).alias("file_id"), F.lit(1).alias("v"))})

    def size():
        return sum(p.stat().st_size for p in (tmp_path / "t").rglob("*.parquet"))

    before = size()
    tables.stage(1, {"x": pairs(spark, [("file-1", 2)])}, spark.createDataFrame([("file-1",)], "file_id string"))
    tables.publish(1)
    assert size() - before < before / 20
    assert tables.read("x").count() == 50_000 and tables.read("x").filter("v = 2").count() == 1


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "docs" / "deep").mkdir(parents=True)
    for name in ("a.md", "b.hwp", "c.hwpx", "d.xlsx", "e.txt", "deep/f.md"):
        (tmp_path / "docs" / name).write_text("본문")
    found = readers.scan_documents(spark, str(tmp_path / "docs"))
    assert sorted(r.path.rsplit("/", 1)[1] for r in found.select("path").collect()) == ["a.md", "b.hwp", "c.hwpx", "d.xlsx", "f.md"]
    (tmp_path / "golden.json").write_text('[{"n": 1, "q": "질문", "type": "본문", "file_id": "f1", "also_accept": ["f2"]}, {"n": 2, "q": "x", "file_id": "f3"}]')
    golden = readers.read_golden(spark, str(tmp_path / "golden.json")).orderBy("n").collect()
    assert golden[0].also_accept == ["f2"] and golden[1].type is None
    texts = spark.createDataFrame([("f1", "body", "x"), ("f1", "sidecar", "y")], "file_id string, kind string, markdown string")
    store.write_documents(texts, str(tmp_path / "texts"), 1)
    store.write_documents(texts.filter("kind = 'body'").withColumn("markdown", F.lit("z")), str(tmp_path / "texts"), 1)
    kept = {(r.kind, r.markdown) for r in spark.read.parquet(str(tmp_path / "texts")).collect()}
    assert kept == {("body", "z"), ("sidecar", "y")}
    store.write_csv(spark.createDataFrame([("u", ["a", "b"])], "uri string, reasons array<string>"), str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first().reasons == "a|b"
    report = store.markdown_report("Quality", spark.createDataFrame([("strict", 3), ("bundle", 4)], "criterion string, n int"), "Criterion", "criterion")
    store.write_text(report, str(tmp_path / "md"))
    assert [r.value for r in spark.read.text(str(tmp_path / "md")).collect()] == [
        "# Quality", "", "| Criterion | n |", "| --- | --- |", "| bundle | 4 |", "| strict | 3 |",
    ]
    store.write_json(golden and spark.range(1), str(tmp_path / "json"))
