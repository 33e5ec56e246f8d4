"""Scope, planning, merging, recovery and reconciliation on literal rows."""

import pytest
from pyspark.sql import functions as F

from docweave import schemas
from docweave.operators import corpus, gates, merge, prefix, profile, reconcile, recover, routing, scope
from docweave.options import MB, GateOptions, SyncOptions
from docweave.plans import sync
from docweave.sources import readers


def at():
    return F.lit("2024-06-01").cast("timestamp")


FOLDERS = [
    ("root", None, "Drive"), ("a", "root", "A"), ("b", "a", "B"), ("c", "b", ""),
    ("x", "y", "X"), ("y", "x", "Y"),            # a cycle
    ("m", "root", "M"), ("m", "b", "M"),         # two parents
    ("lost", "gone", "L"),                       # parent that cannot be looked up
]


def folders(spark):
    return spark.createDataFrame(FOLDERS, "folder_id string, parent_id string, name string")


def files(spark, rows):
    return spark.createDataFrame(rows, "file_id string, parent_id string, name string")


def test_scope(spark):
    rows = [
        ("direct", "a", "n"), ("grand", "c", "n"), ("outside", "root", "n"), ("cycle", "x", "n"), ("dag", "m", "n"),
        ("unknown", "lost", "n"), ("orphan", "nowhere", "n"), ("both", "lost", "n"), ("both", "a", "n"),
        ("rootless", None, "n"), ("listed", "root", "n"),
    ]
    out = scope.resolve_scope(files(spark, rows), folders(spark), ("a", "listed"), ("b",))
    got = {r.file_id: (r.scope, r.audience) for r in out.collect()}
    assert got == {
        "direct": ("IN", "STAFF"), "grand": ("IN", "STUDENT"), "outside": ("OUT", "STAFF"), "cycle": ("OUT", "STAFF"),
        "dag": ("IN", "STUDENT"), "unknown": ("UNKNOWN", "STAFF"), "orphan": ("UNKNOWN", "STAFF"), "both": ("IN", "STAFF"),
        "rootless": ("OUT", "STAFF"), "listed": ("IN", "STAFF"),
    }
    everything = scope.resolve_scope(files(spark, rows), folders(spark), ())
    assert {r.scope for r in everything.collect()} == {"IN"}


def test_files_under_roots_once(spark):
    rows = [("f", "m", "n"), ("g", "root", "n"), ("f", "b", "n")]
    assert [r.file_id for r in scope.files_under(files(spark, rows), folders(spark), ("a", "m")).collect()] == ["f"]


def test_paths(spark):
    rows = [("f1", "c", "n.pdf"), ("f2", "x", "n"), ("f3", "nowhere", "n"), ("f4", None, ""), ("f5", "lost", "n")]
    got = {r.file_id: (r.path, r.bundle) for r in scope.file_paths(files(spark, rows), folders(spark)).collect()}
    assert got == {
        "f1": ("Drive/A/B/c/n.pdf", "c"), "f2": ("Y/X/n", "X"), "f3": ("n", ""), "f4": ("f4", ""), "f5": ("L/n", "L"),
    }


def test_deep_paths_reach_the_top(spark):
    chain = [(f"d{i}", f"d{i + 1}", f"d{i}") for i in range(50)] + [("d50", None, "d50")]
    frame = spark.createDataFrame(chain, "folder_id string, parent_id string, name string")
    got = scope.file_paths(files(spark, [("f", "d0", "n")]), frame).first().path.split("/")
    assert got == [f"d{i}" for i in range(50, -1, -1)] + ["n"]


@pytest.mark.parametrize("mime, name, removed, route", [
    ("application/x-hwp ", "", False, "HWP_PARSE"), ("application/octet-stream", "a.HWPX", False, "HWP_PARSE"),
    ("application/vnd.google-apps.document", "a", False, "GOOGLE_EXPORT"), ("application/ZIP", "a.zip", False, "FILE_COPY"),
    ("application/vnd.ms-excel.sheet.macroenabled.12", "a.xlsm", False, "FILE_COPY"), ("image/png", "a", False, "SKIP"),
    (None, None, False, "SKIP"), ("application/pdf", "a.pdf", True, "DELETE"),
])
def test_routes(spark, mime, name, removed, route):
    frame = spark.createDataFrame([(mime, name, removed)], "m string, n string, r boolean")
    assert frame.select(routing.classify_route(F.col("m"), F.col("n"), F.col("r"))).first()[0] == route


def gate_rows(spark, rows):
    frame = spark.createDataFrame(
        rows, "file_id string, route string, mime_type string, name string, size_bytes bigint, raw_bytes bigint, md_bytes bigint, parts int"
    )
    cols = [F.col(c) for c in ("route", "mime_type", "name", "file_id", "size_bytes", "raw_bytes", "md_bytes", "parts")]
    checks = routing.size_gates(*cols, 150 * MB)
    out = frame.select("file_id", F.coalesce(checks["before"], checks["original"], checks["product"]).alias("why"))
    return {r.file_id: r.why for r in out.collect()}


def test_what_each_size_gate_measures(spark):
    pdf, xlsx, big = "application/pdf", routing.XLSX, 60 * MB
    got = gate_rows(spark, [
        ("split", "FILE_COPY", pdf, "a.pdf", big, big, None, 2), ("unsplit", "FILE_COPY", pdf, "a.pdf", big, big, None, None),
        ("sheet", "FILE_COPY", xlsx, "a.xlsx", big, big, 100, None), ("wide", "FILE_COPY", xlsx, "a.xlsx", 1, 1, 11 * MB, None),
        ("text", "FILE_COPY", "text/plain", "a.txt", 11 * MB, None, None, None), ("zip", "FILE_COPY", "application/zip", "a.zip", big, None, None, None),
        ("hwp", "HWP_PARSE", "application/x-hwp", "a.hwp", big, big, 10, None), ("huge", "HWP_PARSE", "", "a.hwpx", 151 * MB, None, None, None),
        ("export", "GOOGLE_EXPORT", "application/vnd.google-apps.document", "a", None, 51 * MB, None, None), ("small", "FILE_COPY", pdf, "", None, 5, None, None),
    ])
    assert got == {
        "split": None, "unsplit": f"SIZE_EXCEEDED:{big}>{50 * MB}(.pdf)", "sheet": None,
        "wide": f"SIZE_EXCEEDED:{11 * MB}>{10 * MB}(.md)", "text": f"SIZE_EXCEEDED:{11 * MB}>{10 * MB}(.md)", "zip": None,
        "hwp": None, "huge": f"SIZE_EXCEEDED:{151 * MB}>{150 * MB}(.hwpx)", "export": f"SIZE_EXCEEDED:{51 * MB}>{50 * MB}(.docx)", "small": None,
    }


def test_quality_gate(spark):
    rows = [(1, 1000, 100, 10, 2), (2, 1000, 100, 10, 8), (3, 5, 100, 0, 0), (4, 100, 1_000_000, 0, 0), (5, 0, 0, 0, 0)]
    frame = spark.createDataFrame(rows, "i int, text_length int, source_bytes int, table_count int, tables_rendered int")
    got = {r.i: list(r.reasons) for r in gates.evaluate_quality(frame).collect()}
    assert got == {
        1: ["G2_TABLE_LOST:8/10=0.800>0.3"], 2: [], 3: ["EMPTY_TEXT:5<20"], 4: ["G1_DENSITY:0.000100<0.0005"],
        5: ["G1_DENSITY:0.000000<0.0005", "EMPTY_TEXT:0<20"],
    }
    kind = gates.gate_disposition(F.col("triggered"), F.col("empty_text"), GateOptions(mode="reject"))
    out = {r.i: r.kind for r in gates.evaluate_quality(frame).select("i", kind.alias("kind")).collect()}
    assert out == {1: "QUALITY_GATE", 2: "pass", 3: "EMPTY_TEXT", 4: "QUALITY_GATE", 5: "EMPTY_TEXT"}


def test_change_pages(spark):
    rows = [(i, "d", "" if i in (3, 7) else f"f{i}") for i in range(1, 8)]
    feed = spark.createDataFrame(rows, "seq bigint, drive_id string, file_id string")
    def page(limit, token=None):
        tokens = None if token is None else spark.createDataFrame([("d", token)], "drive_id string, token bigint")
        row = readers.page_tokens(feed, limit, tokens).first()
        return row.kept, row.token, row.has_more

    assert page(2) == (2, 2, True)
    assert page(5) == (5, 6, True)       # only a blank id follows
    assert page(6) == (5, 7, False)
    assert page(2, 5) == (1, 7, False)
    assert page(2, 7) == (0, 7, False)   # no change keeps the token
    assert [r.seq for r in readers.change_page(feed, 3).orderBy("seq").collect()] == [1, 2, 4]


def state_frame(spark, rows):
    names = [f.name for f in schemas.STATE.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schemas.STATE)


def test_merge_keeps_unnamed_fields(spark):
    state = state_frame(spark, [
        {"file_id": "a", "status": "INDEXED", "path": "p", "error": "e", "drive_id": "d", "source_uri": "http://x"},
        {"file_id": "b", "status": "FAILED", "path": "q"},
    ])
    gone = merge.merge_rows(state, merge.deleted_rows(spark.createDataFrame([("a",), ("new",)], "file_id string"), at()))
    got = {r.file_id: r for r in gone.collect()}
    assert (got["a"].status, got["a"].error, got["a"].path, got["a"].source_uri) == ("DELETED", None, "p", "http://x")
    assert (got["new"].status, got["new"].path) == ("DELETED", None) and got["b"].status == "FAILED"
    whole = merge.merge_rows(state, state_frame(spark, [{"file_id": "a", "status": "PARSED"}]))
    assert {r.file_id: (r.status, r.path) for r in whole.collect()}["a"] == ("PARSED", None)


def queue_frame(spark, rows):
    names = [f.name for f in schemas.RETRY_QUEUE.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schemas.RETRY_QUEUE)


def test_queue_and_index_marks(spark):
    state = state_frame(spark, [{"file_id": "a", "status": "FAILED"}, {"file_id": "b", "status": "PARSED"}])
    queue = queue_frame(spark, [{"file_id": "a", "reason": "r", "retry_count": 2}, {"file_id": "c", "reason": "r"}])
    ids = spark.createDataFrame([("a",), ("b",), ("stub",), ("a",)], "file_id string")
    merged, (left,) = merge.mark_indexed(state, [queue], ids, at())
    assert {r.file_id: r.status for r in merged.collect()} == {"a": "INDEXED", "b": "INDEXED", "stub": "INDEXED"}
    assert [r.file_id for r in left.collect()] == ["c"]
    again = merge.enqueue(queue, spark.createDataFrame([("a", "x" * 3000)], "file_id string, reason string"), at())
    row = again.filter("file_id = 'a'").first()
    assert len(row.reason) == 3000 and row.retry_count == 2
    assert merge.record_attempts(queue, ids, at()).filter("file_id = 'a'").first().retry_count == 3


CHANGE = dict(drive_id="d", name="n.txt", mime_type="text/plain", modified_time="2024-05-02", removed=False, trashed=False, parents=["a"])


def plan(spark, changes, state=(), measures=(), opts=SyncOptions(sync_roots=("a",), student_roots=("b",))):
    names = [f.name for f in schemas.CHANGE.fields]
    rows = [tuple({**CHANGE, "seq": i, **c}.get(n) for n in names) for i, c in enumerate(changes)]
    frame = spark.createDataFrame(rows, schemas.CHANGE)
    measured = spark.createDataFrame(
        [(m.get("file_id"), m.get("raw_bytes", 10), m.get("md_bytes", 10), m.get("content_hash", "h")) for m in measures],
        "file_id string, raw_bytes bigint, md_bytes bigint, content_hash string",
    )
    return sync.plan_changes(frame, state_frame(spark, state), folders(spark), measured, opts)


def test_plan_and_apply(spark):
    changes = [
        {"file_id": "new"}, {"file_id": "moved_out", "parents": ["root"]}, {"file_id": "gone", "removed": True, "parents": ["root"]},
        {"file_id": "png", "mime_type": "image/png", "name": "x.png"}, {"file_id": "same"}, {"file_id": "stale", "modified_time": "2024-01-01"},
        {"file_id": "doubt", "parents": ["lost"]}, {"file_id": "twice"}, {"file_id": "twice", "removed": True}, {"file_id": " "},
        {"file_id": "evicted", "parents": ["root"]}, {"file_id": "parsed", "modified_time": "2024-01-01", "parents": ["b"]},
    ]
    old = dict(drive_id="d", status="INDEXED", modified_time="2024-04-01", path="p", content_hash="h", audience="STUDENT")
    state = [
        {**old, "file_id": "same"}, {**old, "file_id": "stale"}, {**old, "file_id": "moved_out"}, {**old, "file_id": "gone"},
        {**old, "file_id": "evicted", "status": "EXCLUDED", "error": "out_of_folder_scope"}, {**old, "file_id": "parsed", "status": "PARSED"},
    ]
    planned = plan(spark, changes, state, [{"file_id": f} for f in ("new", "same", "stale", "parsed")])
    got = {r.file_id: (r.disposition, r.cleanup_skipped) for r in planned.collect()}
    assert got == {
        "new": ("GCS_READY", False), "moved_out": ("EXCLUDED", False), "gone": ("DELETE_PENDING", False), "png": ("SKIPPED", False),
        "same": ("HASH_UNCHANGED", False), "stale": ("UNCHANGED", False), "doubt": ("FAILED", False), "twice": ("DELETE_PENDING", False),
        "evicted": ("EXCLUDED", True), "parsed": ("GCS_READY", False),
    }
    empty = queue_frame(spark, [])
    split = spark.createDataFrame([], schemas.SPLIT_QUEUE)
    index = spark.createDataFrame([("moved_out", "u1"), ("gone", "u2"), ("stale", "u3"), ("parsed", "old")], "file_id string, uri string")
    objects = spark.createDataFrame([("s", "gone.md"), ("s", "parsed.meta.md"), ("s", "gone1.md")], schemas.OBJECT)
    tables = {"state": state_frame(spark, state), "retry_queue": empty, "split_queue": split, "objects": objects, "staff_index": index, "student_index": index}
    after = sync.apply_changes(planned, tables, "s", at(), SyncOptions())
    states = {r.file_id: (r.status, r.modified_time, r.audience) for r in after["state"].collect()}
    assert states["same"] == ("INDEXED", "2024-05-02", "STAFF")      # the time moves, the audience follows the folder
    assert states["moved_out"][0] == "EXCLUDED" and states["gone"][0] == "DELETED" and states["parsed"][:1] == ("INDEXED",)
    assert states["stale"] == ("INDEXED", "2024-04-01", "STUDENT") and states["doubt"][0] == "FAILED"
    assert sorted(r.uri for r in after["staff_index"].collect()) == ["gs://s/new.md", "gs://s/parsed.md", "u3"]
    assert sorted(r.uri for r in after["student_index"].collect()) == ["gs://s/parsed.md", "u3"]
    assert sorted(r.name for r in after["objects"].collect()) == ["gone1.md", "new.md", "parsed.md"]
    assert [r.file_id for r in after["retry_queue"].collect()] == ["doubt"]
    legacy = sync.state_updates(planned, "s", at(), SyncOptions(legacy_audience=True)).filter("file_id = 'same'").first()
    assert "audience" not in legacy["__fields"]


def test_totals_and_gates(spark):
    outcomes = [("d", d, n) for d, n in [
        ("GCS_READY", 2), ("GCS_READY", 1), ("GCS_READY", 0), ("UNCHANGED", 0), ("HASH_UNCHANGED", 0), ("SKIPPED", 0), ("skipped", 0),
        ("DLQ", 0), ("SPLIT_QUEUED", 0), ("DELETE_PENDING", 0), ("EXCLUDED", 0), ("??", 0),
    ]]
    frame = spark.createDataFrame(outcomes, "drive_id string, disposition string, uri_count int")
    t = reconcile.run_totals(frame).first().asDict()
    assert (t["listed"], t["gcs_uploaded"], t["uris"], t["failed"], t["skipped"], t["unchanged"], t["parked"]) == (12, 2, 3, 2, 2, 2, 2)
    done = reconcile.reconcile(reconcile.run_totals(frame).withColumn("indexed", F.lit(3))).first()
    assert done.unaccounted == 0 and done.ok
    runs = [("t", 0, 0, 3, 3, True), ("", 0, 0, 3, 3, True), ("t", 1, 0, 3, 3, True), ("t", 0, 1, 3, 3, True), ("t", 0, 0, 2, 3, True), ("t", 0, 0, 3, 3, False)]
    frame = spark.createDataFrame(runs, "token string, failed int, index_failed int, indexed int, uris int, ok boolean").selectExpr("*", "true as has_more", "1 as page")
    assert [r.commit for r in reconcile.commit_gates(frame, 50).collect()] == [True] + [False] * 5
    assert reconcile.commit_gates(frame, 1).first().next_page is False


def test_import_outcomes(spark):
    rows = [(2, 2, 0, 0), (2, 1, 1, 0), (2, 1, 0, 1), (2, None, 0, 0), (2, 1, 0, 0)]
    frame = spark.createDataFrame(rows, "r int, i int, f int, s int")
    out = frame.select(reconcile.import_outcome(*(F.col(c) for c in "rifs")))
    assert [r[0] for r in out.collect()] == [True, False, True, True, False]


def test_round_robin(spark):
    frame = spark.createDataFrame([(f"f{i}",) for i in range(10)], "file_id string")
    cursor, seen = None, []
    for _ in range(3):
        page = recover.round_robin_page(frame, 4, cursor)
        seen.append([r.file_id for r in page.collect()])
        cursor = recover.page_cursor(page, cursor).first().cursor
    assert seen == [["f0", "f1", "f2", "f3"], ["f4", "f5", "f6", "f7"], ["f8", "f9", "f0", "f1"]] and cursor == "f1"
    assert len(recover.round_robin_page(frame, 99, "f5").collect()) == 10


def test_orphans(spark):
    names = ["live.md", "gone.part1.pdf", "gone.hwp", "out.meta.md", "who.md", ".md"]
    objects = spark.createDataFrame([("s", n) for n in names], schemas.OBJECT)
    state = spark.createDataFrame([("live", "FAILED"), ("gone", "DELETED"), ("out", "EXCLUDED")], "file_id string, status string")
    assert sorted(r.file_id for r in profile.orphans(objects, state).collect()) == ["gone", "gone", "out", "who"]
    assert sorted(r.file_id for r in profile.orphans(objects, state, only_deleted=True).collect()) == ["gone", "gone"]


def test_objects_per_type(spark):
    rows = [
        ("h", "HWP_PARSE", "application/x-hwp", "a.hwp", None, None), ("p", "FILE_COPY", "application/pdf", "a.pdf", 2, None),
        ("q", "FILE_COPY", "application/pdf", "a.pdf", None, None), ("z", "FILE_COPY", "application/zip", "a.zip", None, None),
        ("s", "FILE_COPY", routing.XLSX, "a.xlsx", None, "locked"), ("g", "GOOGLE_EXPORT", "application/vnd.google-apps.presentation", "g", None, None),
    ]
    frame = spark.createDataFrame(rows, "file_id string, route string, mime_type string, name string, parts int, sheet_error string")
    got = {}
    for r in corpus.source_objects(frame).orderBy("file_id", "uri_no").collect():
        got.setdefault(r.file_id, []).append(r.object_name)
    assert got == {
        "h": ["h.md"], "p": ["p.part1.pdf", "p.part2.pdf", "p.meta.md"], "q": ["q.pdf", "q.meta.md"], "z": ["z.meta.md"],
        "s": ["s.meta.md"], "g": ["g.pptx", "g.meta.md"],
    }
    assert prefix.BLOCK_ROWS > 0
