import hashlib

import pytest
from pyspark.sql import functions as F

from docweave.llm import warc

PAGES = "page_id long, url string, html string"


def pages_of(spark, n=300):
    rows = [(i, f"http://h{i % 7}.example/{i}", f"<p>é {i}\r\n\r\nWARC/1.0</p>" * (i % 9)) for i in range(n)]
    rows += [(None, None, None), (n, "http://x/\r\nEvil: 1", ""), (5, "http://h5.example/5", "<p>again</p>"), (5, "http://h5.example/5", "<p>again</p>")]
    return spark.createDataFrame(rows, PAGES).repartition(4)


@pytest.fixture(params=[16 << 20, 4000])
def archive(request, spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "SHARD_BYTES", request.param)
    pages = pages_of(spark)
    warc.write_archive(pages, f"{tmp_path}/one")
    return pages, tmp_path


def test_records_come_back_as_written(spark, archive):
    pages, folder = archive
    value = F.concat(warc.record(F.col("page_id"), F.col("url"), F.col("html")), F.lit("\r\n"))
    wanted = sorted((r.page_id or -1, hashlib.sha256(r.v.encode()).hexdigest()) for r in pages.select("page_id", value.alias("v")).collect())
    found = warc.leaves(spark, f"{folder}/one").collect()
    assert sorted((r.page_id or -1, r.sha256) for r in found) == wanted


def test_only_damaged_records_are_found(spark, archive):
    _, folder = archive
    broken = F.when(F.col("page_id").isin(3, 77, 200), F.replace(F.col("value"), F.lit("example"), F.lit("exbmple"))).otherwise(F.col("value"))
    warc.replicate(spark, f"{folder}/one", f"{folder}/two", broken)
    warc.replicate(spark, f"{folder}/one", f"{folder}/three")
    found = warc.audit(spark, f"{folder}/one", f"{folder}/two").filter("NOT intact").collect()
    assert sorted(r.page_id for r in found) == [3, 77, 200]
    assert warc.audit(spark, f"{folder}/one", f"{folder}/three").filter("NOT intact").count() == 0


def test_roots_follow_from_the_leaves(spark):
    digests = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(40)]
    leaves = spark.createDataFrame([(0, i, d) for i, d in enumerate(digests)], "shard int, leaf long, sha256 string")
    nodes, height = warc.tree(leaves)
    level = digests
    for _ in range(height):
        level = [hashlib.sha256("".join(level[i:i + warc.FANOUT]).encode()).hexdigest() for i in range(0, len(level), warc.FANOUT)]
    assert height == 2 and [r.digest for r in nodes.filter("level = 2").collect()] == level


def test_a_truncated_file_is_damaged_behind_the_cut():
    data = b"".join(
        f"WARC/1.0\r\nWARC-Record-ID: <urn:page:{i}>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n".encode() for i in range(3)
    )
    assert [(n, p) for _, n, p in warc.split_records(data)] == [(len(data) // 3, i) for i in range(3)]
    cut = list(warc.split_records(data[:-10]))
    assert [p for *_, p in cut] == [0, 1, None] and cut[-1][1] == len(data) // 3 - 10


def test_empty_table(spark):
    assert warc.audited(spark.createDataFrame([], PAGES)).count() == 0
