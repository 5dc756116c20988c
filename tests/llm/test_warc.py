import gzip
import hashlib
import os
import zlib

import pytest

from fleetspark.llm import warc
from fleetspark.llm.common import new_path

BIG = "<p>" + "long page é " * 30
ROWS = [(3, "http://a/b c\r\nX: y", BIG, 1), (1, None, BIG, 1), (2, "http://b", "tiny", 1), (4, "http://c", "tiny", 1), (5, "u", None, 1), (None, "n", BIG, 1), (6, "u", "\r\n\r\nWARC/1.0\r\n" * 20, 1), (1, "twice", BIG, 1)]
SCHEMA = "page_id long, url string, html string, digest int"


def records(spark, pages, split, partitions=3):
    archives = warc.write_archives(warc.with_revisits(pages).repartition(partitions), new_path(spark, "warc"))
    return archives, warc.read_archives(archives, split_bytes=split)


@pytest.mark.parametrize("split", [37, 1000, 1 << 24])
def test_every_record_is_read_once_wherever_ranges_cut(spark, split):
    _, got = records(spark, spark.createDataFrame(ROWS, SCHEMA), split)
    rows = sorted((str(r["record_id"]), r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in got.collect())
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    size = lambda t: len((t or "").encode())
    want = [(str(i), "revisit" if h == BIG and i != 1 else "response", "1" if h == BIG and i != 1 else None, size(h), sha(h)) for i, _, h, _ in ROWS]
    assert rows == sorted(want, key=lambda r: (r[0], r[1]))


def test_archives_are_plain_gzip_and_payloads_come_back(spark):
    archives, got = records(spark, spark.createDataFrame(ROWS, SCHEMA), 500, 1)
    path = archives.first()["path"].removeprefix("file://")
    data = gzip.open(path).read()
    assert data.count(b"WARC/1.1\r\nWARC-Type") == len(ROWS) and b"\r\nX: y" not in data
    assert {bytes(r["payload"]).decode() for r in got.where("record_type = 'response'").collect()} == {h or "" for _, _, h, _ in ROWS}
    assert warc.list_archives(spark, os.path.dirname(path)).first()["bytes"] == os.path.getsize(path)


def test_a_false_start_is_passed_over(tmp_path):
    inner = warc.member(warc.record("9", "u", "x", "d", None))
    outer = gzip.compress(b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n")
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"\x1f\x8b\x08junk" + outer + b"\x1f\x8b\x08\x00" + inner)
    archive = warc.Archive(str(path))
    found = [r[0] for r in archive.records(0, archive.size)]
    assert found == ["1", "9"]
    cuts = [r[0] for a in range(0, archive.size, 5) for r in archive.records(a, a + 5)]
    assert cuts == found


def test_no_pages(spark):
    _, got = records(spark, spark.createDataFrame([], SCHEMA), 100)
    assert got.count() == 0


def test_damaged_records_are_an_error_or_passed_over(tmp_path):
    members = [warc.member(warc.record(str(i), "u", f"page {i} " * 50, "d", None)) for i in range(5)]
    members[1] = members[1][:60] + b"\0" * 20 + members[1][80:]
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"".join(members)[:-9])
    archive = warc.Archive(str(path))
    for step in (archive.size, 50):
        cuts = [(a, a + step) for a in range(0, archive.size, step)]
        assert [r[0] for a, b in cuts for r in archive.records(a, b, skip_damaged=True)] == ["0", "2", "3"]
        with pytest.raises((ValueError, zlib.error)):
            [list(archive.records(a, b)) for a, b in cuts]


def test_a_very_long_page_and_object_stores(spark):
    _, got = records(spark, spark.createDataFrame([(1, "u", "é" * 6_000_000, 0), (2, "u", "x", 0)], SCHEMA), 1000)
    rows = {r["record_id"]: (r["payload_bytes"], r["payload_digest"]) for r in got.drop("payload").collect()}
    assert rows["1"] == (12_000_000, hashlib.sha256(("é" * 6_000_000).encode()).hexdigest()) and rows["2"][0] == 1
    assert warc.spelled("s3a://bucket/folder") == "s3://bucket/folder" and warc.located("/tmp/x")[1] == "/tmp/x"
