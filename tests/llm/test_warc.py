import base64
import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from sluice.llm import warc
from sluice.llm.common import new_folder

SF = "/root/testdata/sf0.001"


def expected(rows, least=0):
    first = {}
    for page_id, html in rows:
        raw = (html or "").encode()
        if len(raw) >= least:
            first[raw] = max(first.get(raw, page_id), page_id)
    out = []
    for page_id, html in rows:
        raw = (html or "").encode()
        of = first.get(raw, page_id)
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((page_id, len(raw), digest, "response" if of == page_id else "revisit", None if of == page_id else of))
    return sorted(out)


@pytest.mark.parametrize("least", [0, 40])
def test_pages_come_back(spark, given, least):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    odd = spark.createDataFrame(
        [(90_001, None, "<p>☃ twice</p>"), (90_002, "http://x/a b\r\nc", "<p>☃ twice</p>"), (90_003, "u", None), (90_004, "u", ""), (90_005, "u", "z" * 3_000_000)],
        "page_id long, url string, html string",
    )
    pages = pages.unionByName(odd).withColumn("payload", F.lit("clash")).withColumn("digest", F.lit(1))
    rows = [(r.page_id, r.html) for r in pages.collect()]
    got = warc.archive_pages(spark, pages, min_bytes=least)
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.select(*cols).collect())) == expected(rows, least)
    assert warc.archive_pages(spark, pages.limit(0)).count() == 0


def test_files_are_plain_warc_and_payloads_survive(spark, given):
    pages = spark.createDataFrame([(k, f"http://h/{k}", f"<p>{k % 3}</p>" * 50) for k in range(20)], "page_id long, url string, html string")
    files = warc.write_pages(pages, new_folder(spark, "warc-test"), file_bytes=1500)
    listed = files.collect()
    assert sum(r.n_records for r in listed) == 20 and len({r.path for r in listed}) == len(listed) > 1
    data = b"".join(open(r.path.removeprefix("file://"), "rb").read() for r in listed)
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 20
    back = warc.read_archives(files).collect()
    assert {r.page_id: r.payload for r in back if r.record_type == "response"} == {k: (f"<p>{k % 3}</p>" * 50).encode() for k in (17, 18, 19)}
    assert {r.refers_to for r in back if r.record_type == "revisit"} == {17, 18, 19}


def test_repeated_and_missing_ids(spark, given):
    rows = [(1, "u", "a"), (1, "u", "a"), (None, "u", "a"), (None, "u", "b"), (None, "u", "b")]
    got = warc.archive_pages(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted(((r.page_id or 0, r.record_type, r.refers_to or 0) for r in got)) == [
        (0, "response", 0), (0, "response", 0), (0, "revisit", 1), (1, "response", 0), (1, "response", 0),
    ]


def record(block=b"HTTP/1.1 200 OK\r\n\r\nbody", **changes):
    headers = {"WARC-Type": "response", "WARC-Record-ID": "<urn:x-page:1>", "WARC-Block-Digest": f"sha1:{warc.digest_of(block)}", "Content-Length": str(len(block))}
    return warc.member(list((headers | changes).items()), block)


def test_the_reader_refuses_what_is_wrong():
    good = record()
    assert [r.payload for r in warc.read_bytes(good + good)] == [b"body", b"body"]
    assert warc.read_bytes(b"") == []
    for broken in (good[:-9], good[:20], b"no gzip", record(**{"Content-Length": "9999"}), record(**{"Content-Length": "3"}), record(**{"Content-Length": "x"})):
        with pytest.raises(warc.WarcError):
            warc.read_bytes(broken)
    bad = record(**{"WARC-Block-Digest": "sha1:AAAA"})
    with pytest.raises(warc.WarcError):
        warc.read_bytes(bad)
    assert len(warc.read_bytes(bad, verify=False)) == 1
