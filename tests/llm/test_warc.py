import base64
import hashlib
import random
import re

import pytest

from tablecraft.llm import warc
from common import prose


def odd_pages(spark, n=60):
    rng = random.Random(2)
    fake = "WARC/1.0\r\nWARC-Type: response\r\nPage-ID: 666\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    bodies = [None, "", "WARC/1.0\r\n", fake, fake * 3, "x\r\n\r\n" + fake + "WARC/1.0\r\n\r\n\r\n", "é" * 3000, "WARC/1.0", "\r\n\r\n"]
    rows = [(i, rng.choice([None, f"http://h/{i}", "http://h/a\r\nb%0A"]), rng.choice(bodies + [prose(i), prose(i % 5, 40)])) for i in range(n)]
    rows += [(5, "u", "twice"), (5, "u", "twice"), (3, "u", "twice")]
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS file", "2 AS start")


def expected(rows, min_bytes):
    keep = {}
    for r in rows:
        keep[r.html or ""] = max(r.page_id, keep.get(r.html or "", -1))
    out = []
    for r in rows:
        body = (r.html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        revisit = len(body) >= min_bytes and keep[r.html or ""] != r.page_id
        out.append((str(r.page_id), r.url, len(body), digest, "revisit" if revisit else "response", str(keep[r.html or ""]) if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("split,min_bytes", [("128m", 0), ("3k", 0), ("700b", 20)])
def test_round_trip(spark, tmp_path, split, min_bytes):
    pages = odd_pages(spark).repartition(3)
    rows = pages.collect()
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        warc.write_archives(pages, str(tmp_path / "a"), min_bytes=min_bytes)
        read = warc.read_records(spark, str(tmp_path / "a"), with_payload=True).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    got = [(r.id, r.uri, r.payload_bytes, r.payload_digest, r.type, r.refers_to) for r in read]
    assert sorted(got, key=str) == expected(rows, min_bytes)
    texts = {(r.page_id, r.html or "") for r in rows}
    for r in read:
        assert r.type == "revisit" and len(r.payload) == 0 or (int(r.id), bytes(r.payload).decode()) in texts


def test_files_are_archives(spark, tmp_path):
    """A sequential reader finds the same records."""
    pages = odd_pages(spark).repartition(2)
    warc.write_archives(pages, str(tmp_path / "a"))
    n = 0
    for part in (tmp_path / "a").glob("part-*"):
        data, at = part.read_bytes(), 0
        while at < len(data):
            assert data.startswith(b"WARC/1.0\r\n", at)
            end = data.index(b"\r\n\r\n", at)
            length = int(re.search(rb"Content-Length: (\d+)", data[at:end])[1])
            assert data[end + 4 + length : end + 8 + length] == b"\r\n\r\n"
            at, n = end + 8 + length, n + 1
    assert n == pages.count()


def test_empty_table_and_nulls(spark):
    assert warc.archive_and_read(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    rows = warc.archive_and_read(spark.createDataFrame([(None, None, None)], "page_id long, url string, html string")).collect()
    assert [(r.id, r.uri, r.payload_bytes, r.type, r.refers_to) for r in rows] == [(None, None, 0, "response", None)]
