import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from idweave.llm import warc as w
from idweave.session import scratch_path

PAGES = [(1, "http://a.b/x", "hi"), (1, "http://a.b/x", "hi"), (None, None, None), (5, "no url\n", "hi"),
         (7, "http://a.b/x", ""), (None, "http://a.b/x", "hi"), (3, "http://A.b", "é\r\n\r\nWARC/1.1"),
         (2, "https://www.b.org/q?x=1#f", "hi"), (9, None, "z" * 3_000_000)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, 5, "x") for p in PAGES],
                                 "page_id long, url string, html string, digest int, file string")


def expected(rows):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        to = first.get(html or "")
        to = None if to == i else to
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                    "response" if to is None else "revisit", to))
    return sorted(out, key=repr)


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_edge_pages(pages):
    rows = w.warc_round_trip(pages, with_payload=True).collect()
    assert sorted((tuple(r[c] for c in COLUMNS) for r in rows), key=repr) == expected(PAGES)
    kept = {r.page_id: bytes(r.payload) for r in rows if r.record_type == "response"}
    assert kept[3] == "é\r\n\r\nWARC/1.1".encode() and len(kept[9]) == 3_000_000


def test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    copies = pages.unionByName(pages.withColumn("page_id", F.col("page_id") + 100_000))
    rows = w.warc_round_trip(copies).select(COLUMNS).collect()
    assert sorted(map(tuple, rows), key=repr) == expected([(r.page_id, r.url, r.html) for r in copies.collect()])


def test_look_up_over_block_borders(spark):
    rows = [(i, f"http://h{i % 7}.org/p", f"t{i}") for i in range(200)]
    folder = scratch_path(spark, "warc-test")
    captures = w.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), folder)
    index = w.build_index(captures, folder, block_lines=3)
    asked = captures.where("page_id % 3 = 0").select("url_key", "page_id")
    asked = asked.union(spark.createDataFrame([("org,none)/", 1), ("zz", 2)], asked.schema))
    found = w.lookup(index, asked).collect()
    assert sorted(bytes(r.payload).decode() for r in found) == sorted(f"t{i}" for i in range(0, 200, 3))


def test_records_are_readable_alone():
    data = w.record(4, "http://x.y/\r\n", b"body\r\n\r\n", w.base32_sha1(hashlib.sha1(b"body\r\n\r\n").hexdigest()), None)
    assert w.parse(data)["payload"] == b"body\r\n\r\n"
    with pytest.raises(ValueError):
        w.parse(data.replace(b"body\r\n\r\n", b"bodY\r\n\r\n"))


def test_empty_table(pages):
    assert w.warc_round_trip(pages.where("false")).count() == 0
