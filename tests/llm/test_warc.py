import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tidewatch.llm import warc

LONG = "<p>" + "ä" * 100 + "</p>"
PAGES = [
    (5, "http://b.example.org/x", LONG), (3, "https://a.example.org:8080/y?q=1", LONG), (9, None, LONG), (1, "http://b.example.org/x", "short"),
    (2, "http://b.example.org/z\nInjected: 1", "short"), (4, "not a url", None), (6, "http://[broken", ""), (7, "http://c.example.org/long", "x\r\n\r\ny" * 200_000),
    (None, "http://d.example.org", LONG), (8, "http://b.example.org/x", "ü" * 50), (10, "http://b.example.org/x", "ü" * 50), (10, "http://b.example.org/x", "ü" * 50),
]


def expected(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        p = (h or "").encode()
        revisit = len(p) >= 100 and h in first and first[h] != i and sum(x[2] == h for x in rows) > 1
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if revisit else "response", first[h] if revisit else None))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def archive(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(4)
    folder = warc.archive_folder(pages)
    return folder, warc.build_index(warc.write_archives(pages, folder))


def test_round_trip(archive):
    folder, index = archive
    rows = warc.read_captures(index, folder).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=repr) == expected(PAGES)
    texts = {r.page_id: r.payload for r in rows if r.record_type == "response"}
    assert texts[7] == PAGES[7][2] and texts[3] == LONG and texts[4] == ""
    assert all(r.payload is None for r in rows if r.record_type == "revisit")
    urls = {r.page_id: r.url for r in rows}
    assert urls[9] is None and urls[5] == "http://b.example.org/x" and urls[2] == "http://b.example.org/z Injected: 1"


def test_lookup_finds_all_captures_of_a_key(spark, archive, monkeypatch):
    folder, index = archive
    asked = spark.createDataFrame([("http://b.example.org/x",), ("http://b.example.org/x",), ("http://nowhere.org/",), ("https://a.example.org:8080/y?q=1",)], "url string")
    assert sorted(r.page_id for r in warc.lookup(index, folder, asked).collect()) == [1, 3, 5, 8, 10, 10]
    assert sorted(r.page_id for r in warc.lookup(index, folder, spark.createDataFrame([(None,)], "url string")).collect()) == [9]


def test_small_blocks_and_many_equal_keys(spark):
    pages = spark.range(400).select(F.col("id").alias("page_id"), F.format_string("http://h%d.org/", F.col("id") % 3).alias("url"), F.concat(F.lit("p"), "id").alias("html"))
    folder = warc.archive_folder(pages)
    small = warc.write_archives(pages, folder)
    keep, warc.BLOCK_CAPTURES = warc.BLOCK_CAPTURES, 7
    try:
        index = warc.build_index(small.coalesce(1))
    finally:
        warc.BLOCK_CAPTURES = keep
    directory = index.where("directory IS NOT NULL")
    assert directory.agg(F.sum(F.size("directory"))).first()[0] == index.where("data IS NOT NULL").count()
    assert warc.lookup(index, folder, spark.createDataFrame([("http://h1.org/",)], "url string")).count() == 133
    assert warc.read_captures(index, folder, payload=False).count() == 400


def test_keys_bring_hosts_together():
    assert warc.host_key("https://www.a.org/x?y=1#z") == "org,a,www)/x?y=1"
    assert warc.host_key("http://a.org") == "org,a)/" and warc.host_key(None) == ""


def test_damage_is_noticed():
    record = warc._record("http://a.org", 1, "response", None, b"payload", hashlib.sha256(b"other").hexdigest(), "n")
    with pytest.raises(ValueError, match="damaged"):
        warc.parse_record(record)
    assert zlib.decompress(record, 31).startswith(b"WARC/1.1\r\nWARC-Type: response\r\n")


def test_no_pages(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string, _digest string, offset int")
    folder = warc.archive_folder(none)
    index = warc.build_index(warc.write_archives(none, folder))
    assert warc.read_captures(index, folder).collect() == [] and warc.lookup(index, folder, none).collect() == []
