"""Exact round trip through archives and index."""

from __future__ import annotations

import gzip
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidebook.llm import warc
from tidebook.llm.common import table

SCHEMA = "page_id long, url string, html string"
BIG = "<p>" + "é" * 600


def rows():
    urls = ["http://www.Example.org:8080/a?b=1#frag", "https://user@example.org/a", "not a url", None, "http://h/with space\n", "http://example.org/a"]
    out = [(i, urls[i % len(urls)], f"<p>page {i}") for i in range(60)]
    out += [(100, "http://x.net/1", BIG), (101, "http://x.net/2", BIG), (102, "http://x.net/1", BIG), (103, "http://x.net/3", "y" * 999), (104, "http://x.net/4", "y" * 999)]
    return [*out, (200, None, None), (201, "http://x.net/5", ""), (None, "http://x.net/6", BIG), (7, urls[1], "<p>page 7")]


@pytest.fixture(scope="module")
def stored(spark):
    pages = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    captures, index = warc.archive(pages)
    return pages, captures, index


def test_round_trip(spark, stored):
    pages, captures, index = stored
    got = warc.read_records(warc.lookup(pages.select("url", "page_id"), index), index.folder).collect()
    assert len(got) == len(rows())
    kinds = {}
    for r in got:
        kinds.setdefault(r["page_id"], set()).add((r["record_type"], r["refers_to"]))
        assert r["payload"] is None or hashlib.sha1(r["payload"]).hexdigest() == r["payload_digest"]
    assert kinds[100] == kinds[101] == {("revisit", 102)} and kinds[102] == {("response", None)}
    assert kinds[103] == kinds[104] == kinds[None] == {("response", None)}
    sent = sorted((-1 if i is None else i, len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest()) for i, _, h in rows())
    assert sent == sorted((-1 if r["page_id"] is None else r["page_id"], r["payload_bytes"], r["payload_digest"]) for r in got)
    by_page = {r["page_id"]: bytes(r["payload"] or b"").decode() for r in got}
    assert all(by_page[i] == (h or "") for i, _, h in rows() if i not in (100, 101))


def test_lookup_by_url(spark, stored):
    _, _, index = stored
    wanted = spark.createDataFrame([("https://example.org/a",), ("http://x.net/1",), ("http://absent/",)], "url string")
    got = warc.lookup(wanted, index).collect()
    same_key = [i for i, u, _ in rows() if u in ("https://user@example.org/a", "http://example.org/a")]
    assert sorted(r["page_id"] for r in got) == sorted([*same_key, 100, 102])


def test_small_blocks_and_keys_that_span_them(spark):
    same = spark.createDataFrame([(i, "http://hot.org/", f"<p>{i}") for i in range(500)], SCHEMA)
    captures, index = warc.archive(same)
    index = warc.write_index(captures, index.folder + "-small", block_lines=7)
    assert len(index.parts) >= 1
    got = warc.lookup(spark.createDataFrame([("http://hot.org/",)], "url string"), index)
    assert sorted(r["page_id"] for r in got.collect()) == list(range(500))


def test_archives_are_gzip_members_of_warc_records(stored):
    _, captures, index = stored
    folder = Path("/" + index.folder.removeprefix("file:").lstrip("/"))
    for r in captures.limit(10).collect():
        data = (folder / r["file"]).read_bytes()
        record = gzip.decompress(data[r["offset"] : r["offset"] + r["length"]])
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert gzip.decompress(data).count(b"WARC/1.1\r\nWARC-Type: warcinfo") == 1


def test_url_keys(spark):
    urls = ["http://www.Example.org:8080/a?b#f", "https://example.org", "HTTP://u:p@A.b.c/x", "mailto:x", "", None, "http://a/ b"]
    got = spark.createDataFrame([(u,) for u in urls], "url string").select(warc.url_key(F.col("url")).alias("k")).collect()
    assert [r["k"] for r in got] == ["org,example,www)/a?b", "org,example)", "c,b,a)/x", "mailto:x", "", "", "a)/%20b"]


def test_whole_table(spark, sf):
    pages = table(spark, sf, "pages")
    _, index = warc.archive(pages)
    got = warc.read_records(warc.lookup(pages.select("url", "page_id"), index), index.folder)
    back = got.join(pages, "page_id").where(F.col("payload").cast("string") == F.coalesce("html", F.lit("")))
    assert back.count() == pages.count() == got.count()


def test_empty_table(spark):
    pages = spark.createDataFrame([], SCHEMA)
    captures, index = warc.archive(pages)
    assert captures.count() == 0 and warc.read_records(warc.lookup(pages, index), index.folder).count() == 0
