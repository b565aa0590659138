from conftest import SF, rows
from pyspark.sql import functions as F

from dealcast.llm import revisits

SCHEMA = "record_id long, url string, ts long, kind string, headers map<string,string>, payload_digest string, site string, row int"


def brute(records):
    """(record_id, refers_to) of each revisit, by a loop."""
    out = []
    for rid, url, ts, kind, *_ in records:
        if kind != "revisit":
            continue
        full = [(t, r if r is not None else -1) for r, u, t, k, *_ in records
                if k == "response" and u is not None and u == url and t is not None and ts is not None and t < ts]
        out.append((rid, max(full)[1] if full else None))
    return sorted(out, key=str)


def test_canonical_urls(spark):
    pairs = [("HTTP://WWW.Example.com:80/a/b/?z=1&utm_source=x&a=2#top", "example.com/a/b?a=2&z=1"), ("https://example.com", "example.com"),
             ("https://example.com/?ref=x", "example.com"), ("ftp://m.example.com:21/x", "m.example.com:21/x"), ("", ""), (None, None),
             ("example.com/Path//", "example.com/Path"), ("http://a.org/?&&b", "a.org?b")]
    got = spark.createDataFrame(pairs, "url string, want string").select(revisits.canonical_url(F.col("url")).alias("got"), "want").collect()
    assert [r.got for r in got] == [w for _, w in pairs]


def test_validators_and_headers(spark):
    h = {"ETag": '"a"', "Last-Modified": "m1", "Server": "s", "Date": "d1", "Content-Length": "9"}
    data = [(1, "http://x/p", 10, "response", h, "P1"), (2, "http://x/p", 20, "response", {**h, "ETag": 'W/"b"'}, "P2"), (3, "http://x/q", 5, "response", None, "P3"),
            (10, "https://www.x/p#f", 15, "revisit", {"etag": 'W/"a"', "DATE": "d2", "Server": "other", "Cache-Control": "c", "Content-Length": "0"}, None),
            (11, "http://x/p", 25, "revisit", {"etag": '"a"'}, None), (12, "http://x/p", 20, "revisit", {"Last-Modified": "m1"}, None),
            (13, "http://x/p", 10, "revisit", {}, None), (14, "http://x/q", 9, "revisit", {"etag": '"a"'}, None), (15, None, 9, "revisit", None, None),
            (16, "http://x/p", None, "revisit", None, None), (17, "http://x/p", 30, "revisit", {"Last-Modified": "m2"}, None),
            (17, "http://x/p", 30, "revisit", {"Last-Modified": "m2"}, None)]
    d = spark.createDataFrame([(*x, "clash", 1) for x in data], SCHEMA)
    got = {r.record_id: r for r in revisits.resolve_revisits(d, slices=3).collect()}
    assert {k: (r.refers_to, r.outcome) for k, r in got.items()} == {
        10: (1, "resolved"), 11: (2, "mismatch"), 12: (1, "resolved"), 13: (None, "orphan"), 14: (3, "unverified"), 15: (None, "no_url"),
        16: (None, "orphan"), 17: (2, "mismatch")}
    assert got[10].headers == {"etag": 'W/"a"', "last-modified": "m1", "server": "s", "date": "d2", "content-length": "9", "cache-control": "c"}
    assert got[10].payload_digest == "P1" and got[11].headers is None and got[11].payload_digest is None
    assert revisits.resolve_revisits(d).count() == 9
    assert revisits.resolve_revisits(d.limit(0)).count() == 0


def test_one_url_over_many_slices_matches_a_loop(spark):
    data = [(i, "u" if i % 3 else f"v{i % 7}", (i * 7919) % 211, "response" if i % 4 == 0 else "revisit", None, None) for i in range(400)]
    d = spark.createDataFrame([(*x, "s", 1) for x in data], SCHEMA)
    for slices in (1, 5, 16):
        assert rows(revisits.resolve_revisits(d, slices=slices).select("record_id", "refers_to")) == brute(data)


def test_pages(spark):
    found = revisits.resolve_revisits(revisits.crawl_of_pages(spark.read.parquet(f"{SF}/pages.parquet")))
    assert {r.outcome for r in found.select("outcome").distinct().collect()} >= {"resolved", "mismatch", "orphan"}
