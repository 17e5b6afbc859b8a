"""Main text and WARC derivatives of pages."""

import base64
import hashlib
import html
import json
import re

from xoutcome.llm import dom, sitetree, warc
from xoutcome.llm.queries import QUERIES


def plain(page):
    """The article of the given tables' template, by patterns only."""
    inner = re.search(r"<article>(.*)</article>", page or "", re.S)
    return " ".join(html.unescape(re.sub(r"<(?!/?b>)[^>]*>", " ", inner[1]).replace("<b>", "").replace("</b>", "")).split()) if inner else ""


def test_articles_of_all_pages(spark, middle):
    pages = {r.page_id: r for r in spark.read.parquet(f"{middle}/pages.parquet").collect()}
    got = QUERIES["op2_site_style_tree"](spark, middle).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == plain(pages[r.page_id].html) and r.n_chars == len(r.text)


def test_blocks():
    page = ("<body><div class='cookie-notice'>We use cookies</div><header><h1>Site</h1></header><div id=content class='has-sidebar'><p>One&nbsp;two <b>three<br>four"
            "<p>a &lt; b<ul><li>x<li>y</ul></div><aside>more</aside><form><p>mail</p></form><section class=comments><p>first!</p></section>"
            "<script>if (a</b) { '<p>no</p>' }</script><style>p{}</style><!-- <p>none</p> --><p>last</body>")
    blocks = [b.text for b in dom.read(page)[0] if not b.noise]
    assert blocks == ["One two three four", "a < b", "x", "y", "last"]
    assert dom.read("")[0] == [] and [b.text for b in dom.read("no markup &amp; text")[0]] == ["no markup & text"]


def test_low_branches_by_entropy(spark):
    """Without telling markup, what a host repeats on its pages goes and what differs stays."""
    rows = [(i, f"http://h.example/{i}", f"<html><body><div class=xa><p>Our shop sells {i % 2} things</p></div><div class=xb><p>story {i} of {i * i}</p>"
             f"<p>it goes on {i * 7}</p></div><div class=xc>All rights kept</div></body></html>") for i in range(60)]
    rows += [(100, None, None), (101, "bad url", ""), (102, "http://h.example/1", "<p>"), (103, "http://one.example/", "<div class=xb><p>alone</p></div>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS path", "'x' AS host")
    got = {r.page_id: r.text for r in sitetree.main_text(df).collect()}
    assert all(got[i] == f"story {i} of {i * i} it goes on {i * 7}" for i in range(60))
    assert (got[100], got[101], got[102], got[103]) == ("", "", "", "alone")
    assert sitetree.main_text(df.limit(0)).count() == 0


def test_derivatives_refer_to_their_response(spark, small):
    pages = {r.page_id: r for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    df = spark.read.parquet(f"{small}/pages.parquet")
    source = {r.page_id: bytes(r.response) for r in warc.responses(df).collect()}
    rows = warc.derivatives(warc.responses(df)).collect()
    assert len(rows) == len(pages)
    ids = set()
    for r in rows:
        kind, head, block = warc.parse(source[r.page_id])
        body = block.partition(b"\r\n\r\n")[2]
        assert kind == "response" and body.decode() == pages[r.page_id].html
        assert head["warc-payload-digest"] == "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()
        for data, what in ((r.metadata, "metadata"), (r.conversion, "conversion")):
            k, own, content = warc.parse(bytes(data))
            assert k == what and own["warc-refers-to"] == head["warc-record-id"] == r.source_id
            assert own["warc-block-digest"] == warc.digest(content) and own["warc-payload-digest"] == head["warc-payload-digest"]
            assert own["warc-target-uri"] == " ".join(pages[r.page_id].url.split()) and own["warc-date"] == head["warc-date"]
            ids.add(own["warc-record-id"])
            if what == "metadata":
                meta = json.loads(content)["Envelope"]
                assert meta["WARC-Header-Metadata"] == head
                links = meta["Payload-Metadata"]["HTTP-Response-Metadata"]["HTML-Metadata"]["Links"]
                assert len(links) == r.n_links == pages[r.page_id].html.count("<a href=")
            else:
                assert "track(" not in content.decode() and plain(pages[r.page_id].html)[:40] in " ".join(content.decode().split())
    assert len(ids) == 2 * len(rows)


def test_odd_pages(spark):
    df = spark.createDataFrame([(1, None, None), (1, None, None), (2, "http://a.example/x y", ""), (None, "http://b.example", "<a href='c?d'>é</a>")],
                               "page_id long, url string, html string")
    rows = warc.derivatives(warc.responses(df)).collect()
    assert len(rows) == 4 and sum(r.n_links for r in rows) == 1
    assert warc.derivatives(warc.responses(df.limit(0))).count() == 0


def _record(http: bytes, kind: str = "response", more: tuple = ()) -> bytes:
    return warc.record(kind, [("WARC-Record-ID", "<urn:uuid:1>"), *more, ("WARC-Target-URI", "http://a.example/"), ("WARC-Date", warc.DATE)], http)


def test_sources_as_they_come(spark):
    """Repeated headers, charsets, codings, other records, no records."""
    import gzip
    import zlib
    head = b"HTTP/1.1 200 OK\r\nSet-Cookie: a=1\r\nSet-Cookie: b=2\r\nContent-Type: text/html"
    coffee = "<title>caf\u00e9</title><p>caf\u00e9"
    chunked = b"".join(b"%x\r\n%s\r\n" % (len(c), c) for c in (coffee.encode()[:9], coffee.encode()[9:], b""))
    given = {
        "latin": head + b"; charset=ISO-8859-1\r\n\r\n" + coffee.encode("latin-1"),
        "declared": head + b"\r\n\r\n<meta charset='iso-8859-1'>" + coffee.encode("latin-1"),
        "gzip": head + b"\r\nContent-Encoding: gzip\r\n\r\n" + gzip.compress(coffee.encode()),
        "deflate": head + b"\r\ncontent-encoding: deflate\r\n\r\n" + zlib.compress(coffee.encode()),
        "chunked": head + b"\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked,
        "unknown": head + b"; charset=no-such\r\n\r\n" + coffee.encode(),
    }
    rows = [(k, _record(v, more=(("WARC-Concurrent-To", "<urn:uuid:2>"), ("WARC-Concurrent-To", "<urn:uuid:3>")))) for k, v in given.items()]
    rows += [("null", None), ("request", _record(b"GET / HTTP/1.1", "request")), ("none", b"no record"), ("brotli", _record(head + b"\r\nContent-Encoding: br\r\n\r\nxyz"))]
    df = spark.createDataFrame(rows, "page_id string, response binary").selectExpr("*", "1 as title", "2 as metadata")
    got = {r.page_id: r for r in warc.derivatives(df).collect()}
    for k in given:
        assert got[k].title == "caf\u00e9" and warc.parse(bytes(got[k].conversion))[2].decode() == "caf\u00e9", k
        envelope = json.loads(warc.parse(bytes(got[k].metadata))[2])["Envelope"]
        assert envelope["WARC-Header-Metadata"]["warc-concurrent-to"] == ["<urn:uuid:2>", "<urn:uuid:3>"]
        assert envelope["Payload-Metadata"]["HTTP-Response-Metadata"]["Headers"]["Set-Cookie"] == ["a=1", "b=2"]
    for k in ("null", "request", "none"):
        assert all(v is None for name, v in got[k].asDict().items() if name != "page_id")
    assert got["brotli"].n_links == 0 and warc.parse(bytes(got["brotli"].conversion))[2] == b""


def test_pages_in_one_pass():
    text = ("<!DOCTYPE html><head><title>A &amp;\n B</title><style>p{}</style><script>if (a<b) '<p>x</p>'</script></head><body class=x><p>one <b>two</b><br>three"
            "<!-- <p>no</p> --><a href='/x?a=1&amp;b=2'>l</a><img src=i.png alt='a > b'><noscript><p>no</p></noscript><p>a < b &lt;<template>no</template><hr>last")
    title, links, blocks = warc.page(text, "http://h.example/d/")
    assert title == "A & B" and [x["url"] for x in links] == ["http://h.example/x?a=1&b=2", "http://h.example/d/i.png"]
    assert blocks == ["one two threel", "a < b <", "last"]
    import time
    start = time.perf_counter()
    for bad in ("<a " * 100_000, "<a '" * 50_001, "<p>" * 100_000, "<script>" * 100_000, "<!--" * 100_000, "<" * 300_000, '<a b="' + "<" * 100_000):
        warc.page(bad, "")
    assert time.perf_counter() - start < 20


def test_whole_text_of_all_pages(spark, middle):
    """The conversion record against the page without markup by other patterns."""
    rows = {r.page_id: r.html or "" for r in spark.read.parquet(f"{middle}/pages.parquet").collect()}
    for r in warc.derivatives(warc.responses(spark.read.parquet(f"{middle}/pages.parquet"))).collect():
        body = re.sub(r"(?s)<!--.*?-->|<(script|style|title)\b.*?</\1>|<head\b.*?</head>", " ", rows[r.page_id])
        bare = html.unescape(re.sub(r"</?b>", "", body))
        wanted = " ".join(html.unescape(re.sub(r"<[^<>]*>", " ", re.sub(r"</?b>", "", body))).split())
        assert " ".join(warc.parse(bytes(r.conversion))[2].decode().split()) == wanted, bare[:200]
