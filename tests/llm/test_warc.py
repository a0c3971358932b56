"""WARC derivatives against a brute-force reading of pages with the standard parser, and a round trip of records."""

import base64
import hashlib
from html.parser import HTMLParser

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from askmine.llm import warc

PAGES = [
    (0, "http://a.org/x/", "<!DOCTYPE html><html lang='de'><head><title>T &amp; t</title><style>p{}</style></head><body><p>One <b>two</b><br>three<script>if (a < b) x('</p>')</script><a href='y?z=1'>four</a><!-- five --><div>six</div></body></html>"),
    (1, "http://b.org", "no markup at all  here\r\n\r\n  and &lt;there&gt;"),
    (2, None, None),
    (3, "http://c.org", ""),
    (4, "http://d.org", "a < b and c > d <p>open <!-- never closed"),
    (5, "http://e.org", "<head><title>lost</title><body><p>kept"),
    (5, "http://e.org", "<head><title>lost</title><body><p>kept"),
    (6, "http://[bad", "<a href='http://[also'>x</a>" + "<p>long</p>" * 5000),
]


class Reader(HTMLParser):
    def __init__(self):
        super().__init__()
        self.parts, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in warc.HIDDEN
        if tag in warc.BREAKS | warc.HIDDEN:
            self.parts.append("\n")

    def handle_endtag(self, tag):
        self.hidden -= tag in warc.HIDDEN
        if tag in warc.BREAKS:
            self.parts.append("\n")

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def brute_text(page):
    reader = Reader()
    reader.feed(page)
    reader.close()
    lines = (" ".join(x.split()) for x in "".join(reader.parts).replace("\r", "\n").split("\n"))
    return "\n".join(x for x in lines if x)


def sha1(data):
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_records_are_linked(spark):
    df = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, block string")
    sources = {(r["key"], r["record_id"]): r for r in warc.responses(df).collect()}
    rows = warc.build(warc.responses(df)).collect()
    assert len(rows) == 2 * len(PAGES)
    for r in rows:
        source = sources[r["key"], r["refers_to"]]
        assert r["payload_digest"] == sha1(bytes(source["payload"])) and r["source_headers"] == source["headers"] and r["target_uri"] == source["target_uri"]
        assert r["block_digest"] == sha1(bytes(r["block"])) and r["content_length"] == len(r["block"])
        if r["warc_type"] == "metadata":
            facts = bytes(r["block"]).decode()
            twin = next(x for x in rows if x["warc_type"] == "conversion" and x["refers_to"] == r["refers_to"])
            assert f"conversion: {twin['record_id']}\r\n" in facts and f"conversion-digest: {twin['block_digest']}\r\n" in facts and "source-header: HTTP/1.1 200 OK\r\n" in facts
    text = {r["key"]: bytes(r["block"]).decode() for r in rows if r["warc_type"] == "conversion"}
    assert all(text[k] == brute_text(html) for k, _, html in PAGES if k in (0, 1, 6))
    assert text[2] == text[3] == "" and text[4] == "a < b and c > d\nopen" and text[5] == "kept"
    facts = {r["key"]: bytes(r["block"]).decode() for r in rows if r["warc_type"] == "metadata"}
    assert "title: T & t\r\nlanguage: de\r\n" in facts[0] and "outlink: http://a.org/x/y?z=1\r\n" in facts[0]
    ids = [r["record_id"] for r in rows]
    assert len(set(ids)) == len(ids) - 2  # the repeated page repeats its records
    assert warc.build(warc.responses(df.limit(0))).count() == 0


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    made = warc.build(warc.responses(df))
    warc.write(made, str(tmp_path / "warc"))
    data = b"".join(bytes(r["record"]) for r in spark.read.parquet(str(tmp_path / "warc")).collect())
    back = list(warc.parsed(data))
    assert sorted((h["warc-record-id"], b) for h, b in back) == sorted((r["record_id"], bytes(r["block"])) for r in made.collect())
    assert all(h["warc-block-digest"] == sha1(b) and h["warc-refers-to"] for h, b in back)
    assert warc.response_of(b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nx\r\n\r\ny") == ("HTTP/1.1 200 OK\r\nA: b", b"x\r\n\r\ny")


@pytest.mark.parametrize(("payload", "headers"), [("é".encode("latin-1"), "Content-Type: text/html; charset=iso-8859-1"), (b"<meta charset=latin-1>\xe9", ""), ("é".encode(), "charset=unknown")])
def test_charsets(payload, headers):
    assert warc.decoded(payload, headers).endswith("é")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<br/>", "<b>", "</b>", " x ", "y", "\n", "&amp;", "<!-- c -->", "<script>var a;</script>", "<a href='q'>", "</a>"]), max_size=20))
def test_text_is_the_parsers(parts):
    assert warc.page("".join(parts), "")[0] == brute_text("".join(parts))
