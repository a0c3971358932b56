"""WARC files: what is saved reads back, responses of a crawl become derivatives, and copies keep the source's digest."""

import gzip

from test_warc import PAGES, sha1

from askmine.llm import warc


def test_saved_files_read_back(spark, tmp_path):
    made = warc.build(warc.responses(spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3)))
    warc.save(made, str(tmp_path / "out"))
    files = list((tmp_path / "out").glob("*.warc"))
    assert files and not list((tmp_path / "out").glob("_*"))
    back = [(r["headers"], bytes(r["block"])) for r in warc.read(spark, str(tmp_path / "out")).collect()]
    expected = sorted((r["record_id"], r["refers_to"], r["payload_digest"], bytes(r["block"])) for r in made.collect())
    assert sorted((h["warc-record-id"], h["warc-refers-to"], h["warc-payload-digest"], b) for h, b in back) == expected
    data = b"".join(f.read_bytes() for f in files)
    assert sorted(b for _, b in warc.parsed(data)) == sorted(b for _, b in back)


def test_responses_of_a_crawl(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    record = lambda kind, i, block: warc.serialised(kind, f"<urn:uuid:{i}>", None, f"http://x.org/{i}", "2025-02-03T00:00:00Z", "application/http", block)
    pages = ["<p>one</p>", "", "<p>two\r\n\r\nthree"]
    data = record("warcinfo", 9, b"software: x") + b"".join(record("response", i, http + p.encode()) for i, p in enumerate(pages))
    with gzip.open(tmp_path / "crawl.warc.gz", "wb") as f:
        f.write(data)
    made = warc.build(warc.sources(warc.read(spark, str(tmp_path / "crawl.warc.gz")))).collect()
    text = {r["target_uri"]: bytes(r["block"]).decode() for r in made if r["warc_type"] == "conversion"}
    assert text == {"http://x.org/0": "one", "http://x.org/1": "", "http://x.org/2": "two\nthree"}
    assert all(r["payload_digest"] == sha1(pages[int(r["target_uri"][-1])].encode()) and r["date"] == "2025-02-03T00:00:00Z" and r["source_headers"].startswith("HTTP/1.1 200") for r in made)
    assert warc.build(warc.sources(warc.read(spark, str(tmp_path)).limit(0))).count() == 0
