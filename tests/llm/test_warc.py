from __future__ import annotations

import re
from html.parser import HTMLParser

from viewlog.llm import warc as W

PAGES = [
    (1, "http://a.example/1", "<html lang='de'><head><title>T &amp; x</title><style>p{}</style><script>var t='</p>';</script></head>"
     "<body><!-- no --><p>One <b>two</b>&nbsp;three</p><p>4 &lt; 5<br>six</p><a href=\"/x?a=1&amp;b=2\">link</a></body></html>"),
    (2, None, None),
    (3, "http://a.example/3", ""),
    (4, "http://a.example/4\r\nWARC-Type: evil", "<p>line\r\n\r\nWARC/1.1\r\nWARC-Type: fake\r\n\r\n</p>"),
    (5, "u", "plain é日本 &#228; text " * 5000),
    (1, "http://a.example/1", "<p>again</p>"),
    (None, "v", "<script>never closed"),
]
SCHEMA = "page_id long, url string, html string, block string, head string"


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def test_records_link_and_survive_a_round_trip(spark, tmp_dir):
    records = W.derivatives(pages(spark))
    rows = records.collect()
    assert len(rows) == 2 * len(PAGES)
    assert len({r.record_id for r in rows}) == len(rows)
    W.write_warc(records.repartition(3), f"{tmp_dir}/warc")
    back = {r.record_id: r for r in W.read_warc(spark, f"{tmp_dir}/warc").collect()}
    assert len(back) == len(rows)
    for r in rows:
        b = back[r.record_id]
        assert (b.record_type, b.refers_to, b.block, b.block_digest) == (r.record_type, r.refers_to, r.block, r.block_digest)
        assert b.block_digest == W.digest(r.block.encode())
    by_source = {}
    for r in rows:
        by_source.setdefault(r.refers_to, set()).add(r.record_type)
    assert all(kinds == {"metadata", "conversion"} for kinds in by_source.values())
    assert sorted(map(repr, W.derivatives(pages(spark)).collect())) == sorted(map(repr, rows))


def test_text_and_facts(spark):
    found = {(r.page_id, r.record_type): r.block for r in W.derivatives(pages(spark, PAGES[:5])).collect()}
    assert found[1, "conversion"] == "T & x\nOne two three\n4 < 5\nsix\nlink"
    assert "title: T & x\r\nlanguage: de\r\n" in found[1, "metadata"]
    assert "outlink: /x?a=1&b=2\r\n" in found[1, "metadata"] and "http-header: Content-Type: text/html\r\n" in found[1, "metadata"]
    assert found[2, "conversion"] == "" and found[3, "conversion"] == ""


def test_text_against_an_html_parser(spark):
    """On the test pages: the words a real HTML parser finds outside script and style."""
    class Words(HTMLParser):
        def __init__(self):
            super().__init__()
            self.off, self.text = 0, []

        def handle_starttag(self, tag, attrs):
            self.off += tag in ("script", "style")

        def handle_endtag(self, tag):
            self.off -= tag in ("script", "style")

        def handle_data(self, data):
            if not self.off:
                self.text.append(data)

    for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        parser = Words()
        parser.feed(r.html)
        parser.close()
        assert re.sub(r"\s", "", "".join(parser.text)) == re.sub(r"\s", "", W.plain_text(r.html))


def test_response_records_keep_what_they_bring(spark, tmp_dir):
    """From a WARC file of responses, each its own gzip member, to derivatives and back."""
    import gzip
    import os

    own, want = [], {}
    for i, body in enumerate(["<title>One</title><p>a é b</p>", "", "<p>two\r\n\r\nparts</p>"]):
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Number: {i}"
        block = (http + "\r\n\r\n" + body).encode()
        rid, date, url = f"<urn:uuid:{i:08}-0000-4000-8000-000000000000>", f"2023-05-0{i + 1}T10:20:30Z", f"http://r.example/{i}"
        payload = W.digest(body.encode())
        head = W.record_head("response", [("WARC-Record-ID", rid), ("WARC-Date", date), ("WARC-Target-URI", url), ("WARC-Payload-Digest", payload),
                                          ("Content-Type", "application/http; msgtype=response")], block)
        own.append(gzip.compress(head.encode() + block + b"\r\n\r\n"))
        want[rid] = (date, url, payload, http, body)
    info = W.record_head("warcinfo", [("WARC-Record-ID", "<urn:uuid:info>")], b"software: x\r\n").encode() + b"software: x\r\n\r\n\r\n"
    os.makedirs(f"{tmp_dir}/source")
    with open(f"{tmp_dir}/source/a.warc.gz", "wb") as out:
        out.write(gzip.compress(info) + b"".join(own))

    made = W.from_responses(W.read_warc(spark, f"{tmp_dir}/source"))
    W.write_warc(made, f"{tmp_dir}/derived")
    back = W.read_warc(spark, f"{tmp_dir}/derived").collect()
    assert len(back) == 2 * len(want) and {r.refers_to for r in back} == set(want)
    heads = {(r.refers_to, r.record_type): r.head for r in made.collect()}
    for r in back:
        date, url, payload, http, body = want[r.refers_to]
        assert (r.warc_date, r.target_uri) == (date, url)
        if r.record_type == "conversion":
            assert f"WARC-Source-Payload-Digest: {payload}\r\n" in heads[r.refers_to, "conversion"] and r.block == W.plain_text(body)
        else:
            assert f"source-payload-digest: {payload}\r\n" in r.block
            assert all(f"http-header: {line}\r\n" in r.block for line in http.split("\r\n"))
        assert f"WARC-Refers-To-Date: {date}\r\n" in heads[r.refers_to, r.record_type]


def test_missing_fields_are_derived(spark):
    rows = pages(spark).selectExpr("*", "'' as rid", "cast(null as string) as day")
    made = W.derivatives(rows, record_id_col="rid", date_col="day")
    assert sorted(map(repr, made.collect())) == sorted(map(repr, W.derivatives(pages(spark)).collect()))


def test_empty(spark, tmp_dir):
    none = W.derivatives(pages(spark, []))
    assert none.collect() == []
