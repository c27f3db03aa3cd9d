from __future__ import annotations

import glob
import hashlib
import re

from lakeshore.llm import warc
from lakeshore.llm.common import fresh_path, table
from tests.conftest import SF_SMOKE


def parse(raw: bytes):
    """Records of a WARC file by their lengths, as any reader of the format takes them."""
    out = []
    while raw:
        head, _, rest = raw.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        assert lines[0] == "WARC/1.1"
        headers = dict(x.split(": ", 1) for x in lines[1:])
        n = int(headers["Content-Length"])
        assert rest[n : n + 4] == b"\r\n\r\n"
        out.append((headers, rest[:n]))
        raw = rest[n + 4 :]
    return out


def test_whole_pages_table(spark):
    pages = {r.page_id: r for r in table(spark, SF_SMOKE, "pages").collect()}
    got = warc.op6_warc_derivatives(spark, SF_SMOKE).collect()
    assert len(got) == 2 * len(pages)
    sources = {r.page_id: r.record_id for r in warc.responses(table(spark, SF_SMOKE, "pages")).collect()}
    for r in got:
        page = pages[r.page_id]
        assert r.refers_to == sources[r.page_id] and r.target_uri == page.url
        assert r.source_digest == "sha256:" + hashlib.sha256(page.html.encode()).hexdigest()
        assert r.block_digest == r.block_sha256
        if r.record_type == "conversion":
            text = warc.plain_text(page.html).encode()
            assert (r.n_bytes, r.block_digest) == (len(text), "sha256:" + hashlib.sha256(text).hexdigest())
    assert len({r.record_id for r in got}) == len(got)


def test_plain_text():
    page = "<head><title>T &amp; t</title><style>p{}</style></head><p>a<b>b</b> &lt;c&gt;</p><script>x</script>d <br>\r\n e<!-- f"
    assert warc.plain_text(page) == "ab <c>\nd\ne"
    assert warc.title_and_links(page + "<a class=x href='/q?a=1&amp;b'>") == ("T & t", ["/q?a=1&b"])


def test_heads_that_are_not_closed():
    for page, text in {
        "<html><head><title>T</title><body><p>Hello world</p></body></html>": "Hello world",
        "<html><head><title>T</title><meta charset=x><p>Hello</p> world": "Hello\nworld",
        "<HEAD><STYLE>p{}</STYLE><TITLE>T</TITLE><BODY class=a>Hello": "Hello",
        "<head><title>T<body><p>Hello": "Hello",
        "<title>T<p>Hello": "Hello",
        "<head><title>T</title><style>p{}</head><body>Hello<style>q{}</style>": "Hello",
        "<head><noscript><body>Hello": "Hello",
        "<head><script src=a /></head>Hello<script>b</script>": "Hello",
        "a<script>'<body>'</script>b<script>'</head>'</script>c": "a b c",
        "<head-banner>One</head-banner><p>two": "One\ntwo",
        "<style-x>One</style-x> <template-y>two</template-y> three": "One two three",
        "One<style": "One",
        "<head></head>" + "<style><body>x" * 50000: "x " * 49999 + "x",
    }.items():
        assert warc.plain_text(page) == text, page[:100]
    assert warc.title_and_links("<title-bar>a</title-bar><title>b</title>")[0] == "b"


def test_files_are_valid_and_odd_rows(spark):
    rows = [(1, "http://a/\r\nX: y", "<p>one</p>"), (None, None, None), (3, "", ""), (3, "", ""),
            (4, "u", "a\r\n\r\nWARC/1.1\r\nb &#13;&#10;&#13;&#10;WARC/1.1 " + "<p>é</p>" * 5000)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, headers string")
    path = fresh_path(spark, "warc-test")
    warc.write_warc(warc.derive(warc.responses(pages.repartition(2))), path)
    files = [open(f, "rb").read() for f in glob.glob(re.sub("^file:(//)?", "", path) + "/part-*")]
    records = [x for f in files for x in parse(f)]
    read = warc.read_warc(spark, path).collect()
    assert sorted(b.decode() for _, b in records) == sorted(r.block for r in read) and len(read) == 10
    assert sorted(h["WARC-Record-ID"] for h, _ in records) == sorted(r.headers["WARC-Record-ID"] for r in read)
    assert warc.derive(warc.responses(pages.limit(0))).count() == 0


PAGE = """<!doctype html><html><head><title>Caf&eacute;  menu</title><script>var a = "<p>no</p>";</script></head>
<body><h1>Menu</h1><ul><li>Tea &amp; cake</li><li>Soup <b>of the day</b></li></ul>
<!-- hidden --><p>See <a href="/more?x=1&amp;y=2">more</a>.</p></body></html>"""


def test_expectations_written_by_hand(spark):
    pages = spark.createDataFrame([(5, "http://cafe.test/", PAGE)], "page_id long, url string, html string")
    rows = {r.type: r for r in warc.derive(warc.responses(pages, date="2024-05-06T07:08:09Z")).collect()}
    assert rows["conversion"].block == "Menu\nTea & cake\nSoup of the day\nSee more."
    digest = hashlib.sha256(PAGE.encode()).hexdigest()
    length = len(PAGE.encode()) + len("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
    assert rows["metadata"].block == (
        "title: Café menu\nsource-warc-type: response\nsource-content-type: application/http;msgtype=response\n"
        f"source-warc-payload-digest: sha256:{digest}\nsource-content-length: {length}\noutlink: /more?x=1&y=2\n"
    )
    assert {r.date for r in rows.values()} == {"2024-05-06T07:08:09Z"}


def test_responses_read_from_files_derive_the_same(spark):
    rows = [(1, "http://a/", PAGE), (2, "", "a\r\n\r\nb<p>c"), (None, None, None), (4, "http://d/", "é" * 9000)]
    source = warc.responses(spark.createDataFrame(rows, "page_id long, url string, html string"))
    path = fresh_path(spark, "warc-test")
    warc.write_responses(source.repartition(2), path)
    for f in glob.glob(re.sub("^file:(//)?", "", path) + "/part-*"):
        for headers, block in parse(open(f, "rb").read()):
            assert headers["Content-Type"].startswith("application/http") and block.startswith(b"HTTP/1.1 200 OK\r\n")
    key = lambda r: (r.record_id, r.target_uri, str(r.page_id), r.type, r.block, sorted(r.source.items()))
    read = sorted(map(key, warc.derive(warc.read_responses(spark, path)).collect()))
    assert read == sorted(map(key, warc.derive(source).collect())) and len(read) == 8
