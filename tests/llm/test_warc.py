import base64
import gzip
import hashlib
import html.parser
import time

import pytest

from corpus import frame
from docstruct.llm import warc

PAGES = "page_id long, url string, html string, block string, warc_type string"
HTML = (
    "<!DOCTYPE html><html lang=en><head><title>A &amp; B\n  c</title><style>p{}</style></head><body><script>var t='</p>'</script><h1>Head</h1><!-- no -->"
    "<p>One <b>two</b>&nbsp;three &lt;x&gt;<br>four</p><ul><li><a href=\"/a?x=1&amp;y=2\">link</a><li><a href='/b'>other</a><a href=/b>again</a></ul></body></html>"
)
ROWS = [(1, "http://x/", HTML, "x", "y"), (2, None, None, None, None), (3, "http://y/", "", "x", "y"), (3, "http://y/", "", "x", "y"), (None, "http://z/", "plain < 3 & more <b", "x", "y"), (4, "http://é/", "<p>" + "word " * 100_000, "x", "y")]


def derived(spark):
    return warc.derivatives(warc.responses(frame(spark, ROWS, PAGES)), "_key", out="page_id")


def test_text_and_metadata():
    assert warc.plain_text(HTML) == "Head\nOne two three <x>\nfour\nlink\notheragain"
    lines = warc.metadata(HTML, "HTTP/1.1 200 OK\nContent-Type: text/html", "sha1:X").split("\r\n")
    assert lines == ["title: A & B c", "language: en", "source-header: HTTP/1.1 200 OK", "source-header: Content-Type: text/html", "source-payload-digest: sha1:X", "outlink: /a?x=1&y=2", "outlink: /b", ""]


def test_links_and_digests(spark):
    rows = derived(spark).collect()
    assert len(rows) == 2 * len(ROWS)
    by = {}
    for r in rows:
        by.setdefault((r["page_id"], r["target_uri"]), []).append(r)
        want = "sha1:" + base64.b32encode(hashlib.sha1(r["block"].encode()).digest()).decode()
        assert r["block_digest"] == r["payload_digest"] == want
    for pair in by.values():
        assert {r["warc_type"] for r in pair} == {"metadata", "conversion"}
    assert len({r["refers_to"] for r in rows}) == len(ROWS) and len({r["record_id"] for r in rows}) == len(rows)
    made = {r["record_id"] for r in warc.responses(frame(spark, ROWS, PAGES)).collect()}
    assert {r["refers_to"] for r in rows} == made
    assert sorted(map(str, rows)) == sorted(map(str, derived(spark).collect()))


def test_round_trip(spark):
    rows = [r.asDict() for r in derived(spark).collect()]
    parsed = list(warc.parse(b"".join(map(warc.serialize, rows))))
    assert len(parsed) == len(rows)
    for (head, block), r in zip(parsed, rows):
        assert block.decode() == r["block"]
        assert head["WARC-Type"] == r["warc_type"] and head["WARC-Record-ID"] == r["record_id"] and head["WARC-Refers-To"] == r["refers_to"]
        assert head["WARC-Block-Digest"] == r["block_digest"] and head["WARC-Refers-To-Target-URI"] == r["target_uri"] and head["WARC-Refers-To-Date"] == r["date"]


def test_empty(spark):
    assert warc.derivatives(warc.responses(frame(spark, [], PAGES)), "_key", out="page_id").count() == 0


def test_identifiers_are_uuids_of_the_content(spark):
    rows = warc.responses(frame(spark, [(1, "http://x/", "<p>a", "", ""), (None, "http://y/é", "b", "", "")], PAGES)).collect()
    for r in rows:
        key = "" if r["_key"] is None else r["_key"]
        assert r["record_id"] == warc.identifier("response", key, r["target_uri"], r["date"], hashlib.sha1(r["payload"].encode()).hexdigest())


def test_names_may_clash(spark):
    rows = frame(spark, [(1, "http://x/", "<title>t</title>b", "k", "w")], PAGES).selectExpr("page_id as block", "url", "html", "1 as _date", "2 as _key", "3 as _payload", "'4' as record_id", "'h: v' as headers")
    found = warc.derivatives(warc.responses(rows, "block", date="2024-01-02T03:04:05Z", headers=rows["headers"]), "_key", out="block").collect()
    assert {(r["block_"], r["date"], r["source_headers"]) for r in found} == {(1, "2024-01-02T03:04:05Z", "h: v")}
    own = frame(spark, [("<urn:x:1>", "u", "d", "h", "p")], warc.RESPONSE)
    assert {(r["record_id_"], r["refers_to"], r["date"]) for r in warc.derivatives(own).collect()} == {("<urn:x:1>", "<urn:x:1>", "d")}


class Reader(html.parser.HTMLParser):
    """Another way to the same: text, title, language and links by the standard library's parser."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.text, self.title, self.lang, self.links, self.silent, self.in_title = [], None, None, [], [], False
        self.feed(page)
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag in warc._BLOCKS:
            self.text.append("\n")
        if tag in ("script", "style", "noscript", "template", "head"):
            self.silent.append(tag)
        if tag == "html":
            self.lang = self.lang or dict(attrs).get("lang")
        if tag == "a" and dict(attrs).get("href") is not None:
            self.links.append(" ".join(dict(attrs)["href"].split()))
        self.in_title = tag == "title"
        if tag == "title" and self.title is None:
            self.title = ""

    def handle_endtag(self, tag):
        if tag in warc._BLOCKS:
            self.text.append("\n")
        if tag in self.silent:
            self.silent.remove(tag)
            self.text.append(" ")
        self.in_title = False

    def handle_data(self, data):
        if self.in_title:
            self.title += data
        elif not self.silent:
            self.text.append(data)

    def handle_comment(self, data):
        self.text.append(" ")

    def lines(self):
        return [x for x in (" ".join(x.split()) for x in "".join(self.text).split("\n")) if x]


def test_against_another_parser(spark):
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()] + [HTML]
    for page in pages:
        want = Reader(page)
        assert [" ".join(x.split()) for x in warc.plain_text(page).split("\n") if x] == want.lines()
        fields = [x.split(": ", 1) for x in warc.metadata(page, "", "d").split("\r\n")[:-1]]
        assert [v for k, v in fields if k == "title"] == [" ".join(want.title.split())]
        assert [v for k, v in fields if k == "language"] == ([want.lang] if want.lang else [])
        assert [v for k, v in fields if k == "outlink"] == list(dict.fromkeys(want.links))


@pytest.mark.parametrize("part", ["<html ", "<a ", "<a href=", "<!-", "<!--", "<script>", "<script ", "</script ", "<head>", "<title>", "<title", "<p", "<", "lang ", "<html lang =", "&", "<a href='", '<a href="x', "</title", "<style></"])
def test_pages_that_leave_all_open_take_linear_time(part):
    page = part * (1_000_000 // len(part))
    began = time.time()
    warc.plain_text(page)
    warc.metadata(page, "", "d")
    assert time.time() - began < 3


def test_text_at_the_end():
    assert warc.plain_text("a < b and <b>c</b> > d") == "a < b and c > d"
    assert warc.plain_text("plain < 3") == "plain < 3"
    assert warc.plain_text("one <!-- open") == "one" and warc.plain_text("one <script>x") == "one" and warc.plain_text("one <b") == "one"


def test_files_are_read(spark, tmp_path):
    def record(kind, number, block):
        head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:{number}>\r\nWARC-Target-URI: http://x/{number}\r\nWARC-Date: 2024-05-06T07:08:0{number}Z\r\nContent-Length: {len(block)}\r\n\r\n"
        return head.encode() + block + b"\r\n\r\n"

    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=iso-8859-1\r\n\r\n<title>é</title>".encode("latin-1")
    records = [record("warcinfo", 0, b"software: x\r\n"), record("response", 1, http), record("request", 2, b"GET / HTTP/1.1\r\n\r\n"), record("response", 3, b"HTTP/1.1 404 NO\r\n\r\n")]
    (tmp_path / "a.warc").write_bytes(b"".join(records))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (tmp_path / "c.warc").write_bytes(records[1] + b"broken\r\n\r\n")
    rows = warc.read(spark, f"{tmp_path}/*").collect()
    assert len([r for r in rows if r["error"]]) == 1 and len([r for r in rows if not r["error"]]) == 5
    one = next(r for r in rows if r["path"].endswith("b.warc.gz") and r["record_id"] == "<urn:uuid:1>")
    assert (one["target_uri"], one["date"], one["payload"]) == ("http://x/1", "2024-05-06T07:08:01Z", "<title>é</title>")
    found = warc.derivatives(warc.read(spark, f"{tmp_path}/b.warc.gz").where("error is null")).collect()
    assert {(r["refers_to"], r["date"]) for r in found} == {(f"<urn:uuid:{n}>", f"2024-05-06T07:08:0{n}Z") for n in (1, 3)}
    assert any("title: é" in r["block"] and "source-header: Content-Type: text/html; charset=iso-8859-1" in r["block"] for r in found)
