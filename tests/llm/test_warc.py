from __future__ import annotations

import gzip
import io
import json
from html.parser import HTMLParser

from tidemark.llm.warc import WarcFiles, derivative_records, derive, digest, parse, plain_text, records, write

PAGE = (
    '<!DOCTYPE html><html lang="fr"><head><title>A &amp; B\n c</title><style>p{}</style>'
    '<script>var t="<p>x</p>";</script></head><body><p>Un <b>deux</b>&nbsp;trois<br>quatre'
    "<!-- <a href='/no'>no</a> --><ul><li><a href='/a?x=1&amp;y=2'>lien</a><li><a href=/b>b</a></ul>2 &lt; 3</body></html>"
)


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_text_and_links():
    assert plain_text(PAGE) == "A & B\nc\nUn deux trois\nquatre\nlien\nb\n2 < 3"
    assert plain_text("") == "" and plain_text("a < b <3 <") == "a < b <3 <"


def test_records_link_to_their_source(spark, tmp_path):
    folder = str(tmp_path / "w")
    files = write(pages(spark, [(4, "http://x.example/\r\nevil: 1", PAGE)]), folder, WarcFiles())
    path = files.first().path
    with gzip.open(path) as f:
        headers, block = parse(f.read())
    assert headers["WARC-Type"] == "response" and "evil" not in headers
    assert block.endswith(PAGE.encode()) and headers["WARC-Block-Digest"] == digest(block)
    rows = {r.kind: r for r in derive(spark.createDataFrame([(path,)], "path string"), WarcFiles()).collect()}
    for kind, r in rows.items():
        with open(r.path, "rb") as f:
            (own, body), = records(io.BytesIO(f.read()))
        assert own["WARC-Type"] == kind and own["WARC-Record-ID"] == r.record_id
        assert own["WARC-Refers-To"] == headers["WARC-Record-ID"] == r.refers_to
        assert own["WARC-Payload-Digest"] == headers["WARC-Payload-Digest"] == digest(PAGE.encode())
        assert own["WARC-Refers-To-Date"] == headers["WARC-Date"]
        assert own["WARC-Block-Digest"] == digest(body) and body.decode() == r.text
    about = json.loads(rows["metadata"].text)
    assert about["links"] == ["/a?x=1&y=2", "/b"] and about["title"] == "A & B c" and about["language"] == "fr"
    assert about["conversion"] == rows["conversion"].record_id
    assert about["source_headers"]["WARC-Record-ID"] == headers["WARC-Record-ID"]
    assert rows["conversion"].text == plain_text(PAGE)


def test_odd_rows_and_empty_table(spark):
    long = "<p>" + "mot " * 60_000
    rows = [(1, None, None), (2, "u", ""), (None, "u", PAGE), (3, "u", long), (3, "u", long), (4, "u", "<p \x00<b>>é"), (5, "u", "<script>")]
    table = pages(spark, rows).selectExpr("*", "1 AS path", "2 AS kind", "3 AS text")
    got = derivative_records(spark, table).collect()
    assert len(got) == 2 * len(rows)
    same = [r.record_id for r in got if r.page_id == 3 and r.kind == "conversion"]
    assert len(same) == 2 and len(set(same)) == 1
    assert {r.text for r in got if r.page_id in (1, 2, 5) and r.kind == "conversion"} == {""}
    assert derivative_records(spark, table.limit(0)).count() == 0


class Reader(HTMLParser):
    """Text, title, language and links of a page by a parser instead of patterns."""

    SILENT = {"script", "style", "template", "noscript", "svg"}
    BLOCKS = set(
        "br hr p div h1 h2 h3 h4 h5 h6 li ul ol tr td th table article section nav header footer aside main"
        " title blockquote pre".split()
    )

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.links, self.title, self.language, self.within = [], [], None, "", []

    def handle_starttag(self, tag, attrs):
        if tag in self.SILENT:
            self.within.append(tag)
        if self.within:
            return
        if tag in self.BLOCKS:
            self.out.append("\n")
        if tag == "title" and self.title is None:
            self.title = ""
            self.within_title = True
        if tag == "html" and not self.language:
            self.language = dict(attrs).get("lang") or ""
        if tag == "a" and dict(attrs).get("href") is not None:
            self.links.append(dict(attrs)["href"])

    def handle_endtag(self, tag):
        if self.within and tag == self.within[-1]:
            self.within.pop()
            self.out.append(" ")
        elif not self.within:
            if tag in self.BLOCKS:
                self.out.append("\n")
            if tag == "title":
                self.within_title = False

    def handle_comment(self, data):
        if not self.within:
            self.out.append(" ")

    within_title = False

    def handle_data(self, data):
        if not self.within:
            self.out.append(data)
            if self.within_title:
                self.title += data

    def text(self):
        lines = (" ".join(line.split()) for line in "".join(self.out).split("\n"))
        return "\n".join(line for line in lines if line)


def test_every_page_against_a_parser(spark):
    """All given pages: text, title, language and links as an HTML parser reads them."""
    table = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = {(r.page_id, r.kind): r for r in derivative_records(spark, table).collect()}
    given = table.collect()
    assert len(rows) == 2 * len(given) > 100
    for page in given:
        reader = Reader()
        reader.feed(page.html)
        reader.close()
        about = json.loads(rows[page.page_id, "metadata"].text)
        made = rows[page.page_id, "conversion"]
        assert made.text == reader.text(), page.page_id
        assert about["links"] == reader.links and about["language"] == reader.language
        assert about["title"] == " ".join((reader.title or "").split())
        assert made.target_uri == page.url and made.payload_digest == digest(page.html.encode())
        assert made.block_digest == digest(made.text.encode()) and about["payload_length"] == len(page.html.encode())
