import gzip
import html
import os
import time
from html.parser import HTMLParser

import pytest
from odd import SF_SMALL

from usagelens.llm import warc
from usagelens.llm.common import table


class Reader(HTMLParser):
    """Text and links by Python's own parser, for well-formed pages."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.links, self.skip = [], [], 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "head", "template", "noscript"):
            self.skip += 1
        if tag == "a" and dict(attrs).get("href") is not None:
            self.links.append(dict(attrs)["href"].strip())
        if tag in warc._BLOCKS:
            self.out.append("\n")

    def handle_endtag(self, tag):
        if tag in ("script", "style", "head", "template", "noscript"):
            self.skip -= 1
            self.out.append(" ")
        if tag in warc._BLOCKS:
            self.out.append("\n")

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data)

    def text(self):
        lines = (" ".join(x.replace("\xa0", " ").split()) for x in "".join(self.out).split("\n"))
        return "\n".join(x for x in lines if x)


def read(page):
    r = Reader()
    r.feed(page)
    r.close()
    return r.text(), r.links


PAGE = """<!DOCTYPE html><html lang="de-AT"><head><title>A &amp; B</title><style>p{}</style></head><body class="x">
<!-- not <a href="no">this</a> --><h1>Top</h1><p>One <b>two</b> <a HREF='/x?a=1&amp;b=2'>three</a><a name=q>no</a>
<a class="k" href=/plain>bare</a><script>var a = "<p>no</p>";</script>end&nbsp;&lt;p&gt;<br/>last</p></body></html>"""


def test_text_and_links_equal_pythons_parser():
    text, links = read(PAGE)
    assert warc.plain_text(PAGE) == text and links == ["/x?a=1&b=2", "/plain"]
    assert warc.outlinks(PAGE.replace('<a href="no">this</a>', "")) == links
    assert warc.title_of(PAGE) == "A & B" and warc.language_of(PAGE) == "de-AT"


def test_given_pages_equal_pythons_parser(spark):
    pages = [r.html for r in table(spark, SF_SMALL, "pages").collect()]
    same = 0
    for page in pages:
        text, links = read(page or "")
        same += warc.plain_text(page or "") == text and warc.outlinks(page or "") == links
    assert same >= 0.95 * len(pages), (same, len(pages))


def test_broken_markup():
    for page, text, links in [("", "", []), ("a < b > c", "a < b > c", []), ("x<a href=", "x", []), ("x<a href='y", "x", ["'y"]),
                              ('<a href="p>q">z', 'q">z', ["p>q"]), ("<script>x", "", []), ("<script x", "", []), ("a<!-- b", "a", []),
                              ("<a <a href=k>t", "t", ["k"]), ("<a href=>t<a href=u>", "t", ["u"]), ("</p>x</div >y", "x\ny", [])]:
        assert (warc.plain_text(page), warc.outlinks(page)) == (text, links), page
    assert warc.title_of("<title>x") == "x" and warc.title_of("<title") == "" and warc.language_of("<html lang=fr") == "fr"


@pytest.mark.parametrize("part", ["<a ", "<script ", "<p ", "<a href", '<a href="', "<a href='x", "<title ", "<html lang", "<!--", "<head>", "<", "</script ",
                                  "<style>", "&amp", "<a href= ", "<title>", "</title "])
def test_a_megabyte_of_anything_is_read_at_once(part):
    page = part * (1_000_000 // len(part))
    start = time.time()
    warc.plain_text(page), warc.outlinks(page), warc.title_of(page), warc.language_of(page)
    assert time.time() - start < 4


def test_files_hold_the_records_and_read_back(spark, tmp_path):
    records = warc.responses(table(spark, SF_SMALL, "pages"))
    odd = spark.createDataFrame([(1, warc.response(1, "u", "\r\n\r\n<p>x\r\n\r\n")), (2, None), (3, warc.record([("WARC-Type", "response")], b"\xff\x00\xfe"))],
                                warc.RESPONSES)
    records = records.unionByName(odd)
    want = sorted(bytes(r.record) for r in records.collect() if r.record is not None)
    warc.write_warc(records, f"{tmp_path}/plain")
    names = [f for f in os.listdir(f"{tmp_path}/plain") if f.startswith("part-")]
    data = [open(f"{tmp_path}/plain/{f}", "rb").read() for f in names]
    assert sorted(x for d in data for x in warc.split_records(d)) == want
    assert sorted(bytes(r.record) for r in warc.read_warc(spark, f"{tmp_path}/plain/part-*").collect()) == want
    os.mkdir(f"{tmp_path}/gz")
    with open(f"{tmp_path}/gz/a.warc.gz", "wb") as f:
        f.write(b"".join(gzip.compress(x) for x in want))
    back = warc.read_warc(spark, f"{tmp_path}/gz")
    assert sorted(bytes(r.record) for r in back.collect()) == want
    kinds = {r.kind: r["count"] for r in warc.derive(back).groupBy("kind").count().collect()}
    assert kinds["metadata"] == kinds["conversion"] == len(want)
    assert list(warc.split_records(b"\x1f\x8bbroken")) == [b"\x1f\x8bbroken"] and list(warc.split_records(b"junk")) == [b"junk"]


def test_headers_are_those_of_the_kind():
    meta, conversion = warc.derive_record(warc.response(5, "http://h/p", PAGE))
    for r in (meta, conversion):
        headers, block = warc.parse_record(r["record"])
        assert headers["warc-refers-to"] == r["refers_to"] and headers["warc-target-uri"] == "http://h/p"
        assert not {"warc-concurrent-to", "warc-refers-to-target-uri", "warc-refers-to-date"} & set(headers)
        assert headers["warc-block-digest"] == warc.digest(block) and headers["x-source-payload-digest"] == warc.digest(PAGE.encode())
    assert warc.parse_record(conversion["record"])[0]["x-metadata-record"] == meta["record_id"]
    assert html.unescape("outlink: /x?a=1&b=2") in meta["body"]
