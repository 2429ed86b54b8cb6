import base64
import gzip
import zlib
import hashlib
import random
from html.parser import HTMLParser

import pytest
import zstandard

from starsift.llm import warc


class Plain(HTMLParser):
    """Text of a page by the standard library's parser."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.skip = [], 0

    def handle_starttag(self, tag, attrs):
        if tag in warc.BREAKS:
            self.out.append("\n")
        if tag in ("script", "style", "title"):
            self.skip += 1

    def handle_endtag(self, tag):
        if tag in warc.BREAKS:
            self.out.append("\n")
        if tag in ("script", "style", "title") and self.skip:
            self.skip -= 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data.replace("\n", " "))


def by_parser(page):
    p = Plain()
    p.feed(page)
    p.close()
    lines = [" ".join(line.split()) for line in "".join(p.out).split("\n")]
    return "\n".join(line for line in lines if line)


def test_text_equals_the_standard_parser():
    pick = random.Random(1)
    bits = ["<p>", "</p>", "<br/>", "<b>", "</b>", "word", "two words", " ", "\n", "&amp;", "&eacute;", "&#233;", "1 < 2 ",
            "<!-- c <p> -->", "<a href='x>y'>", "</a>", "<script>var a='</p>';</script>", "<style>p{}</style>",
            '<img alt="a > b">', "<div class=x>", "</div>", "é", "<li>"]
    for _ in range(500):
        page = "".join(pick.choice(bits) for _ in range(pick.randrange(20)))
        assert warc.page_of(page)["text"] == by_parser(page), page


def test_odd_pages():
    assert warc.page_of("")["text"] == ""
    assert warc.page_of("a <b unfinished")["text"] == "a"
    assert warc.page_of("<script>never closed <p>x")["text"] == ""
    assert warc.page_of("<!-- open")["text"] == ""
    assert warc.page_of("a < b > c")["text"] == "a < b > c"
    page = warc.page_of("<html lang=fr><TITLE>A &amp;\n B</TITLE><a HREF=' /x '>l</a><img src=i.png>")
    assert page == {"title": "A & B", "language": "fr", "text": "l",
                    "links": [("/x", "a/@href"), ("i.png", "img/@src")]}
    for hard in ("<a " * 20000, '<a b="' * 20000, "<" * 50000, "<a b='x' " * 20000, "&" * 50000):
        warc.page_of(hard)


def test_messages():
    body = "<p>héllo".encode()
    packed = gzip.compress(body)
    chunked = b"%x\r\n%s\r\n0\r\n\r\n" % (len(packed), packed)
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Encoding: gzip\r\n"
             b"Transfer-Encoding: chunked\r\n\r\n") + chunked
    assert warc.message(block)[2] == body
    assert warc.message(b"no http")[2] == b"no http"
    assert warc.message(b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\nzz")[2] == b"zz"
    headers = {"WARC-Type": "response", "WARC-Record-ID": "<urn:uuid:1>", "WARC-Target-URI": "http://a/b/c",
               "WARC-Date": "2020-01-01T00:00:00Z", "WARC-IP-Address": "1.2.3.4"}
    (meta, facts), (text, plain) = warc.derive(headers, block)
    sent = "sha1:" + base64.b32encode(hashlib.sha1(chunked).digest()).decode()
    for h, b in ((meta, facts), (text, plain)):
        assert h["WARC-Refers-To"] == "<urn:uuid:1>" and h["WARC-IP-Address"] == "1.2.3.4"
        assert h["WARC-Source-Payload-Digest"] == sent and h["WARC-Date"] == headers["WARC-Date"]
        assert h["WARC-Block-Digest"] == warc.digest(b) and int(h["Content-Length"]) == len(b)
        assert warc.parsed(warc.serialised(h, b)) == (h, b)
    assert plain.decode() == "héllo" and meta["WARC-Record-ID"] != text["WARC-Record-ID"]
    assert b"source-header-content-encoding: gzip\r\n" in facts and b"source-status: HTTP/1.1 200 OK" in facts


def test_pages_and_files(spark, tmp_path):
    rows = [(1, "http://e/x", "<title>T</title><p>one<p>two <a href='y?q=1'>l</a>", 1), (2, None, None, 2),
            (3, "http://e/\r\nInjected: yes", "", 3), (1, "http://e/x", "<title>T</title><p>one<p>two <a href='y?q=1'>l</a>", 9),
            (None, "u", "x" * 300000, 4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, block int")
    records = warc.page_responses(pages)
    out = warc.record_table(records).collect()
    assert len(out) == 10
    ids = {r.headers["WARC-Record-ID"] for r in records.collect()}
    assert {r.refers_to for r in out} == ids and len(ids) == 4
    assert all(r.target_uri is None or "\n" not in r.target_uri for r in out)
    one = next(r for r in out if r.record_type == "conversion" and r.target_uri == "http://e/x")
    assert one.content == "one\ntwo l" and one.content_length == 9
    meta = next(r for r in out if r.record_type == "metadata" and r.target_uri == "http://e/x")
    assert "outlink: http://e/y?q=1 L a/@href\r\n" in meta.content and "title: T\r\n" in meta.content
    derived = warc.derived_records(records)
    warc.write_warc(derived, str(tmp_path / "w"))
    raw = b"".join(p.read_bytes() for p in sorted((tmp_path / "w").glob("part-*")))
    found = []
    while raw:
        headers, block = warc.parsed(raw)
        size = len(warc.serialised(headers, block))
        assert raw[:size] == warc.serialised(headers, block)
        found.append((headers["WARC-Record-ID"], block))
        raw = raw[size:]
    assert sorted(found) == sorted((r.headers["WARC-Record-ID"], bytes(r.block)) for r in derived.collect())
    assert warc.record_table(records.limit(0)).collect() == []
    other = spark.createDataFrame([({"WARC-Type": "request"}, bytearray(b"x")), (None, None)], warc.RECORD)
    assert warc.record_table(other).collect() == []


def _raw_deflate(body):
    packer = zlib.compressobj(wbits=-15)
    return packer.compress(body) + packer.flush()


BODY = b"<p>one</p>" * 50


@pytest.mark.parametrize("coding,payload,want,remark", [
    ("gzip", gzip.compress(BODY[:100]) + gzip.compress(BODY[100:]), BODY, ""),
    ("gzip", gzip.compress(BODY) + b"junk", BODY, ""),
    ("deflate", zlib.compress(BODY), BODY, ""),
    ("deflate", _raw_deflate(BODY), BODY, ""),
    ("zstd", zstandard.compress(BODY), BODY, ""),
    ("gzip, identity", gzip.compress(BODY), BODY, ""),
    ("deflate, gzip", gzip.compress(zlib.compress(BODY)), BODY, ""),
    ("br", BODY, b"", "unknown coding br"),
    ("gzip", BODY, b"", "not in coding gzip"),
    ("gzip", b"", b"", ""),
    ("gzip", gzip.compress(BODY * 100), (BODY * 100)[:1000], "truncated to 1000 bytes"),
    ("zstd", zstandard.compress(BODY * 100), (BODY * 100)[:1000], "truncated to 1000 bytes"),
])
def test_codings(coding, payload, want, remark):
    block = b"HTTP/1.1 200 OK\r\nContent-Encoding: " + coding.encode() + b"\r\n\r\n" + payload
    assert warc.message(block, 1000)[2:] == (want, remark)
    facts = warc.derive({}, block)[0][1]
    assert (b"source-decoding: " in facts) == (remark[:3] in ("unk", "not"))
