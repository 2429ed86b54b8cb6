"""Derived WARC records: metadata and plain-text conversions of responses.

A record is a row of ``headers``, its named fields, and ``block``. Each response
record gives two: a metadata record of fields about it (status, content type, title,
language, links) and a conversion record of its text. Both refer to the response by
its identifier, carry its target, date and other source fields along, and name the
digest of its payload; each has a digest of its own block. Identifiers are a function
of the response's, so that a second run or a retried task gives the same records.

The text of a page leaves out markup, comments, scripts and styles; block elements
break lines, other white space is folded, entities are decoded. A tag that never ends
takes the rest of the page with it, as in a browser.

Payloads are taken out of their codings: chunked, gzip of any number of members, deflate
with or without its header, zstd, in the order of the list, up to ``BODY_LIMIT`` bytes. A
field ``source-decoding`` of the metadata tells of a coding that is not known, a payload
that is not in its coding, or a cut at the limit; of the first two there is no text.

A response without a block has an empty payload; one without an identifier gets one
from its target and payload, so repeated rows give equal records. Records of other
types are left out. Fields keep no line breaks: control characters are percent-encoded.
Columns other than ``headers`` and ``block`` (``page_id``, ``url`` and ``html`` of
pages) are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import html as entities
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urljoin

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.llm.common import sliced
from starsift.sources.workspace import spread

VERSION = b"WARC/1.1"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
_TAG = re.compile(r"""</?([a-zA-Z][^\s/>]*+)((?:[^>"'=]|=\s*+"[^"]*+"|=\s*+'[^']*+'|["'=])*+)>""")
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_CONTROL = re.compile(r"[\x00-\x1f\x7f]")
# Elements whose content is no markup, and those that break lines.
RAW = frozenset(["script", "style", "noscript", "iframe", "noembed", "noframes", "xmp"])
BREAKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li "
    "main menu nav ol option p pre section select summary table tbody td tfoot th thead "
    "title tr ul".split()
)
_CLOSERS = {name: re.compile(f"</{name}(?=[\\s/>])", re.IGNORECASE) for name in (*RAW, "title", "textarea")}
# Bytes that a payload is decoded to at most; a few kilobytes can stand for gigabytes.
BODY_LIMIT = 64 << 20
RECORD = "headers map<string,string>, block binary"


def digest(raw: bytes) -> str:
    """A labelled digest as WARC fields have it."""
    return "sha1:" + base64.b32encode(hashlib.sha1(raw).digest()).decode()


def record_id(*parts: str) -> str:
    """An identifier that is a function of its parts."""
    return f"<urn:uuid:{uuid.uuid5(_SPACE, ' '.join(parts))}>"


def _field(value: str) -> str:
    return _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", value)


def page_of(source: str) -> dict:
    """Title, language, links and text of an HTML page; one pass over it."""
    title, language, links, out, at, n = None, None, [], [], 0, len(source)
    while at < n:
        lt = source.find("<", at)
        if lt < 0:
            out.append(source[at:])
            break
        out.append(source[at:lt])
        after = source[lt + 1:lt + 2]
        if source.startswith("<!--", lt):
            end = source.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if after in ("!", "?"):
            end = source.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        closing = after == "/"
        letter = source[lt + 2:lt + 3] if closing else after
        if not (letter.isascii() and letter.isalpha()):
            out.append("<")
            at = lt + 1
            continue
        tag = _TAG.match(source, lt)
        if tag is None:
            break
        name, at = tag[1].lower(), tag.end()
        if name in BREAKS:
            out.append(None)
        if closing:
            continue
        if name in ("a", "area", "link", "img", "html"):
            found = {}
            for m in _ATTRIBUTE.finditer(tag[2]):
                value = m[2] if m[2] is not None else m[3] if m[3] is not None else m[4]
                found.setdefault(m[1].lower(), entities.unescape(value or ""))
            if name == "html":
                language = language or found.get("lang")
            else:
                key = "src" if name == "img" else "href"
                if found.get(key):
                    links.append((found[key].strip(), f"{name}/@{key}"))
        closer = _CLOSERS.get(name)
        if closer is not None:
            end = closer.search(source, at)
            inner = source[at:end.start() if end else n]
            at = end.start() if end else n
            if name == "title" and title is None:
                title = " ".join(entities.unescape(inner).split())
            elif name == "textarea":
                out.append(inner)
    lines = "".join(_folded(out)).split("\n")
    text = "\n".join(kept for kept in (" ".join(line.split()) for line in lines) if kept)
    return {"title": title, "language": language, "links": links, "text": text}


def _folded(parts: list[str | None]) -> Iterator[str]:
    """Decoded text between tags, its own line breaks as spaces; None breaks a line."""
    for part in parts:
        if part is None:
            yield "\n"
        else:
            yield entities.unescape(part).replace("\n", " ").replace("\r", " ")


def message(
    block: bytes, limit: int = BODY_LIMIT
) -> tuple[str, list[tuple[str, str]], bytes, str]:
    """Status line, fields, decoded payload and a remark on the decoding of a response.

    Codings are undone from the last one applied. The remark is empty, or says which coding
    is not known, that the payload is not in its coding (it is then empty), or that only
    the first ``limit`` bytes were decoded.
    """
    head, split, payload = block.partition(b"\r\n\r\n")
    if not split or not head.startswith(b"HTTP/"):
        return "", [], block, ""
    lines = head.decode("latin-1").split("\r\n")
    fields = [(k.strip(), v.strip()) for k, _, v in (line.partition(":") for line in lines[1:]) if k]

    def listed(name: str) -> list[str]:
        every = ",".join(v for k, v in fields if k.lower() == name).lower()
        return [c.strip() for c in every.split(",") if c.strip()]

    remark = ""
    for coding in [*reversed(listed("transfer-encoding")), *reversed(listed("content-encoding"))]:
        if coding == "chunked":
            payload = _unchunked(payload)
        elif coding != "identity" and payload:
            undo = _CODINGS.get(coding)
            if undo is None:
                return lines[0], fields, b"", f"unknown coding {coding}"
            try:
                payload, more = undo(payload, limit)
            except (zlib.error, zstandard.ZstdError):
                return lines[0], fields, b"", f"not in coding {coding}"
            if more:
                remark = f"truncated to {limit} bytes"
    return lines[0], fields, payload, remark


def _inflated(raw: bytes, bits: int, limit: int) -> tuple[bytes, bool]:
    """All members of a stream up to a limit, and whether there is more."""
    out, room = [], limit
    while raw:
        stream = zlib.decompressobj(bits)
        try:
            part = stream.decompress(raw, room)
        except zlib.error:
            if out:
                break  # what follows the last member is no member
            raise
        out.append(part)
        room -= len(part)
        raw = stream.unused_data
        if room <= 0:
            return b"".join(out), bool(raw) or not stream.eof
        if not stream.eof:
            break
    return b"".join(out), False


def _gunzipped(raw: bytes, limit: int) -> tuple[bytes, bool]:
    return _inflated(raw, 31, limit)


def _undeflated(raw: bytes, limit: int) -> tuple[bytes, bool]:
    """With the header that the standard asks for, or without, as many servers send it."""
    try:
        return _inflated(raw, 15, limit)
    except zlib.error:
        return _inflated(raw, -15, limit)


def _unzstd(raw: bytes, limit: int) -> tuple[bytes, bool]:
    reader = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True)
    body = reader.read(limit + 1)
    return body[:limit], len(body) > limit


_CODINGS = {
    "gzip": _gunzipped, "x-gzip": _gunzipped, "deflate": _undeflated, "zstd": _unzstd,
}


def _unchunked(raw: bytes) -> bytes:
    out, at = [], 0
    while True:
        end = raw.find(b"\r\n", at)
        if end < 0:
            return b"".join([*out, raw[at:]])
        try:
            size = int(raw[at:end].split(b";")[0], 16)
        except ValueError:
            return raw
        if size <= 0:
            return b"".join(out)
        out.append(raw[end + 2:end + 2 + size])
        at = end + 4 + size


def _decoded(payload: bytes, content_type: str) -> str:
    named = re.search(r"charset=[\"']?([\w.:-]+)", content_type, re.IGNORECASE)
    if named is None:
        inner = re.search(rb"<meta[^>]{0,200}charset=[\"']?([\w.:-]+)", payload[:4096], re.IGNORECASE)
        charset = inner[1].decode("ascii", "replace") if inner else "utf-8"
    else:
        charset = named[1]
    try:
        return payload.decode(charset, "replace")
    except LookupError:
        return payload.decode("utf-8", "replace")


def derive(headers: dict[str, str], block: bytes) -> list[tuple[dict[str, str], bytes]]:
    """The metadata and the conversion record of a response record."""
    low = {k.lower(): v for k, v in headers.items() if v is not None}
    status, fields, payload, remark = message(block)
    kind = next((v for k, v in fields if k.lower() == "content-type"), "")
    own_digest = low.get("warc-payload-digest") or digest(message_payload(block))
    target = low.get("warc-target-uri", "")
    source = low.get("warc-record-id") or record_id("response", target, own_digest)
    page = page_of(_decoded(payload, kind))
    common = {}
    for name in ("WARC-Target-URI", "WARC-Date", "WARC-IP-Address", "WARC-Warcinfo-ID"):
        if low.get(name.lower()):
            common[name] = _field(low[name.lower()])
    facts = [("source-status", status), ("source-payload-digest", own_digest),
             ("source-decoding", remark)]
    facts += [(f"source-header-{k.lower()}", v) for k, v in fields]
    facts += [("title", page["title"]), ("language", page["language"])]
    for link, where in page["links"]:
        try:
            link = urljoin(target, link)
        except ValueError:
            pass
        facts.append(("outlink", f"{link} L {where}"))
    made = "".join(f"{k}: {_field(v)}\r\n" for k, v in facts if v)
    out = []
    for type_, form, body in (
        ("metadata", "application/warc-fields", made.encode("utf-8", "replace")),
        ("conversion", "text/plain; charset=utf-8", page["text"].encode("utf-8", "replace")),
    ):
        named = {
            "WARC-Type": type_, "WARC-Record-ID": record_id(source, type_),
            "WARC-Refers-To": source, **common, "WARC-Source-Payload-Digest": own_digest,
            "WARC-Block-Digest": digest(body), "Content-Type": form,
            "Content-Length": str(len(body)),
        }
        out.append((named, body))
    return out


def message_payload(block: bytes) -> bytes:
    """The payload as it was sent, which is what payload digests are of."""
    head, split, payload = block.partition(b"\r\n\r\n")
    return payload if split and head.startswith(b"HTTP/") else block


def serialised(headers: dict[str, str], block: bytes) -> bytes:
    """A record as it stands in a WARC file."""
    lines = [VERSION, *[f"{k}: {v}".encode() for k, v in headers.items()]]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """The first record of a WARC file's bytes."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")[1:]
    headers = {k: v.strip() for k, _, v in (line.partition(":") for line in lines)}
    return headers, rest[: int(headers["Content-Length"])]


def page_responses(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """(page_id, headers, block): each page as the response record it would come from."""

    def respond(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            headers, blocks = [], []
            for number, url, html in zip(*(batch.column(c).to_pylist() for c in (
                    "page_id", "url", "html")), strict=True):
                body = (html or "").encode("utf-8")
                block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                         b"Content-Length: %d\r\n\r\n" % len(body)) + body
                own = digest(body)
                named = {
                    "WARC-Type": "response", "WARC-Date": date,
                    "WARC-Record-ID": record_id("page", str(number), url or "", own),
                    "WARC-Payload-Digest": own, "WARC-Block-Digest": digest(block),
                    "Content-Type": "application/http; msgtype=response",
                    "Content-Length": str(len(block)),
                }
                if url:
                    named["WARC-Target-URI"] = _field(url)
                headers.append(list(named.items()))
                blocks.append(block)
            yield pa.RecordBatch.from_pydict({
                "page_id": batch.column("page_id"),
                "headers": pa.array(headers, pa.map_(pa.string(), pa.string())),
                "block": pa.array(blocks, pa.binary()),
            })

    held = spread(pages.select("page_id", "url", "html"))
    kind = held.schema["page_id"].dataType.simpleString()
    return held.mapInArrow(respond, f"page_id {kind}, {RECORD}")


def derived_records(records: DataFrame) -> DataFrame:
    """(source_id, headers, block): two records for each response record; map-only."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            out = []
            for headers, block in zip(batch.column("headers").to_pylist(),
                                      batch.column("block").to_pylist(), strict=True):
                headers = dict(headers or [])
                low = {k.lower(): v for k, v in headers.items()}
                if low.get("warc-type") == "response":
                    out += derive(headers, block or b"")
            yield pa.RecordBatch.from_pydict({
                "source_id": pa.array([h["WARC-Refers-To"] for h, _ in out], pa.string()),
                "headers": pa.array([list(h.items()) for h, _ in out],
                                    pa.map_(pa.string(), pa.string())),
                "block": pa.array([b for _, b in out], pa.binary()),
            })

    return records.select("headers", "block").mapInArrow(build, f"source_id string, {RECORD}")


def record_table(records: DataFrame) -> DataFrame:
    """Derived records with their fields as columns and a digest of the serialised record."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            made = [
                hashlib.sha256(serialised(dict(h), b)).hexdigest()
                for h, b in zip(batch.column("headers").to_pylist(),
                                batch.column("block").to_pylist(), strict=True)
            ]
            yield batch.append_column("record_sha256", pa.array(made, pa.string()))

    held = derived_records(records).mapInArrow(
        digests, f"source_id string, {RECORD}, record_sha256 string"
    )
    named = {
        "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "refers_to": "WARC-Refers-To",
        "target_uri": "WARC-Target-URI", "record_date": "WARC-Date",
        "source_payload_digest": "WARC-Source-Payload-Digest",
        "block_digest": "WARC-Block-Digest", "content_type": "Content-Type",
    }
    return held.select(
        *[F.col("headers")[field].alias(column) for column, field in named.items()],
        F.col("headers")["Content-Length"].cast("long").alias("content_length"),
        F.col("block").cast("string").alias("content"), "record_sha256",
    )


def write_warc(records: DataFrame, path: str) -> None:
    """Records as WARC files, one for each task.

    For records whose blocks are text. The writer's line end is the last of the two
    that follow a record.
    """

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            made = [
                serialised(dict(h), b)[:-2].decode("utf-8", "replace")
                for h, b in zip(batch.column("headers").to_pylist(),
                                batch.column("block").to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_pydict({"value": pa.array(made, pa.string())})

    records.select("headers", "block").mapInArrow(lines, "value string").write.option(
        "lineSep", "\r\n"
    ).text(path)
