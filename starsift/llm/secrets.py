"""Secrets in texts, also under nested encodings.

A text is the first layer of a worklist. Each layer is scanned for secrets, then
unwrapped: percent escapes, Unicode escapes and numeric entities give one new layer
each for the whole text; each base64 run gives layers of its own, and so does a
percent-escaped compressed stream. A run is decoded from each of its first four
characters, for a path or name may stand before it, and as text, as a compressed
stream or, if it is neither, as Latin-1 and pairs of bytes. Runs at the ends of lines
are also joined with those that start the next lines. New layers join the list until
none is left. A layer that was seen before at the same place is left out; all decodings
but decompression shorten a layer, and ``max_depth`` nested decompressions end streams
that unpack to themselves.

Each character of a layer knows the code points of the text it came from, so a span
found in any layer is one of the text. Everything in a compressed stream maps to the
whole of it. Streams are unpacked and scanned piece by piece, whatever their size.
Pieces end between encoded runs, up to runs of ``_CARRIED`` bytes; other secrets are
found across pieces if they are no longer than ``_OVERLAP``.

Null texts are empty and have no spans. Rows with equal or null ids are rows of their
own. Columns other than ``doc_id`` and ``text`` are ignored, or kept by
:func:`redacted`.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.llm.common import sliced, text_batch
from starsift.sources.workspace import spread

# The kinds in their order and what they look like.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LEAST = (6, 20, 24)
WORDS = ("passw", "secret", "token", "api")

_PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(
    r"\\u([dD][89abAB][0-9A-Fa-f]{2})\\u([dD][c-fC-F][0-9A-Fa-f]{2})|\\u([0-9A-Fa-f]{4})"
    r"|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#([0-9]{1,7});|&#[xX]([0-9A-Fa-f]{1,6});"
)


def _marks(alphabet: bytes) -> bytes:
    return bytes(1 if c in alphabet else 0 for c in range(256))


_HEX = _marks(b"0123456789abcdef")
_BASE64 = _marks(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-")
_UNREADABLE = bytes(range(9)) + b"\x0b\x0c" + bytes(range(14, 32)) + b"\x7f"
_MIN_BASE64 = 16
_WRAPPED = re.compile(
    r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+"
    r"(?:[ \t]*+(?:\r?\n|(?:\\r)?\\n)[ \t]*+[A-Za-z0-9+/_-]{16,}+)*+"
    r"(?:[ \t]*+(?:\r?\n|(?:\\r)?\\n)[ \t]*+[A-Za-z0-9+/_-]{1,15}(?![A-Za-z0-9+/_-]))?+"
)
_BREAK = re.compile(r"[ \t]*(?:\r?\n|(?:\\r)?\\n)[ \t]*")
# Bytes of encoded runs, also of those over line breaks.
_JOINED = _marks(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=%\\&#;\r\n"
)
_PIECE = 1 << 20
_ZLIB = type(zlib.decompressobj())
_OVERLAP = 1 << 12
_CARRIED = 1 << 26


def _runs(ascii_: bytes, marks: bytes, least: int) -> Iterator[tuple[int, int]]:
    """Maximal runs of at least ``least`` marked characters."""
    marked = ascii_.translate(marks)
    wanted = b"\x01" * least
    at = marked.find(wanted)
    while at >= 0:
        end = marked.find(b"\x00", at)
        end = len(marked) if end < 0 else end
        yield at, end
        at = marked.find(wanted, end)


def scan(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the secrets that stand in a text as they are."""
    found = []
    lower = text.lower()
    if any(w in lower for w in WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
                  if m.end(2) - m.start(2) >= LEAST[0]]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= LEAST[1]]
    ascii_ = text.encode("ascii", "replace")
    found += [(s, 2, e) for s, e in _runs(ascii_, _HEX, LEAST[2])]
    return sorted(found)


class _Layer:
    """A text and where each of its characters came from.

    ``start`` and ``end`` are None in the first layer, arrays in others, or one number
    each when the whole layer came from one span.
    """

    __slots__ = ("end", "start", "text")

    def __init__(self, text: str, start=None, end=None):
        self.text, self.start, self.end = text, start, end

    def origin(self, a: int, b: int) -> tuple[int, int]:
        if self.start is None:
            return a, b
        if isinstance(self.start, int):
            return self.start, self.end
        return int(self.start[a]), int(self.end[b - 1])

    def origins(self, a: np.ndarray, b: np.ndarray) -> tuple:
        """Where spans a..b came from; each holds a character at least."""
        if self.start is None:
            return a, b
        if isinstance(self.start, int):
            return self.start, self.end
        return self.start[a], self.end[b - 1]


def _replaced(layer: _Layer, parts: list[tuple[int, int, str, list[int]]]) -> _Layer:
    """A layer with spans replaced: (start, end, characters, their lengths before)."""
    out, froms, tos, at = [], [], [], 0
    for start, end, chars, widths in parts:
        out += [layer.text[at:start], chars]
        plain = np.arange(at, start)
        edges = start + np.concatenate([[0], np.cumsum(widths)]).astype(np.int64)
        froms += [plain, edges[:-1]]
        tos += [plain + 1, edges[1:]]
        at = end
    rest = np.arange(at, len(layer.text))
    out.append(layer.text[at:])
    a, b = np.concatenate([*froms, rest]).astype(np.int64), np.concatenate([*tos, rest + 1])
    return _Layer("".join(out), *layer.origins(a, b.astype(np.int64)))


def _readable(raw: bytes) -> str | None:
    if raw.translate(None, _UNREADABLE) != raw:
        return None
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return None


def _decompressor(head: bytes):
    """A function that unpacks pieces of the stream that starts with ``head``, or None."""
    if head[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if head[:1] == b"\x78" and len(head) > 1 and (head[0] * 256 + head[1]) % 31 == 0:
        return zlib.decompressobj(15)
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if head[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    if head[:4] == b"\x28\xb5\x2f\xfd":
        return zstandard.ZstdDecompressor().decompressobj()
    return None


def _pieces(how, source: Iterator[bytes]) -> Iterator[bytes]:
    """What a stream unpacks to, in pieces; a broken stream ends where it breaks."""
    try:
        for raw in source:
            # Small steps bound what one of them can unpack to where no limit exists.
            for low in range(0, len(raw), 1 << 10):
                step = raw[low:low + (1 << 10)]
                if isinstance(how, (bz2.BZ2Decompressor, lzma.LZMADecompressor)):
                    while not how.eof:
                        piece = how.decompress(step, _PIECE)
                        step = b""
                        if piece:
                            yield piece
                        if how.needs_input or not piece:
                            break
                elif isinstance(how, _ZLIB):
                    while step:
                        yield how.decompress(step, _PIECE)
                        step = how.unconsumed_tail
                else:
                    yield how.decompress(step)
    except (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError, ValueError):
        return


def _unpacked(raw: bytes, max_depth: int) -> Iterator[bytes]:
    """Pieces of the innermost stream of ``raw``; empty if it is not compressed."""
    source, seen, depth = iter([raw]), set(), 0
    while depth <= max_depth and max_depth > 0:
        head = b""
        for piece in source:
            head += piece
            if len(head) >= 64:
                break
        mark = hashlib.blake2b(head, digest_size=16).digest()
        how = None if mark in seen else _decompressor(head)
        if how is None:
            if depth:
                yield head
                yield from source
            return
        seen.add(mark)
        source = _pieces(how, _chain(head, source))
        depth += 1


def _chain(head: bytes, rest: Iterator[bytes]) -> Iterator[bytes]:
    yield head
    yield from rest


def _texts(pieces: Iterator[bytes]) -> Iterator[str]:
    """Texts of about a piece each, each with the end of the one before it."""
    held, goal = b"", _PIECE + _OVERLAP
    for piece in pieces:
        held += piece
        while len(held) >= goal:
            cut = held.translate(_JOINED).rfind(b"\x00", _OVERLAP) + 1
            if not cut and len(held) < _CARRIED:
                goal = len(held) + _PIECE
                break
            cut = cut or len(held)
            yield _as_text(held[:cut])
            held, goal = held[cut - _OVERLAP:], _PIECE + _OVERLAP
    if held:
        yield _as_text(held)


def _as_text(raw: bytes) -> str:
    text = raw.decode("utf-8", "replace")
    return raw.decode("latin-1") if text.count("�") > len(text) // 4 else text


def _unescaped(layer: _Layer) -> _Layer | None:
    if "\\" not in layer.text and "&#" not in layer.text:
        return None
    parts = []
    for m in _ESCAPE.finditer(layer.text):
        high, low, four, eight, two, tens, hexes = m.groups()
        if high:
            code = 0x10000 + ((int(high, 16) & 0x3FF) << 10) + (int(low, 16) & 0x3FF)
        else:
            code = int(tens) if tens else int(four or eight or two or hexes, 16)
        good = code < 0x110000 and not 0xD800 <= code < 0xE000
        parts.append((m.start(), m.end(), chr(code) if good else "�", [m.end() - m.start()]))
    return _replaced(layer, parts) if parts else None


def _wrapped(text: str) -> Iterator[np.ndarray]:
    """Places of the characters of each base64 run that goes over line breaks."""
    if "\n" not in text and "\\n" not in text:
        return
    for m in _WRAPPED.finditer(text):
        breaks = [b.span() for b in _BREAK.finditer(text, m.start(), m.end())]
        if breaks:
            starts, ends = [m.start(), *(b for _, b in breaks)], [*(a for a, _ in breaks), m.end()]
            yield np.concatenate([np.arange(a, b) for a, b in zip(starts, ends, strict=True)])


def _decoded(layer: _Layer, places: np.ndarray, max_depth: int) -> Iterator[tuple[_Layer, bool]]:
    """The layers of a base64 run whose characters stand at ``places``."""
    text = layer.text
    end = int(places[-1]) + 1
    if len(places) == end - places[0]:
        whole = text[places[0]:end]
    else:
        whole = "".join([text[i] for i in places.tolist()])
    whole = whole.replace("-", "+").replace("_", "/")
    for skip in range(4):
        n = len(whole) - skip
        n -= n % 4 == 1
        if n < _MIN_BASE64 and skip:
            break
        at = places[skip:skip + n]
        raw = base64.b64decode(whole[skip:skip + n] + "=" * (-n % 4))

        def mapped(chars: str, to: np.ndarray, widths, at=at) -> tuple[_Layer, bool]:
            a, b = at[(to - widths) * 4 // 3], at[-(-to * 4 // 3) - 1] + 1
            return _Layer(chars, *layer.origins(a, b)), False

        inner = _readable(raw)
        if inner is not None:
            widths = np.fromiter((len(c.encode("utf-8")) for c in inner), np.int64, len(inner))
            yield mapped(inner, np.cumsum(widths), widths)
            continue
        last = end + min(len(text) - end, -n % 4)
        last = end + len(text[end:last]) - len(text[end:last].lstrip("="))
        for piece in _texts(_unpacked(raw, max_depth)):
            yield _Layer(piece, *layer.origin(int(at[0]), last)), True
        yield mapped(raw.decode("latin-1"), np.arange(1, len(raw) + 1), 1)
        for odd in (0, 1) if b"\x00" in raw else ():
            units = np.frombuffer(raw + b"\x00", "<u2", (len(raw) - odd + 1) // 2, odd)
            chars = "".join(["�" if 0xD800 <= u < 0xE000 else chr(u) for u in units.tolist()])
            to = odd + 2 * np.arange(1, len(units) + 1)
            yield mapped(chars, np.minimum(to, len(raw)), 2 - (to > len(raw)))


def _children(layer: _Layer, max_depth: int) -> Iterator[tuple[_Layer, bool]]:
    """The layers one step below a layer, and whether they were unpacked."""
    text = layer.text
    if "%" in text:
        parts = []
        for m in _PERCENT.finditer(text):
            raw = bytes.fromhex(m[0].replace("%", ""))
            for inner in _texts(_unpacked(raw, max_depth)):
                yield _Layer(inner, *layer.origin(m.start(), m.end())), True
            try:
                chars = raw.decode("utf-8")
                widths = [3 * len(c.encode("utf-8")) for c in chars]
            except UnicodeDecodeError:
                chars, widths = raw.decode("latin-1"), [3] * len(raw)
            parts.append((m.start(), m.end(), chars, widths))
        if parts:
            yield _replaced(layer, parts), False
    plain = _unescaped(layer)
    if plain is not None:
        yield plain, False
    for start, end in _runs(text.encode("ascii", "replace"), _BASE64, _MIN_BASE64):
        yield from _decoded(layer, np.arange(start, end), max_depth)
    for places in _wrapped(text):
        yield from _decoded(layer, places, max_depth)


def all_spans(text: str, max_depth: int = 32) -> tuple[list, list]:
    """(base, all): spans (start, kind, end) of the text itself, and of all its layers."""
    base = scan(text)
    found = set(base)
    seen = set()
    work = deque([(_Layer(text), 0)])
    first = True
    while work:
        layer, depth = work.popleft()
        if not first:
            for a, kind, b in scan(layer.text):
                start, end = layer.origin(a, b)
                found.add((start, kind, end))
        first = False
        for child, unpacked in _children(layer, max_depth - depth):
            if not child.text:
                continue
            mark = (
                hashlib.blake2b(child.text.encode("utf-8", "replace"), digest_size=16).digest(),
                child.origin(0, len(child.text)),
            )
            if mark not in seen:
                seen.add(mark)
                work.append((child, depth + unpacked))
    return base, sorted(found)


def _written(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def find_secrets(docs: DataFrame, max_depth: int = 32) -> DataFrame:
    """One row for each row of ``docs``: counts, digest and spans.

    (doc_id, n_assign, n_access, n_hex, base_sha256, spans): the counts and the digest
    are of the secrets that stand in the text itself, ``spans`` lists those of all
    layers as kind:start:end in code points, in order of start, then kind.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [all_spans(t, max_depth) for t in text_batch(batch.column("text"))]
            count = [[sum(k == n for _, k, _ in base) for base, _ in both] for n in range(3)]
            digests = [hashlib.sha256(_written(base).encode()).hexdigest() for base, _ in both]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "n_assign": pa.array(count[0], pa.int64()),
                "n_access": pa.array(count[1], pa.int64()),
                "n_hex": pa.array(count[2], pa.int64()),
                "base_sha256": pa.array(digests, pa.string()),
                "spans": pa.array([_written(every) for _, every in both], pa.string()),
            })

    held = spread(docs.select("doc_id", "text"))
    kind = held.schema["doc_id"].dataType.simpleString()
    return held.mapInArrow(
        found,
        f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string",
    )


def masked(text: str, mask: str = "[secret]", max_depth: int = 32) -> str:
    """The text with each stretch that spans of secrets cover replaced by ``mask``."""
    out, at, open_to = [], 0, -1
    for start, _, end in all_spans(text, max_depth)[1]:
        if start > open_to:
            if open_to >= 0:
                at = open_to
            out += [text[at:start], mask]
            open_to = end
        open_to = max(open_to, end)
    return "".join([*out, text[max(open_to, at):]]) if out else text


def redacted(docs: DataFrame, mask: str = "[secret]", max_depth: int = 32) -> DataFrame:
    """``docs`` with the secrets of all layers masked; null texts stay null.

    A column ``n_chars`` is brought up to date where there is one.
    """

    def masking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = [t and masked(t, mask, max_depth) for t in batch.column("text").to_pylist()]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "text", pa.array(texts, pa.string()))

    out = docs.mapInArrow(masking, docs.schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        size = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))
        out = out.withColumn("n_chars", size.cast(kind))
    return out
