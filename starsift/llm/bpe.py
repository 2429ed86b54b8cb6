"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the bytes of a text cuts it into chunks where the content says so,
so a passage that many documents share gives the same chunks in each of them. A first
pass counts the digests of all chunks. Chunks seen once are encoded where they stand.
Of the others every distinct one is encoded once for the whole corpus, and its ids
join the documents that hold it.

Cuts fall anywhere, also within words, where the ids of two chunks do not simply
follow each other. Chunks are therefore encoded from their first white space to their
last, and what is left on both sides of a join is encoded anew. The window of a join
grows over chunks without white space until both its ends are at white space: ASCII
white space ends a word under every rule of these tokenizers (composition, case, split
pattern, special tokens), so beyond it both sides agree with an encoding of the whole
text, and the ids are exactly those of it.

Which chunks are shared reaches the tasks as a bit map of fixed size: a false hit only
sends a chunk the shared way. Null texts are empty and have no ids. Rows with equal or
null ids are rows of their own; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from starsift.functions.text import distinct
from starsift.llm.common import by_bytes, sliced
from starsift.operators.skew import lookup_join
from starsift.sources.workspace import materialize, spread

# Bits of the map of shared chunks; 16 MB whatever the corpus.
MAP_BITS = 1 << 27
# Bytes of a chunk: at least, about, and at most.
CHUNK = (256, 1024, 16384)
_WINDOW = 32
_SPACE = b" \t\n\r\x0b\x0c"
# Words, and pieces of words, that a process keeps in each of two generations; digests
# of chunks that a task remembers to have sent.
_WORDS, _PIECES, _SENT = 160_000, 120_000, 100_000

# Words of these characters need no library call but the model's own: the letters are
# composed, have simple lower case, and are told from digits and signs by sight.
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
# The split pattern of the tokenizer, for those characters and as written.
_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")
_SPLIT_SOURCE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# The other rules that a definition must have for words to be encoded alone.
_RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": _SPLIT_SOURCE}, "behavior": "Removed",
         "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True,
         "use_regex": False},
    ]},
    "post_processor": None,
}
_MODEL = {
    "type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None,
    "fuse_unk": False, "byte_fallback": False, "ignore_merges": False,
}


def byte_letters() -> list[str]:
    """Byte-level letters: printable bytes stand for themselves, others follow 255."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def check_definition(rules: dict) -> None:
    """Raise for a tokenizer whose rules are not known to keep words apart at white space."""
    added = rules.get("added_tokens") or []
    sound = all(rules.get(k) == v for k, v in _RULES.items()) and all(
        rules["model"].get(k) == v for k, v in _MODEL.items()
    ) and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
    if not sound:
        raise ValueError("the rules of this tokenizer may join words over white space")


class Encoder(dict):
    """Ids of words between ASCII white space, as little-endian 32-bit numbers.

    Words are looked up by their bytes. It holds two generations of at most ``_WORDS``
    words and ``_PIECES`` pieces, so frequent ones stay and memory is bounded. Plain
    words go to the library's model at once, all others through its whole encoder.
    """

    def __init__(self, definition: str):
        rules = json.loads(definition)
        check_definition(rules)
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.pieces: dict[str, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.old_pieces: dict[str, bytes] = {}
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self.names = [""] * (max(names.values()) + 1)
        for name, number in names.items():
            self.names[number] = name
        self.raw_ids = [struct.pack("<I", i) for i in range(len(self.names))]
        self.plain_decoder = rules.get("decoder") is None
        added = [str(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= _WORDS:
            self.old = dict(self)
            self.clear()
        ids = self.old.get(word)
        if ids is None:
            ids = self._word(word.decode("utf-8"))
        self[word] = ids
        return ids

    def _word(self, word: str) -> bytes:
        if word.isascii() and word.isalpha() and len(word) < 200:
            return self._piece(word.lower())
        if len(word) < 200 and _PLAIN.fullmatch(word) and not self.added.search(word):
            return b"".join([self._piece(p) for p in _SPLIT.findall(word.lower())])
        return _as_bytes(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = self.old_pieces.get(piece)
            if ids is None:
                letters = piece if piece.isascii() else "".join(
                    [self.letters[b] for b in piece.encode("utf-8")]
                )
                raw_ids = self.raw_ids
                ids = b"".join([raw_ids[t.id] for t in self.model.tokenize(letters)])
            if len(self.pieces) >= _PIECES:
                self.old_pieces, self.pieces = self.pieces, {}
            self.pieces[piece] = ids
        return ids

    def encode(self, raw: bytes) -> bytes:
        """Ids of whole words of UTF-8 text."""
        return b"".join([self[w] for w in raw.split()])

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a column of texts one after the other, and where those of each text start.

        The starts have one more entry than there are texts. Equal words of the column
        are looked up once.
        """
        words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.cast(pa.binary()).to_pylist()
        known = [i if i is not None else self[w]
                 for w, i in zip(distinct, map(self.get, distinct), strict=True)]
        held = np.frombuffer(b"".join(known), "<u4")
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        first = np.cumsum(sizes) - sizes
        at = coded.indices.to_numpy()
        many = sizes[at]
        ends = np.concatenate([[0], np.cumsum(many)])
        ids = held[np.repeat(first[at] - ends[:-1], many) + np.arange(ends[-1])]
        edges = words.offsets.to_numpy()
        return ids, ends[edges - edges[0]]

    def encode_texts(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text of a column."""
        ids, starts = self.encode_column(texts)
        raw, at = ids.tobytes(), (starts * 4).tolist()
        return [raw[low:high] for low, high in pairwise(at)]

    def decode(self, ids: bytes) -> str:
        """The text of ids, special tokens included."""
        numbers = np.frombuffer(ids, "<u4").tolist()
        if not self.plain_decoder:
            return self.tokenizer.decode(numbers, skip_special_tokens=False)
        names = self.names
        return " ".join([names[i] for i in numbers])


def _as_bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_loaded: dict[str, Encoder] = {}


def _encoder(definition: str) -> Encoder:
    """The encoder of a task's process; it keeps the words of tasks before."""
    mark = hashlib.blake2b(definition.encode(), digest_size=16).hexdigest()
    if mark not in _loaded:
        _loaded[mark] = Encoder(definition)
    return _loaded[mark]


_TOLD = {"n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}


def _digests(encoder: Encoder, ids: list[bytes]) -> dict[str, list]:
    """Columns that tell what the documents were encoded and are decoded to."""
    return {
        "n_tokens": [len(i) // 4 for i in ids],
        "ids_sha256": [hashlib.sha256(i).hexdigest() for i in ids],
        "decoded_sha256": [
            hashlib.sha256(encoder.decode(i).encode("utf-8")).hexdigest() for i in ids
        ],
    }


def _result(encoder: Encoder, docs: pa.Array, ids: list[bytes], digests: bool, keep: bool):
    """Rows (doc_id, digests if wanted, ids if kept) of encoded documents."""
    out = {"doc_id": docs}
    if digests:
        told = _digests(encoder, ids)
        out |= {c: pa.array(v, _TOLD[c]) for c, v in told.items()}
    if keep:
        out["ids"] = pa.array(ids, pa.binary())
    return pa.RecordBatch.from_pydict(out)


def _gear() -> np.ndarray:
    """A fixed random number for each byte."""
    return np.array(
        [int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=8).digest(), "little")
         for b in range(256)], np.uint64,
    )


_GEAR = _gear()


def chunk_ends(raw: bytes, sizes: tuple[int, int, int] = CHUNK, piece: int = 1 << 20) -> list[int]:
    """Where the chunks of a UTF-8 text end; never within a character."""
    least, about, most = sizes
    n = len(raw)
    if n <= least:
        return [n] if n else []
    data = np.frombuffer(raw, np.uint8)
    found = []
    for low in range(0, n, piece):
        first = max(0, low - _WINDOW)
        part = _GEAR[data[first:low + piece]]
        step = 1
        while step < _WINDOW:
            part[step:] = part[step:] + (part[:-step] << np.uint64(step))
            step *= 2
        hits = np.flatnonzero((part >> np.uint64(24)) % np.uint64(about - least or 1) == 0)
        hits = hits + first + 1
        found.append(hits[hits > low])
    cuts = np.concatenate(found)
    cuts = cuts[cuts < n]
    cuts = cuts[(data[cuts] & 0xC0) != 0x80]
    ends, last = [], 0
    for cut in [*cuts.tolist(), n]:
        if cut < n and cut - last < least:
            continue
        while cut - last > most:
            last += most
            while data[last] & 0xC0 == 0x80:
                last -= 1
            ends.append(last)
        if cut > last:
            ends.append(cut)
            last = cut
    return ends


def _shrunk(ids: bytes) -> bytes:
    """Ids for storage: 16 bits each where they fit, compressed."""
    values = np.frombuffer(ids, "<u4")
    narrow = not len(values) or int(values.max()) < 1 << 16
    body = values.astype("<u2").tobytes() if narrow else ids
    return bytes([narrow]) + zstandard.ZstdCompressor(level=1).compress(body)


def _grown(stored: bytes) -> bytes:
    """Ids as :func:`_shrunk` was given them."""
    body = zstandard.ZstdDecompressor().decompress(stored[1:])
    return np.frombuffer(body, "<u2").astype("<u4").tobytes() if stored[0] else body


def _digest(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=16).digest()


def _bit(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little") & (MAP_BITS - 1)


def _chunks(raw: bytes) -> Iterator[bytes]:
    at = 0
    for end in chunk_ends(raw):
        yield raw[at:end]
        at = end


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct chunk digests of each batch with their counts; equal texts of a batch count once."""
    for batch in by_bytes(batches, "text"):
        counts: dict[bytes, int] = {}
        texts, _ = distinct(batch.column("text"))
        for raw in texts.cast(pa.binary()).to_pylist():
            for chunk in _chunks(raw or b""):
                mark = _digest(chunk)
                counts[mark] = counts.get(mark, 0) + 1
        yield pa.RecordBatch.from_pydict({
            "digest": pa.array(list(counts), pa.binary()),
            "bit": pa.array([_bit(d) for d in counts], pa.int64()),
            "n": pa.array(list(counts.values()), pa.int64()),
        })


def _shared_bits(rows: DataFrame) -> bytes:
    """The map of bits of the digests that occur more than once."""
    counted = rows.select("text").mapInArrow(_counted, "digest binary, bit long, n long")
    shared = counted.groupBy("digest").agg(F.sum("n").alias("n"), F.first("bit").alias("bit"))
    pages = (
        shared.filter("n > 1")
        .groupBy(F.bitmap_bucket_number("bit").alias("page"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    )
    out = np.zeros(MAP_BITS // 8 + 8192, np.uint8)
    for row in pages.collect():
        bits = np.frombuffer(row["bits"], np.uint8)
        # Pages count from 1 for bits from 1 on; bit 0 is on page 0 by itself.
        at = row["page"] * len(bits)
        out[at:at + len(bits)] |= bits
    return out.tobytes()


def _bit_at(bit: int) -> tuple[int, int]:
    """Byte and mask of a bit, as Spark numbers the pages and places of its bit maps."""
    page = 1 + (bit - 1) // 32768 if bit > 0 else bit // 32768
    place = (bit - 1) % 32768 if bit > 0 else (-bit) % 32768
    return page * 4096 + place // 8, 1 << (place % 8)


def _edges(chunk: bytes) -> tuple[int, int]:
    """Where the first and the last white space of a chunk are; (-1, -1) without any."""
    ends = [p for p in (chunk.find(c) for c in (b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c")) if p >= 0]
    if not ends:
        return -1, -1
    return min(ends), max(chunk.rfind(c) for c in (b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c"))


_SEGMENTS = pa.list_(pa.struct([
    ("i", pa.int32()), ("digest", pa.binary()), ("solid", pa.bool_()),
    ("head", pa.binary()), ("ids", pa.binary()), ("tail", pa.binary()),
]))
_PASS = (
    "key long, doc_id {kind}, segments array<struct<i:int,digest:binary,"
    "solid:boolean,head:binary,ids:binary,tail:binary>>, digest binary, body binary, "
    "whole boolean, n_tokens long, ids_sha256 string, decoded_sha256 string, ids binary"
)


def _is_shared(bits: bytes, digest: bytes) -> bool:
    byte, mask = _bit_at(_bit(digest))
    return bool(bits[byte] & mask)


def _segment(encoder: Encoder, i: int, chunk: bytes, mark: bytes, hit: bool) -> dict:
    """A chunk between its white spaces: ids, or for a shared one its digest."""
    first, last = _edges(chunk)
    if first < 0:
        return {"i": i, "solid": True, "head": chunk}
    return {
        "i": i, "digest": mark if hit else None, "solid": False,
        "head": chunk[:first], "tail": chunk[last:],
        "ids": None if hit else _shrunk(encoder.encode(chunk[first:last])),
    }


def _passed(definition, bits, kind: pa.DataType, digests: bool, keep: bool):
    """Results of documents without shared chunks; segments of the others, and shared text.

    Ids of shared chunks are left out of the segments; their text goes out once a task.
    Equal texts of a batch are encoded once, and their chunks are not shared by that alone.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shared = _encoder(definition.value), bits.value
        key, sent = TaskContext.get().partitionId() << 40, set()
        for batch in by_bytes(batches, "text"):
            texts, place = distinct(pc.fill_null(batch.column("text"), ""))
            keys, docs, segments, alone = [], [], [], []
            bodies: dict[bytes, bytes] = {}
            split: dict[int, list[dict]] = {}
            for text, raw in enumerate(texts.cast(pa.binary()).to_pylist()):
                chunks = list(_chunks(raw))
                marks = [_digest(c) for c in chunks]
                hits = [_is_shared(shared, m) for m in marks]
                if not any(hits):
                    alone.append(text)
                    continue
                parts = [_segment(encoder, *x) for x in zip(range(len(chunks)), chunks, marks, hits,
                                                            strict=True)]
                split[text] = parts
                for part, chunk in zip(parts, chunks, strict=True):
                    mark = part.get("digest")
                    if mark is not None and mark not in sent:
                        if len(sent) >= _SENT:
                            sent.clear()
                        sent.add(mark)
                        bodies[mark] = chunk[len(part["head"]):len(chunk) - len(part["tail"])]
            # Every row has the result of its text.
            at = {text: i for i, text in enumerate(alone)}
            rows, known = [], []
            for row, text in enumerate(place.tolist()):
                if text in split:
                    keys.append(key + row)
                    docs.append(row)
                    segments.append(split[text])
                else:
                    rows.append(row)
                    known.append(at[text])
            key += batch.num_rows
            ids = batch.column("doc_id")
            whole = pa.array(rows, pa.int64())
            coded = encoder.encode_texts(texts.take(pa.array(alone, pa.int64())))
            many = len(docs) + len(bodies)
            empty = [None] * many
            out = {
                "key": pa.array([*keys, *[None] * (len(bodies) + len(rows))], pa.int64()),
                "doc_id": pa.concat_arrays([
                    ids.take(pa.array(docs, pa.int64())), pa.nulls(len(bodies), kind),
                    ids.take(whole),
                ]),
                "segments": pa.array([*segments, *[None] * (len(bodies) + len(rows))], _SEGMENTS),
                "digest": pa.array([*[None] * len(docs), *bodies, *[None] * len(rows)], pa.binary()),
                "body": pa.array(
                    [*[None] * len(docs), *bodies.values(), *[None] * len(rows)], pa.binary()),
                "whole": pa.array([False] * many + [True] * len(rows)),
            }
            told = _digests(encoder, coded) if digests else {c: [None] * len(coded) for c in _TOLD}
            for c, values in told.items():
                out[c] = pa.array(empty + [values[i] for i in known], _TOLD[c])
            stored = [_shrunk(i) for i in coded] if keep else [None] * len(coded)
            out["ids"] = pa.array(empty + [stored[i] for i in known], pa.binary())
            yield pa.RecordBatch.from_pydict(out)

    return encode


def _regrown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids as they were before :func:`_shrunk`."""
    for batch in sliced(batches):
        ids = pa.array([_grown(i) for i in batch.column("ids").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_pydict(
            {c: ids if c == "ids" else batch.column(c) for c in batch.schema.names}
        )


def _bodies(definition):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(definition.value)
        for batch in sliced(batches):
            ids = [_shrunk(encoder.encode(b)) for b in batch.column("body").to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "digest": batch.column("digest"), "ids": pa.array(ids, pa.binary()),
            })

    return encode


def _joined(encoder: Encoder, segments: list[dict], shared: dict[int, bytes]) -> bytes:
    """The ids of a document from those of its chunks, joins encoded anew."""
    out, window = [], b""
    for s in sorted(segments, key=lambda s: s["i"]):
        window += s["head"]
        if s["solid"]:
            continue
        out.append(encoder.encode(window))
        out.append(_grown(shared[s["i"]] if s["digest"] is not None else s["ids"]))
        window = s["tail"]
    out.append(encoder.encode(window))
    return b"".join(out)


def _finished(definition, digests: bool, keep: bool):
    """Results of documents whose shared chunks have met their ids."""

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(definition.value)
        for batch in sliced(batches):
            ids = []
            for segments, met in zip(batch.column("segments").to_pylist(),
                                     batch.column("met").to_pylist(), strict=True):
                ids.append(_joined(encoder, segments, {m["i"]: m["ids"] for m in met or []}))
            yield _result(encoder, batch.column("doc_id"), ids, digests, keep)

    return finish


def read_definition(path: str) -> str:
    """The JSON of a tokenizer, read where the job is started."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode_documents(
    docs: DataFrame, path: str, digests: bool = False, keep: bool = True
) -> DataFrame:
    """(doc_id, ids): the ids of each whole text, as little-endian 32-bit numbers.

    ``digests`` adds (n_tokens, ids_sha256, decoded_sha256) before the ids, ``keep`` tells
    whether those stay. Documents without shared chunks are finished in the pass that
    parts the others; of them only the result is written between passes.
    """
    spark = docs.sparkSession
    definition = spark.sparkContext.broadcast(read_definition(path))
    rows = spread(docs.select("doc_id", "text"))
    bits = spark.sparkContext.broadcast(_shared_bits(rows))
    doc_type = rows.schema["doc_id"].dataType
    kind = doc_type.simpleString()
    arrow = rows.limit(0).toArrow().schema.field("doc_id").type
    passed = materialize(
        rows.mapInArrow(
            _passed(definition, bits, arrow, digests, keep), _PASS.format(kind=kind)
        ),
        "parts",
    )
    bodies = passed.filter(F.col("body").isNotNull()).select("digest", "body")
    encoded = bodies.groupBy("digest").agg(F.first("body").alias("body")).mapInArrow(
        _bodies(definition), "digest binary, ids binary"
    )
    parts = passed.filter(F.col("segments").isNotNull()).select("key", "doc_id", "segments")
    wanted = parts.select("key", F.explode("segments").alias("s")).filter(
        F.col("s.digest").isNotNull()
    ).select("key", F.col("s.i").alias("i"), F.col("s.digest").alias("digest"))
    uses = wanted.groupBy("digest").agg(F.count("*").alias("uses"))
    table = materialize(encoded.join(uses, "digest"), "shared")
    met = lookup_join(wanted, table, "digest", "uses").groupBy("key").agg(
        F.collect_list(F.struct("i", "ids")).alias("met")
    )
    fields, names = [f"doc_id {kind}"], ["doc_id"]
    if digests:
        fields.append("n_tokens long, ids_sha256 string, decoded_sha256 string")
        names += _TOLD
    if keep:
        fields.append("ids binary")
        names.append("ids")
    schema = ", ".join(fields)
    finished = parts.join(met, "key", "left").mapInArrow(
        _finished(definition, digests, keep), schema
    )
    whole = passed.filter("whole").select(*names)
    return (whole.mapInArrow(_regrown, schema) if keep else whole).unionByName(finished)


def token_digests(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), one row for each row of ``docs``.

    ``ids_sha256`` is over the ids as little-endian 32-bit numbers, ``decoded_sha256``
    over the UTF-8 of the text that the ids decode to. ``with_ids`` adds the ids.
    """
    return encode_documents(docs, path, digests=True, keep=with_ids)
