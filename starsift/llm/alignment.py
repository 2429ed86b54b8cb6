"""Alignment of the tokens of two tokenizers, and how often their ids are linked.

Tokenizer A is one of the ``tokenizers`` library at byte level, B a sentencepiece model.
Where tokens end is read from A's character offsets and from the spans of B's proto
(this release of the library has no immutable one; the spans are the same). Both are
coarse: a character that A splits has one offset for all its parts, and the spans of
byte-fallback tokens stand still until the last byte. The ends of such tokens are
refined with their decoded bytes. Ends that both sides share cut the tokens into groups,
and the tokens before each such end are linked.

A space after and before a character that is no white space starts a new token in both
tokenizers, so the text from one to the next is a unit whose alignment does not depend
on what stands around it. Equal units are aligned once, many in one call, and a worker
keeps frequent ones in two generations of bounded size. Long units are not kept.

Documents keep the distinct links that they hold with their counts. Sums over all
documents count each pair of ids, the largest count of each id of B decides which are its
best, and both join the documents again; frequent pairs are broadcast up to a checked
size, so the rows that hold them do not move.

A text that is null or empty, or that either side does not give back byte by byte (B
takes U+2581 for a space), has no tokens and no links: all numbers are 0 and its digest is
empty. Special tokens inside texts are plain text. Rows with equal or null ids are
documents of their own; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from starsift.llm.bpe import byte_letters, read_definition
from starsift.llm.common import by_bytes, text_batch
from starsift.operators.skew import lookup_join
from starsift.sources.workspace import materialize, spread

# Units that a process keeps in each of two generations, the longest of them, and how
# many are aligned in one call.
_UNITS, _LONGEST, _TOGETHER = 100_000, 64, 2000
# A pair of ids in one number: A's above these bits, B's below.
_BITS = 24

_AWKWARD = re.compile(r"^\s|\s\Z| \s|\s ")
_FALLBACK = re.compile(r"<0x([0-9A-F]{2})>")


def units_of(text: str) -> list[str]:
    """Units of a text, without the space before each, which the first one gets too."""
    parts = text.split(" ")
    if not _AWKWARD.search(text):
        return parts
    units, open_ = [], [parts[0]]
    for part in parts[1:]:
        before = open_[-1][-1:]
        if part and before and not part[0].isspace() and not before.isspace():
            units.append(" ".join(open_))
            open_ = []
        open_.append(part)
    units.append(" ".join(open_))
    return units


class Aligner:
    """Both tokenizers, and the alignments of units met before."""

    def __init__(self, definition: str, model: bytes):
        self.a = Tokenizer.from_str(definition)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_proto=model)
        rules = json.loads(definition)
        before = rules.get("pre_tokenizer") or {}
        if rules.get("normalizer") or before.get("type") != "ByteLevel" or not (
            before.get("use_regex") and not before.get("add_prefix_space")
        ) or rules["model"].get("dropout"):
            raise ValueError("tokenizer A is not a plain byte-level one")
        value = {c: b for b, c in enumerate(byte_letters())}
        names = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(names.values()) + 1)
        for name, number in names.items():
            known = all(c in value for c in name)
            self.bytes_a[number] = bytes(value[c] for c in name) if known else name.encode()
        self.bytes_b, self.fallback = [], []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            byte = self.b.is_byte(i) and _FALLBACK.fullmatch(piece)
            self.fallback.append(bool(byte))
            self.bytes_b.append(
                bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()
            )
            if not byte and "▁" in piece.lstrip("▁"):
                raise ValueError("pieces of tokenizer B join words over spaces")
        if max(len(self.bytes_a), len(self.bytes_b)) > 1 << _BITS:
            raise ValueError("too many ids")
        self.fallback = np.array(self.fallback)
        self.split = np.array([_splits(b) for b in self.bytes_a])
        self.len_a = np.array([len(b) for b in self.bytes_a])
        self.len_b = np.array([len(b) for b in self.bytes_b])
        self.known: dict[str, tuple | None] = {}
        self.old: dict[str, tuple | None] = {}

    def align(self, units: list[str]) -> list[tuple | None]:
        """(tokens of A, tokens of B, groups, links) of distinct units; None without tokens."""
        found, missed = [], []
        for i, unit in enumerate(units):
            held = self.known.get(unit, self)
            if held is self:
                held = self.old.get(unit, self)
                if held is self:
                    missed.append(i)
                elif len(unit) <= _LONGEST:
                    self.known[unit] = held
            found.append(held)
        # White space at the ends of a text's first or last unit would join that of others.
        alone = [i for i in missed if units[i] != units[i].strip()]
        rest = sorted(set(missed).difference(alone))
        parts = [rest[low:low + _TOGETHER] for low in range(0, len(rest), _TOGETHER)]
        for part in [*parts, *[[i] for i in alone]]:
            for i, held in zip(part, self._aligned([units[i] for i in part]), strict=True):
                found[i] = held
                if len(units[i]) <= _LONGEST:
                    self.known[units[i]] = held
        if len(self.known) >= _UNITS:
            self.old, self.known = self.known, {}
        return found

    def _ends(self, text: str, raw: bytes) -> tuple | None:
        """Ids and ends in bytes of both sides; None where the bytes are not the text's."""
        coded = self.a.encode(text, add_special_tokens=False)
        proto = self.b.encode(text[1:], out_type="proto")
        ids_a = np.array(coded.ids, np.int64)
        numbers, ends = [], []
        for piece in proto.pieces:
            numbers.append(piece.id)
            ends.append(piece.end)
        if b"".join([self.bytes_a[i] for i in ids_a.tolist()]) != raw:
            return None
        if b"".join([self.bytes_b[i] for i in numbers]) != raw:
            return None
        ids_b, ends_b = np.array(numbers, np.int64), np.array(ends, np.int64)
        ends_a = np.array([end for _, end in coded.offsets], np.int64)
        if len(raw) != len(text):
            points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
            wide = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
            ends_a = np.append(0, np.cumsum(wide))[ends_a]
        # B's spans leave out the space that it adds before the text.
        ends_b = ends_b + 1
        ends_a = np.where(self.split[ids_a], np.cumsum(self.len_a[ids_a]), ends_a)
        ends_b = np.where(self.fallback[ids_b], np.cumsum(self.len_b[ids_b]), ends_b)
        return ids_a, ends_a, ids_b, ends_b

    def _aligned(self, units: list[str]) -> list[tuple | None]:
        text = " " + " ".join(units)
        raw = text.encode("utf-8")
        read = self._ends(text, raw)
        if read is None:
            if len(units) == 1:
                return [None]
            half = len(units) // 2
            return self._aligned(units[:half]) + self._aligned(units[half:])
        ids_a, ends_a, ids_b, ends_b = read
        # Both rise; ends of one side may repeat.
        met = ends_a[np.minimum(np.searchsorted(ends_a, ends_b), len(ends_a) - 1)] == ends_b
        cuts = ends_b[met]
        cuts = cuts[np.diff(cuts, prepend=-1) > 0]
        at_a = np.searchsorted(ends_a, cuts, side="right")
        at_b = np.searchsorted(ends_b, cuts, side="right")
        links = ((ids_a[at_a - 1] << _BITS) | ids_b[at_b - 1]).astype("<i8")
        size = np.array([len(u) if u.isascii() else len(u.encode()) for u in units], np.int64)
        last = np.searchsorted(cuts, np.cumsum(size + 1), side="right")
        name_a, name_b = list(map(str, ids_a.tolist())), list(map(str, ids_b.tolist()))
        edges_a, edges_b = [0, *at_a.tolist()], [0, *at_b.tolist()]
        groups = [
            f"{name_a[a]}|{name_b[b]}" if c - a == 1 and d - b == 1
            else f"{','.join(name_a[a:c])}|{','.join(name_b[b:d])}"
            for (a, c), (b, d) in zip(pairwise(edges_a), pairwise(edges_b), strict=True)
        ]
        out = []
        for low, high in pairwise([0, *last.tolist()]):
            out.append((
                edges_a[high] - edges_a[low], edges_b[high] - edges_b[low],
                ";".join(groups[low:high]), links[low:high].tobytes(),
            ))
        return out


def _splits(raw: bytes) -> bool:
    """Whether bytes hold a part of a character."""
    try:
        raw.decode("utf-8")
    except UnicodeDecodeError:
        return True
    return False


_loaded: dict[bytes, Aligner] = {}


def _aligner(definition: str, model: bytes) -> Aligner:
    """The aligner of a task's process."""
    mark = hashlib.blake2b(definition.encode() + model, digest_size=16).digest()
    if mark not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _loaded[mark] = Aligner(definition, model)
    return _loaded[mark]


_ROW = (
    "key long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, pairs array<long>, times array<int>"
)


def _rows(shipped):
    """Counts, digest and distinct links of each document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*shipped.value)
        key = TaskContext.get().partitionId() << 40
        for batch in by_bytes(batches, "text"):
            flat, ends = [], [0]
            for text in text_batch(batch.column("text")):
                flat.extend(units_of(text) if text else ())
                ends.append(len(flat))
            coded = pa.array(flat, pa.string()).dictionary_encode()
            known = aligner.align(coded.dictionary.to_pylist())
            at = coded.indices.to_numpy()
            many = np.array([(k[0], k[1]) if k else (0, 0) for k in known], np.int64).reshape(-1, 2)
            lost = np.array([k is None for k in known], bool)
            names = [k[2] if k else "" for k in known]
            links = [k[3] if k else b"" for k in known]
            out = {c: [] for c in ("n_a", "n_b", "n", "digest", "pairs", "times")}
            for low, high in pairwise(ends):
                own = at[low:high]
                if low == high or lost[own].any():
                    row = (0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))
                else:
                    places = own.tolist()
                    told = ";".join([names[i] for i in places])
                    held = np.frombuffer(b"".join([links[i] for i in places]), "<i8")
                    n_a, n_b = many[own].sum(axis=0).tolist()
                    row = (n_a, n_b, len(held), hashlib.sha256(told.encode()).hexdigest(),
                           *np.unique(held, return_counts=True))
                for c, v in zip(out, row, strict=True):
                    out[c].append(v)
            rows = batch.num_rows
            starts = np.append(0, np.cumsum([len(p) for p in out["pairs"]])).astype(np.int32)
            yield pa.RecordBatch.from_pydict({
                "key": pa.array(np.arange(key, key + rows)),
                "doc_id": batch.column("doc_id"),
                "n_a": pa.array(out["n_a"], pa.int64()), "n_b": pa.array(out["n_b"], pa.int64()),
                "n_groups": pa.array(out["n"], pa.int64()),
                "n_links": pa.array(out["n"], pa.int64()),
                "groups_sha256": pa.array(out["digest"], pa.string()),
                "pairs": pa.ListArray.from_arrays(
                    starts, pa.array(np.concatenate(out["pairs"]), pa.int64())),
                "times": pa.ListArray.from_arrays(
                    starts, pa.array(np.concatenate(out["times"]), pa.int32())),
            })
            key += rows

    return read


def align_tokens(docs: DataFrame, path_a: str, path_b: str) -> tuple[DataFrame, DataFrame]:
    """Documents with what they share, and the counts of pairs of ids.

    The documents have (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256): A's and B's tokens, the groups and links between them, the links whose
    count over all documents is the highest of their id of B, ties included, the sum of
    those counts over the links, and the digest of the groups. The pairs have (id_a, id_b,
    n, best).
    """
    context = docs.sparkSession.sparkContext
    with open(path_b, "rb") as file:
        shipped = context.broadcast((read_definition(path_a), file.read()))
    rows = spread(docs.select("doc_id", "text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    read = materialize(rows.mapInArrow(_rows(shipped), _ROW.format(kind=kind)), "aligned")
    held = read.select("key", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "key", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times")
    )
    counted = materialize(
        held.groupBy("pair").agg(F.sum("times").alias("n")).withColumn(
            "id_b", F.col("pair").bitwiseAND(F.lit((1 << _BITS) - 1)).cast("int")
        ),
        "pairs",
    )
    # One row for each id of B.
    highest = counted.groupBy("id_b").agg(F.max("n").alias("most"))
    pairs = materialize(
        counted.join(F.broadcast(highest), "id_b").select(
            "pair", "id_b", "n", (F.col("n") == F.col("most")).cast("long").alias("best")
        ),
        "best",
    )
    told = pairs.select("pair", "n", "best")
    sums = lookup_join(held, told, "pair", "n").groupBy("key").agg(
        F.sum(F.col("times") * F.col("best")).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"),
    )
    out = read.join(sums, "key", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256",
    )
    return out, pairs.select(
        F.shiftright("pair", _BITS).cast("int").alias("id_a"), "id_b", "n",
        (F.col("best") == 1).alias("best"),
    )
