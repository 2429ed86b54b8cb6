"""Best-fit packing of token sequences, planned on a histogram of lengths.

Documents are encoded where they are read; those over the capacity are cut into pieces.
Only (document, piece, length, checksum) is written. How many pieces have each length is
all the planner sees: best fit in order of decreasing length, over groups of sequences
with the same room left, never over single pieces. Its work is bounded by the capacity,
whatever the corpus. The plan is a list of runs: pieces of one length, from one rank to
another, fill the next so many sequences from one offset on. Every piece has a rank
among those of its length, and takes the slot of the run that its rank falls in.

Ranks need no sort: a task numbers its own pieces of a length, and sums over the counts
of (length, task) tell where its numbers start. A length that holds a third of all
pieces is therefore counted in as many tasks as have read it.

Null texts are empty; an empty text is its closing id alone. Rows with equal or null ids
are documents of their own; equal texts are packed as often as they occur. A length that
equals the capacity fills a sequence. Other columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starsift.llm.bpe import _encoder, read_definition
from starsift.llm.common import by_bytes
from starsift.operators.skew import lookup_join
from starsift.sources.workspace import materialize, spread

# Fields of a run of the plan; see :func:`plan`.
RUN = ("length", "first", "last", "each", "sequence", "offset")


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, ...]]:
    """Runs (length, first, last, each, sequence, offset) of a best-fit decreasing packing.

    ``counts`` has how many pieces there are of each length. The pieces of a length with
    ranks from ``first`` up to but not ``last`` stand ``each`` to a sequence, from
    sequence number ``sequence`` and place ``offset`` on.
    """
    room: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []
    runs, opened = [], 0

    def put(left: int, start: int, many: int) -> None:
        if left and many:
            if left not in room:
                room[left] = []
                bisect.insort(rooms, left)
            held = room[left]
            if held and held[-1][0] + held[-1][1] == start:
                held[-1] = (held[-1][0], held[-1][1] + many)
            else:
                held.append((start, many))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                space = rooms[at]
                start, many = room[space].pop()
                if not room[space]:
                    del room[space]
                    rooms.pop(at)
            else:
                space, start = capacity, opened
                many = -(-left // (capacity // length))
                opened += many
            each = space // length
            full = min(many, left // each)
            if full:
                runs.append((length, rank, rank + full * each, each, start, capacity - space))
                rank, left = rank + full * each, left - full * each
            over = 0
            if full < many and left:
                runs.append((length, rank, rank + left, each, start + full, capacity - space))
                over, left = left, 0
            put(space - each * length, start, full)
            if over:
                put(space - over * length, start + full, 1)
            rest = full + bool(over)
            put(space, start + rest, many - rest)
    return runs


_PIECE = (
    "doc_id {kind}, piece int, start long, length long, ids_crc32 long, slot long, local long"
)


def _pieces(definition, capacity: int, closing: int):
    """Pieces of each document, numbered by length within the task."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(definition.value)
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        last = np.array([closing], "<u4").tobytes()
        step = capacity * 4
        for batch in by_bytes(batches, "text", 8 << 20):
            row, piece, size, crc = [], [], [], []
            for i, ids in enumerate(encoder.encode_texts(batch.column("text"))):
                ids += last
                for n, low in enumerate(range(0, len(ids), step)):
                    part = ids[low:low + step]
                    row.append(i)
                    piece.append(n)
                    size.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            length = np.array(size, np.int64)
            order = np.argsort(length, kind="stable")
            ordered = length[order]
            run = np.arange(len(ordered)) - np.searchsorted(ordered, ordered)
            local = np.empty(len(ordered), np.int64)
            local[order] = run + seen[ordered]
            seen += np.bincount(length, minlength=capacity + 1)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id").take(pa.array(row, pa.int64())),
                "piece": pa.array(piece, pa.int32()),
                "start": pa.array(np.array(piece, np.int64) * capacity),
                "length": pa.array(length),
                "ids_crc32": pa.array(crc, pa.int64()),
                "slot": pa.array(task * (capacity + 1) + length),
                "local": pa.array(local),
            })

    return cut


def _seated(planned):
    """The sequence and the offset of each (length, rank)."""

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, key, first, each, sequence, offset = planned.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(key, length * width + rank, side="right") - 1
            inside = rank - first[at]
            yield pa.RecordBatch.from_pydict({
                **{c: batch.column(c) for c in batch.schema.names if c != "rank"},
                "sequence_id": pa.array(sequence[at] + inside // each[at]),
                "offset": pa.array(offset[at] + inside % each[at] * length),
            })

    return seat


def pack_documents(
    docs: DataFrame, path: str, capacity: int = 4096, closing: int = 1
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row for each piece.

    A document is the ids of its text and then the id ``closing``. ``ids_crc32`` is over
    the ids of the piece as little-endian 32-bit numbers; sequences are numbered from 0
    and filled from offset 0 without gaps.
    """
    spark = docs.sparkSession
    definition = spark.sparkContext.broadcast(read_definition(path))
    rows = spread(docs.select("doc_id", "text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    pieces = materialize(
        rows.mapInArrow(_pieces(definition, capacity, closing), _PIECE.format(kind=kind)),
        "pieces",
    )
    counted = materialize(
        pieces.groupBy("slot").agg(F.first("length").alias("length"), F.count("*").alias("n")),
        "counted",
    )
    # One row for each length of at most ``capacity``.
    counts = {
        r["length"]: r["n"]
        for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()
    }
    runs = np.array(plan(counts, capacity), np.int64).reshape(-1, len(RUN))
    width = max(counts.values(), default=0) + 1
    if width * (capacity + 1) >= 1 << 63:
        raise ValueError("more pieces of a length than numbers for them")
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    length, first, _, each, sequence, offset = runs.T
    planned = spark.sparkContext.broadcast(
        (width, length * width + first, first, each, sequence, offset)
    )
    earlier = Window.partitionBy("length").orderBy("slot").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = materialize(
        counted.select("slot", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("begin")),
        "starts",
    )
    ranked = lookup_join(pieces, starts, "slot", "n").select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("begin") + F.col("local")).alias("rank"),
    )
    return ranked.mapInArrow(
        _seated(planned),
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long",
    )
