"""SimHash near duplicates by segment popcounts.

A fingerprint has 64 bits; a bit is set if it is set in more than half of the hashes
of a text's word shingles. Cutting the fingerprint into 16 segments of four bits and
counting the set bits of each gives a point with 16 small coordinates. Changing one
bit moves the point by one, so the Manhattan distance of two points is a lower bound
of the number of differing bits. Two points at distance two or less share a cell of
the unit grid that is at most one step from either, so every fingerprint goes to its
33 cells or fewer, cells join independently, and the differing bits of what meets
there are counted exactly.

A cell of more than ``cell_limit`` fingerprints is not compared all with all. Its
fingerprints are cut into 64 segments of one bit, where a cell holds no more than 65
fingerprints and all of them are within two bits of each other. Equal fingerprints are
one class from the start. Cells return a spanning forest of their links.

An empty or null text has fingerprint zero and is linked like any other. A text of
fewer words than a shingle counts as one shingle. Rows with equal or null ids are rows
of their own; null ids name no component unless no other id is in it. Columns other
than ``doc_id`` and ``text`` are ignored, or kept by :func:`without_copies`.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starsift.llm.common import sliced, text_batch
from starsift.llm.groups import grouped
from starsift.operators.components import connected_components
from starsift.operators.skew import lookup_join
from starsift.sources.workspace import materialize, spread

SEED = 42
_AT_ONCE = 1 << 14
_ORDERED = 1 << 8


def _hashes(text: str, shingle: int) -> Iterator[np.ndarray]:
    """Hashes of a text's shingles, repeats included, some at a time."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    n = max(1, len(words) - shingle + 1)
    ends = (starts + lengths)[min(shingle, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    for low in range(0, n, _AT_ONCE):
        part = slice(low, low + _AT_ONCE)
        yield np.array(
            [digest(joined[s:e], SEED) for s, e in zip(starts[:n][part].tolist(),
                                                       ends[part].tolist(), strict=True)],
            np.uint64,
        )


def wording(text: str) -> bytes:
    """A digest of a text's words in order: what its shingles are made of."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    return xxhash.xxh3_128_digest(b" ".join(words))


def _set_bits(hashes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return bits.sum(axis=0, dtype=np.int64)


def _packed(set_bits: np.ndarray, n: int) -> int:
    return int.from_bytes(np.packbits(2 * set_bits > n).tobytes(), "big", signed=True)


def fingerprint(text: str, shingle: int = 3) -> int:
    """The 64-bit fingerprint of a text, as a signed number."""
    set_bits, n = np.zeros(64, np.int64), 0
    for hashes in _hashes(text, shingle):
        set_bits += _set_bits(hashes)
        n += len(hashes)
    return _packed(set_bits, n)


def _rehashed(hashes: np.ndarray, number: int) -> np.ndarray:
    """Another hash of the same shingles; number 0 is the hash itself."""
    if not number:
        return hashes
    x = hashes + np.uint64(number * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _factors(n: int) -> np.ndarray:
    """Odd factors, each of which puts hashes in an order of its own."""
    return _rehashed(np.arange(n, dtype=np.uint64), 1) | np.uint64(1)


def signature(
    text: str, shingle: int, prints: int, keep: int, bands: int = 0, rows: int = 6
) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Fingerprints of a text under several hashes, its ``keep`` smallest hashes, its bands.

    The hashes have 63 bits, so that they have one order as signed and unsigned numbers.
    A band is a digest of the first shingle in each of ``rows`` orders; a text without
    words has none.
    """
    set_bits, n = np.zeros((prints, 64), np.int64), 0
    least = np.zeros(0, np.uint64)
    factors = _factors(bands * rows)
    lowest = np.full(bands * rows, 2**64 - 1, np.uint64)
    for hashes in _hashes(text, shingle):
        for number in range(prints):
            set_bits[number] += _set_bits(_rehashed(hashes, number))
        short = _short(hashes, prints)
        least = np.unique(np.concatenate([least, short]))[:keep]
        for low in range(0, len(hashes) if bands else 0, _ORDERED):
            orders = factors[:, None] * hashes[None, low:low + _ORDERED]
            lowest = np.minimum(lowest, orders.min(axis=1))
        n += len(hashes)
    keys = np.arange(bands if n else 0, dtype=np.uint64)
    for row in lowest.reshape(bands, rows).T if n else ():
        keys = _rehashed(keys ^ row, 1)
    return [_packed(b, n) for b in set_bits], least.view(np.int64), keys.view(np.int64)


def _short(hashes: np.ndarray, number: int) -> np.ndarray:
    """Hashes of 63 bits, which have one order as signed and unsigned numbers."""
    return _rehashed(hashes, number) >> np.uint64(1)


def shingle_set(text: str, shingle: int, number: int) -> np.ndarray:
    """All distinct hashes of a text's shingles in order; :func:`signature` has the first."""
    parts = [np.unique(_short(h, number)) for h in _hashes(text, shingle)]
    held = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
    return held.view(np.int64)


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp), one row for each row of ``docs``."""
    held = spread(docs.select("doc_id", "text"))
    kind = held.schema["doc_id"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t, shingle) for t in text_batch(batch.column("text"))]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "fp": pa.array(prints, pa.int64()),
            })

    return held.mapInArrow(hashed, f"doc_id {kind}, fp long")


def segment_counts(fp: Column) -> Column:
    """Set bits of each of 16 segments of four bits, one in each hexadecimal digit.

    The halves are counted apart, which keeps every sum within a long.
    """

    def half(x: Column) -> Column:
        pairs = x.bitwiseAND(F.lit(0x55555555)) + F.shiftrightunsigned(x, 1).bitwiseAND(
            F.lit(0x55555555)
        )
        return pairs.bitwiseAND(F.lit(0x33333333)) + F.shiftrightunsigned(pairs, 2).bitwiseAND(
            F.lit(0x33333333)
        )

    high = half(F.shiftrightunsigned(fp, 32))
    return F.shiftleft(high, 32).bitwiseOR(half(fp.bitwiseAND(F.lit(0xFFFFFFFF))))


def grid_cells(point: Column, segments: int = 16) -> Column:
    """A point of :func:`segment_counts` and the points one step from it.

    ``point`` is read for each of them, so it should be a column, not the expression
    that counts the bits.
    """
    cells = [point]
    for segment in range(segments):
        one = F.lit(1 << (4 * segment))
        count = F.shiftrightunsigned(point, 4 * segment).bitwiseAND(F.lit(15))
        cells += [F.when(count < 4, point + one), F.when(count > 0, point - one)]
    return F.array_compact(F.array(*cells))


def bit_cells(fp: Column, width: int = 64) -> Column:
    """A fingerprint and those that differ from it by one bit."""
    bits = [1 << b if b < 63 else -(1 << 63) for b in range(width)]
    return F.array(fp, *[fp.bitwiseXOR(F.lit(b)) for b in bits])


def _met(limit: int, radius: int, with_cell: bool = False):
    """Links of the ids within each run of equal cells; runs over the limit come back.

    Rows (cell, fp, id) arrive sorted by cell. A row out is a link (a, b), or an id a
    with null b that the finer grid must take; ``with_cell`` adds the cell.
    """

    def table(a, b, cell) -> pa.RecordBatch:
        out = {"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())}
        if with_cell:
            out["cell"] = pa.array(np.full(len(a), cell), pa.int64())
        return pa.RecordBatch.from_pydict(out)

    def links(run: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        apart = np.bitwise_count((run[:, None] ^ run[None, :]).view(np.uint64))
        near, n = apart <= radius, len(run)
        root = np.arange(n, dtype=np.int32)
        while True:
            low = np.where(near, root[None, :], np.int32(n)).min(axis=1)
            low = low[low]
            if (low == root).all():
                break
            root = low
        tied = np.flatnonzero(root != np.arange(len(run)))
        return ids[tied], ids[root[tied]]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, prints, ids = (np.zeros(0, np.int64) for _ in range(3))
        crowded = None
        for batch in batches:
            cells, prints, ids = (
                np.concatenate([held, batch.column(c).to_numpy(zero_copy_only=False)])
                for held, c in ((cells, "cell"), (prints, "fp"), (ids, "id"))
            )
            yield from whole_runs(cells, prints, ids, crowded, False)
            last = int(np.searchsorted(cells, cells[-1])) if len(cells) else 0
            if len(cells) and (crowded == cells[-1] or len(cells) - last > limit):
                crowded = int(cells[-1])
                yield table(ids[last:], [None] * (len(cells) - last), crowded)
                last = len(cells)
            cells, prints, ids = cells[last:], prints[last:], ids[last:]
        yield from whole_runs(cells, prints, ids, crowded, True)

    def whole_runs(cells, prints, ids, crowded, ended) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]])) if len(
            cells) else np.zeros(0, np.int64)
        ends = np.concatenate([starts[1:], [len(cells)]]) if len(cells) else starts
        if not ended:
            starts, ends = starts[:-1], ends[:-1]
        for s, e in zip(*(x[(ends - starts > 1) | (cells[starts] == (
                crowded if crowded is not None else -1))].tolist() for x in (starts, ends)),
                strict=True):
            if crowded is not None and cells[s] == crowded or e - s > limit:
                yield table(ids[s:e], [None] * (e - s), cells[s])
                continue
            a, b = links(prints[s:e], ids[s:e])
            if len(a):
                yield table(a, b, cells[s])

    return meet


def _meet(cells: DataFrame, limit: int, radius: int, with_cell: bool = False) -> DataFrame:
    """Links within the cells of ``cells`` (cell, fp, id), which are dealt by cell.

    Without a column ``id`` a fingerprint is its own id.
    """
    columns = [c for c in ("cell", "fp", "id") if c in cells.columns]
    dealt = cells.sortWithinPartitions(*columns)
    if "id" not in columns:
        dealt = dealt.withColumn("id", F.col("fp"))
    kind = "a long, b long, cell long" if with_cell else "a long, b long"
    return dealt.mapInArrow(_met(limit, radius, with_cell), kind)


def _dealt_by_step(points: DataFrame) -> DataFrame:
    """(cell, fp): the cells of ``points`` (fp, point), dealt by cell.

    A fingerprint crosses the exchange with the step that leads from its point to the
    cell, mostly zero bytes; the cell follows from both on the other side. There are as
    many parts as the session shuffles to: merged by size, such narrow rows would come
    to parts of more rows.
    """
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    point, cell = F.col("point"), F.explode(grid_cells(F.col("point"))).alias("cell")
    steps = points.select("fp", "point", cell).select("fp", (F.col("cell") - point).alias("step"))
    there = segment_counts(F.col("fp")) + F.col("step")
    return steps.repartition(parts, there).select(there.alias("cell"), "fp")


def linked(prints: DataFrame, radius: int = 2, cell_limit: int = 512) -> DataFrame:
    """(a, b): links that connect all fingerprints within ``radius`` bits of each other.

    ``prints`` holds distinct fingerprints ``fp``. The links are those of a spanning
    forest of each cell, so two linked fingerprints are connected, not always tied.
    """
    if radius not in (0, 1, 2):
        raise ValueError("radius is 0, 1 or 2")
    fp = F.col("fp")

    points = prints.select("fp", segment_counts(fp).alias("point"))
    first = materialize(_meet(_dealt_by_step(points), cell_limit, radius), "links")
    crowded = first.filter(F.col("b").isNull()).select(F.col("a").alias("fp")).distinct()
    finer = crowded.select(F.explode(bit_cells(fp)).alias("cell"), "fp", fp.alias("id"))
    finer = _meet(finer.repartition("cell"), 65, radius)
    return first.filter(F.col("b").isNotNull()).unionByName(finer)


def near_documents(
    docs: DataFrame, shingle: int = 3, radius: int = 2, cell_limit: int = 512
) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row for each row of ``docs``.

    Documents link at ``radius`` or fewer differing bits; a component is named by the
    smallest id in reach.
    """
    prints = materialize(fingerprints(docs, shingle), "prints")
    table = _components(prints, radius, cell_limit)
    return lookup_join(prints, table, "fp", "copies").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _components(prints: DataFrame, radius: int, cell_limit: int) -> DataFrame:
    """(fp, copies, root, component_id) for the distinct fingerprints."""
    folded = materialize(
        prints.groupBy("fp").agg(F.min("doc_id").alias("key"), F.count("*").alias("copies")),
        "folded",
    )
    groups = grouped(folded.withColumnRenamed("fp", "id"),
                     linked(folded.select("fp"), radius, cell_limit))
    return materialize(
        folded.select("fp", "copies").join(groups.withColumnRenamed("id", "fp"), "fp"), "named"
    )


def half_cells(classes: DataFrame, cell_limit: int = 2048) -> DataFrame:
    """(id, bucket, b, n): groups of ids whose fingerprints have a half in common.

    ``classes`` has (id, prints). Each half of 32 bits is a fingerprint of its own with
    eight segments, apart from those of other numbers. Two ids with a half within two
    bits of each other are in one bucket at least, whatever ``cell_limit``: in a cell of
    the grid a bucket is what links of two bits connect there; in a crowded cell the
    finer grid takes over, where a cell is a bucket, for there all are within two bits.
    ``b`` is the lowest of a bucket and ``n`` > 1 its size.
    """
    halves = classes.select("id", F.posexplode("prints").alias("number", "fp")).select(
        "id",
        F.explode(F.array(
            F.struct((2 * F.col("number")).alias("table"),
                     F.shiftrightunsigned("fp", 32).alias("fp")),
            F.struct((2 * F.col("number") + 1).alias("table"),
                     F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)).alias("fp")),
        )).alias("h"),
    ).select("id", "h.table", "h.fp")
    fp, place = F.col("fp"), F.col("table").cast("long") * F.lit(1 << 33)
    points = halves.withColumn("point", segment_counts(fp))

    def cells(rows: DataFrame, found: Column) -> DataFrame:
        return rows.select((F.explode(found)).alias("cell"), "fp", "id", place.alias("place")).select(
            (F.col("cell") + F.col("place")).alias("cell"), "fp", "id"
        )

    spots = cells(points, grid_cells(F.col("point"), 8)).repartition("cell")
    first = materialize(_meet(spots, cell_limit, 2, True), "links")
    crowded = first.filter(F.col("b").isNull()).select(F.col("a").alias("id")).distinct()
    trees = first.filter("b is not null and a <> b")
    sizes = materialize(
        trees.groupBy(F.xxhash64("cell", "b").alias("bucket"), "b").agg(
            (F.count("*") + 1).alias("n")
        ),
        "trees",
    )
    members = trees.select(F.col("a").alias("id"), F.xxhash64("cell", "b").alias("bucket"))
    inside = lookup_join(members, sizes, "bucket", "n").unionByName(
        sizes.select(F.col("b").alias("id"), "bucket", "b", "n")
    )
    finer = cells(halves.join(crowded, "id"), bit_cells(fp, 32)).select(
        "id", F.col("cell").alias("bucket")
    )
    lowest = materialize(
        finer.groupBy("bucket").agg(F.min("id").alias("b"), F.count("*").alias("n")).filter("n > 1"),
        "crowded",
    )
    return materialize(
        inside.unionByName(lookup_join(finer, lowest, "bucket", "n")), "halves"
    )


def shared_bands(classes: DataFrame) -> DataFrame:
    """(id, bucket, b, n): the bands that ``n`` > 1 ids share, ``b`` the lowest of them.

    ``classes`` has (id, bands).
    """
    entries = materialize(classes.select("id", F.explode("bands").alias("bucket")), "entries")
    lowest = materialize(
        entries.groupBy("bucket").agg(F.min("id").alias("b"), F.count("*").alias("n"))
        .filter("n > 1"),
        "buckets",
    )
    return materialize(lookup_join(entries, lowest, "bucket", "n"), "shared")


def _shared(one: np.ndarray, flat: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """How many numbers of ``one`` each of ``n`` owners of the numbers ``flat`` has."""
    if not len(one) or not len(flat):
        return np.zeros(n, np.int64)
    at = np.minimum(np.searchsorted(one, flat), len(one) - 1)
    return np.bincount(owner[one[at] == flat], minlength=n)


def _runs(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple]:
    """(cell, ids, roots, arrays of ``column``) of each run of equal cells."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            held = batch.column(column)
            flat = held.values.to_numpy(zero_copy_only=False)
            ends = held.offsets.to_numpy()
            yield from zip(*(batch.column(c).to_pylist() for c in ("cell", "id", "root")),
                           [flat[a:b].copy() for a, b in zip(ends[:-1], ends[1:], strict=True)],
                           strict=True)

    for cell, run in groupby(rows(), key=lambda r: r[0]):
        _, ids, roots, arrays = zip(*run, strict=True)
        yield cell, ids, np.unique(np.array(roots, np.int64), return_inverse=True)[1], arrays


def _verified(similarity: float):
    """Links of a run of equal cells that the whole sets confirm, as a forest over its roots.

    Rows (cell, id, root, whole) arrive sorted by cell; ids of one root are connected
    already. Every pair of different roots is judged until something connects them.
    """

    def links(ids: tuple, group: np.ndarray, sets: tuple) -> Iterator[tuple[int, int]]:
        size = np.array([len(x) for x in sets])
        place = np.arange(len(ids))
        for i, one in enumerate(sets):
            for j in np.flatnonzero((group != group[i]) & (place > i)).tolist():
                low, high = sorted((size[i], size[j]))
                if group[i] == group[j] or low < similarity * high - 1e-9:
                    continue
                both = len(np.intersect1d(one, sets[j], assume_unique=True))
                if both >= similarity * (low + high - both) - 1e-9:
                    yield ids[j], ids[i]
                    group[group == group[j]] = group[i]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, ids, group, sets in _runs(batches, "whole"):
            found = list(links(ids, group, sets))
            if found:
                yield pa.RecordBatch.from_pydict({
                    "a": pa.array([a for a, _ in found], pa.int64()),
                    "b": pa.array([b for _, b in found], pa.int64()),
                })

    return judge


def _likely(keep: int, floor: float):
    """The rows (cell, id, root) of a run of equal cells that sketches do not rule out.

    Rows (cell, id, root, least) arrive sorted by cell. A row stays if with any row of
    another root its estimated similarity is ``floor`` or more.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, ids, group, sketches in _runs(batches, "least"):
            size = np.array([len(x) for x in sketches])
            owner, flat = np.repeat(np.arange(len(ids)), size), np.concatenate(sketches)
            wanted, ahead = np.zeros(len(ids), bool), np.ones(len(ids), bool)
            # Of two rows of different roots one at least is not of the root with most rows.
            for i in np.flatnonzero(group != np.bincount(group).argmax()).tolist():
                one = sketches[i]
                ahead[i] = False
                apart = (group != group[i]) & ahead
                if not apart.any():
                    continue
                shared = _shared(one, flat, owner, len(ids))
                apart &= shared >= floor * np.minimum(keep, np.maximum(size, len(one))) - 1e-9
                wanted |= apart
                wanted[i] |= apart.any()
            at = np.flatnonzero(wanted).tolist()
            if at:
                yield pa.RecordBatch.from_pydict({
                    "cell": pa.array([cell] * len(at), pa.int64()),
                    "id": pa.array([ids[i] for i in at], pa.int64()),
                    "root": pa.array(group[at], pa.int64()),
                })

    return judge


def _confirmed(cells: DataFrame, wholes: DataFrame, similarity: float) -> DataFrame:
    """(a, b): links within the cells (cell, id, root) by the whole sets (id, whole)."""
    dealt = cells.join(wholes, "id").select("cell", "id", "root", "whole").repartition("cell")
    return dealt.sortWithinPartitions("cell", "id").mapInArrow(
        _verified(similarity), "a long, b long"
    )


def star_cells(pairs: DataFrame, block: int = 128) -> DataFrame:
    """(cell, id, root): the pairs (a, b) as cells of one b and about ``block`` of its a.

    ``pairs`` should be a written table.
    """
    centres = materialize(
        pairs.groupBy("b").agg(F.count("*").alias("n")).withColumn("blocks", F.ceil(F.col("n") / block)),
        "centres",
    )
    own = F.pmod(F.xxhash64("a", F.lit("block")), F.col("blocks"))
    members = lookup_join(pairs.select("a", "b"), centres, "b", "n").select(
        F.xxhash64("b", own).alias("cell"), F.col("a").alias("id")
    )
    middle = centres.select(
        F.col("b").alias("id"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("own")
    ).select(F.xxhash64("id", "own").alias("cell"), "id")
    return members.unionByName(middle).withColumn("root", F.col("id"))


def open_cells(
    met: DataFrame, judged: DataFrame, block: int = 512, roots: DataFrame | None = None
) -> DataFrame:
    """(cell, id, root): the buckets of ``met`` whose ids ``judged`` does not all connect.

    ``met`` has (id, bucket, n); ``roots`` are the components of ``judged`` if known. The ids of such a bucket are dealt to blocks of about
    ``block``, and pairs of blocks meet in a cell of their own, so that every pair of two
    roots shares a cell.
    """
    roots = connected_components(judged) if roots is None else roots
    placed = materialize(
        met.join(roots.withColumnRenamed("vertex", "id"), "id", "left").select(
            "id", "bucket", "n", F.coalesce("component", "id").alias("root")
        ),
        "placed",
    )
    open_ = materialize(
        placed.groupBy("bucket").agg(
            F.min("root").alias("low"), F.max("root").alias("high"), F.max("n").alias("members")
        ).filter("low <> high").select("bucket", "members"),
        "open",
    )
    blocks = F.ceil(F.col("members") / block)
    own = F.pmod(F.xxhash64("id", F.lit("block")), blocks)
    return (
        lookup_join(placed.select("id", "bucket", "root"), open_, "bucket", "members")
        .withColumn("own", own)
        .select("id", "root", "bucket", "own", F.explode(
            F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("met"))
        .select("id", "root", F.xxhash64(
            "bucket", F.least("own", "met"), F.greatest("own", "met")).alias("cell"))
    )


def likely_cells(cells: DataFrame, sketches: DataFrame, keep: int, floor: float) -> DataFrame:
    """The rows of ``cells`` that the sketches (id, least) do not rule out."""
    dealt = cells.join(sketches, "id").select("cell", "id", "root", "least").repartition("cell")
    return dealt.sortWithinPartitions("cell", "id").mapInArrow(
        _likely(keep, floor), "cell long, id long, root long"
    )


def whole_sets(
    docs: DataFrame, wanted: DataFrame, shingle: int, number: int, keep: int
) -> DataFrame:
    """(id, whole): the shingle sets of the classes ``wanted`` (id, row_key, least).

    Sketches of fewer than ``keep`` hashes are whole; the other sets are made from the
    texts, of which only those that can have so many shingles move.
    """
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(iter([batch]), 64):
                sets = [shingle_set(t, shingle, number) for t in text_batch(part.column("text"))]
                yield pa.RecordBatch.from_pydict({
                    "id": part.column("id"), "whole": pa.array(sets, pa.list_(pa.int64())),
                })

    short = wanted.filter(F.size("least") < keep).select("id", F.col("least").alias("whole"))
    long_ = wanted.filter(F.size("least") >= keep).select("id", "row_key")
    texts = docs.select("text", "doc_id").filter(F.length("text") >= 2 * keep).select(
        "text", row_key().alias("row_key")
    )
    found = texts.join(long_, "row_key").select("id", "text").mapInArrow(
        made, "id long, whole array<long>"
    )
    return short.unionByName(found.groupBy("id").agg(F.first("whole").alias("whole")))


def estimated_similarity(one: Column, other: Column, keep: int) -> Column:
    """Jaccard similarity of shingle sets from their smallest hashes.

    Exact where both sets have fewer than ``keep`` shingles, for then both are whole.
    """
    whole = F.greatest(F.size(one), F.size(other)) < keep
    every = F.array_sort(F.array_union(one, other))
    union = F.when(whole, every).otherwise(F.slice(every, 1, keep))
    shared = F.size(F.array_intersect(F.array_intersect(one, other), union))
    return F.coalesce(F.try_divide(shared, F.size(union)), F.lit(1.0))


def row_key() -> Column:
    """32 hexadecimal digits for an id and a text; null and empty, and where one ends, differ."""
    def marked(c: Column) -> Column:
        return F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-"))

    return F.md5(F.concat(marked(F.col("doc_id").cast("string")), marked(F.col("text"))).cast("binary"))


def without_copies(
    docs: DataFrame, shingle: int = 5, similarity: float = 0.8, prints: int = 3,
    keep: int = 128, cell_limit: int = 2048, bands: int = 20, rows_each: int = 6,
    margin: float = 0.2,
) -> DataFrame:
    """``docs`` with one row of each group of near copies: that of the smallest id.

    Texts of the same words in the same order, up to ASCII case, are one from the start.
    Candidates have one of ``2 * prints`` half fingerprints within two bits of each
    other, or agree in one of ``bands`` bands of ``rows_each`` least hashes, which finds
    ``1 - (1 - s ** rows_each) ** bands`` of the pairs of similarity ``s`` (99.8% at
    0.8) where half fingerprints alone find about half. The ``keep`` smallest hashes of
    each rule out pairs estimated at ``margin`` or more under ``similarity`` (5.6
    standard deviations at 0.8); the others are near copies if their whole shingle sets
    have at least ``similarity``. First each id is compared with the likeliest of the
    lowest ids it met; then all candidate pairs that are still apart are. Groups are what
    such links connect; no candidate depends on ``cell_limit``.
    Of rows with the same id the text decides; rows that agree in both are one.
    """
    held = spread(docs.select("doc_id", row_key().alias("row_key"), "text"))
    kind = held.schema["doc_id"].dataType.simpleString()

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = text_batch(batch.column("text"))
            made = [signature(t, shingle, prints, keep, bands, rows_each) for t in texts]
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "row_key": batch.column("row_key"),
                "wording": pa.array([wording(t) for t in texts], pa.binary()),
                "prints": pa.array([p for p, _, _ in made], pa.list_(pa.int64())),
                "least": pa.array([h for _, h, _ in made], pa.list_(pa.int64())),
                "bands": pa.array([b for _, _, b in made], pa.list_(pa.int64())),
            })

    rows = materialize(
        held.mapInArrow(
            signed, f"doc_id {kind}, row_key string, wording binary, prints array<long>, "
            "least array<long>, bands array<long>"
        ),
        "signatures",
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key"))
    classes = materialize(
        rows.groupBy("wording").agg(
            first.alias("first"), *[F.first(c).alias(c) for c in ("prints", "least", "bands")]
        ).drop("wording").withColumn("id", F.monotonically_increasing_id()),
        "classes",
    )
    met = shared_bands(classes.select("id", "bands")).unionByName(
        half_cells(classes.select("id", "prints"), cell_limit)
    )
    sketches = classes.select("id", "least")
    near = estimated_similarity(F.col("one"), F.col("other"), keep)
    likely = materialize(
        met.filter("id <> b").select(F.col("id").alias("a"), "b").distinct()
        .join(sketches.select(F.col("id").alias("a"), F.col("least").alias("one")), "a")
        .join(sketches.select(F.col("id").alias("b"), F.col("least").alias("other")), "b")
        .select("a", "b", near.alias("near"))
        .filter(F.col("near") >= similarity - margin)
        .groupBy("a").agg(F.max_by("b", F.struct("near", -F.col("b"))).alias("b")),
        "likely",
    )

    def confirmed(cells: DataFrame, name: str) -> DataFrame:
        wanted = classes.join(cells.select("id").distinct(), "id", "left_semi").select(
            "id", F.col("first.row_key").alias("row_key"), "least"
        )
        wholes = whole_sets(docs, wanted, shingle, prints, keep)
        return materialize(_confirmed(cells, wholes, similarity), name)

    judged = confirmed(star_cells(likely), "judged")
    roots = connected_components(judged)
    open_ = materialize(
        likely_cells(open_cells(met, judged, roots=roots), sketches, keep, similarity - margin), "undecided"
    )
    rest = confirmed(open_, "rest")
    # The components found so far stand for the links that made them.
    groups = grouped(
        classes.select("id", F.col("first.doc_id").alias("key")),
        roots.select(F.col("vertex").alias("a"), F.col("component").alias("b")).union(rest),
    )
    kept = materialize(
        classes.select("id", "first").join(groups.select("id", "root"), "id").groupBy("root").agg(
            F.min("first").alias("first")
        ).select(F.col("first.row_key").alias("_kept_key")),
        "kept",
    )
    columns = [F.col(f"`{c}`") for c in docs.columns]
    named = docs.select(F.struct(*columns).alias("_row"), row_key().alias("_kept_key"))
    alike = Window.partitionBy("_kept_key").orderBy(F.xxhash64("_row"))
    return (
        named.withColumn("_place", F.row_number().over(alike))
        .filter(F.col("_place") == 1)
        .join(kept, "_kept_key", "left_semi")
        .select("_row.*")
    )
