"""Exact top-k search by inner product, dimension block by dimension block.

Vectors of whole numbers are packed into vertical blocks: a few thousand rows, one
array for each run of dimensions. A task holds a block of queries with their best
rows so far and meets candidate blocks one after the other. It adds up the products
of one run of dimensions at a time; what the remaining dimensions can still add is at
most the product of the remaining lengths (Cauchy-Schwarz), so candidates that cannot
reach any query's k-th score are dropped and the survivors compacted before the next
run. Dropping is exact: the result is that of brute force.

Blocks are numbered, and a unit of work is a stripe of candidate blocks with a group of
query blocks; units are dealt to tasks by number. What a unit returns is k rows for each
of its queries.

Null vectors and those with null or non-finite components take no part. Vectors are
compared with those of as many components only; empty ones score 0 with each other.
Scores must fit a long. Rows that repeat an id are rows of their own; only the query
row itself is left out of its result. A null id comes after all others in ties.
Columns other than the id and the vector are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starsift.operators.numbering import numbered
from starsift.operators.skew import lookup_join
from starsift.sources.workspace import materialize

_BLOCK = "block long, dim int, n int, rows binary, ids binary, wide int, data binary"
_FOUND = "query_row long, query_id long, vec_id long, score long"
# Sums of products below this are exact in double precision.
_EXACT = float(2**53)
# Stands for a null id; real ids never reach it in practice.
_NO_ID = np.iinfo(np.int64).max


def quantised(vectors: DataFrame, key: str, vector: str, scale: int = 64) -> DataFrame:
    """(row, id, v): floor(scale * x) of each component, as longs, rows that take part."""
    x = F.col(vector)
    sound = x.isNotNull() & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf")))
    )
    return vectors.filter(sound).select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).cast("long").alias("id"),
        F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long")).alias("v"),
    )


def _packed(block_rows: int):
    """Packs (row, id, v) into blocks of rows of one length, dimensions first."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def block(dim: int, parts: list) -> pa.RecordBatch:
            rows = np.concatenate([p[0] for p in parts])
            ids = np.concatenate([p[1] for p in parts])
            data = np.concatenate([p[2] for p in parts])
            least, most = (int(data.min()), int(data.max())) if data.size else (0, 0)
            kind = next(
                t for t in (np.int8, np.int16, np.int32, np.int64)
                if np.iinfo(t).min <= least and most <= np.iinfo(t).max
            )
            return pa.RecordBatch.from_pydict({
                "block": pa.array([int(rows[0])], pa.int64()),
                "dim": pa.array([dim], pa.int32()),
                "n": pa.array([len(rows)], pa.int32()),
                "rows": pa.array([rows.tobytes()], pa.binary()),
                "ids": pa.array([ids.tobytes()], pa.binary()),
                "wide": pa.array([np.dtype(kind).itemsize], pa.int32()),
                "data": pa.array([np.ascontiguousarray(data.T.astype(kind)).tobytes()],
                                 pa.binary()),
            })

        for batch in batches:
            rows = batch.column("row").to_numpy(zero_copy_only=False)
            ids = batch.column("id").fill_null(_NO_ID).to_numpy(zero_copy_only=False)
            vectors = batch.column("v")
            dims = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.cumsum(dims)])
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                data = flat[starts[at][:, None] + np.arange(dim)[None, :]]
                parts = held.setdefault(int(dim), [])
                for low in range(0, len(at), block_rows):
                    part = slice(low, low + block_rows)
                    parts.append((rows[at[part]], ids[at[part]], data[part]))
                    if sum(len(p[0]) for p in parts) >= block_rows:
                        yield block(int(dim), parts)
                        parts.clear()
        for dim, parts in held.items():
            if parts:
                yield block(dim, parts)

    return pack


def _unpacked(n: int, dim: int, wide: int, data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.dtype(f"<i{wide}")).reshape(dim, n)


class _Best:
    """The best k rows of each query of one block, over the candidates seen so far."""

    def __init__(self, rows, ids, data, k: int, step: int):
        self.rows, self.ids, self.k, self.step = rows, ids, k, step
        self.data = data
        self.real = data.astype(np.float64)
        self.exact = True
        self.rest = _remaining(self.real, step)
        n = len(rows)
        self.score = np.full((n, k), np.iinfo(np.int64).min, np.int64)
        self.found = np.full((n, k), -1, np.int64)
        self.id = np.full((n, k), _NO_ID, np.int64)

    def meet(self, rows, ids, data) -> None:
        """Take a candidate block in."""
        real = data.astype(np.float64)
        rest = _remaining(real, self.step)
        largest = float(self.rest[0].max(initial=0)) * float(rest[0].max(initial=0))
        if largest >= _EXACT:
            self._merge(self.data.T.astype(object) @ data.astype(object), rows, ids)
            return
        dim, n = real.shape
        full = (self.found >= 0).all(axis=1)
        # A score equal to the k-th still counts, for ties go to the smaller id.
        floor = np.where(full, self.score[:, -1].astype(np.float64), -np.inf)
        kept = np.arange(n)
        sums = np.zeros((len(self.rows), n))
        for step, low in enumerate(range(0, dim, self.step)):
            run = slice(low, low + self.step)
            sums += self.real[run].T @ real[run][:, kept]
            if low + self.step >= dim:
                break
            bound = sums + self.rest[step + 1][:, None] * rest[step + 1][None, kept]
            alive = (bound + np.abs(bound) * 1e-12 + 1e-6 >= floor[:, None]).any(axis=0)
            if alive.mean() < 0.8:
                kept, sums = kept[alive], sums[:, alive]
            if not len(kept):
                return
        if len(kept):
            hit = (sums >= floor[:, None]).any(axis=0)
            kept, sums = kept[hit], sums[:, hit]
        if len(kept):
            self._merge(np.rint(sums).astype(np.int64), rows[kept], ids[kept])

    def _merge(self, scores, rows, ids) -> None:
        k = self.k
        scores = np.asarray(scores).astype(np.int64)
        for i in range(len(self.rows)):
            mine = scores[i]
            good = np.flatnonzero((mine >= self.score[i, -1]) & (rows != self.rows[i]))
            if not len(good):
                continue
            if len(good) > 4 * k:
                cut = np.partition(mine[good], len(good) - k)[len(good) - k]
                good = good[mine[good] >= cut]
            own = self.found[i] >= 0
            score = np.concatenate([self.score[i][own], mine[good]])
            found = np.concatenate([self.found[i][own], rows[good]])
            name = np.concatenate([self.id[i][own], ids[good]])
            order = np.lexsort((found, name, -score))[:k]
            m = len(order)
            self.score[i, :m], self.found[i, :m], self.id[i, :m] = (
                score[order], found[order], name[order]
            )

    def table(self) -> pa.RecordBatch:
        real = self.found >= 0
        n = real.sum(axis=1)
        ids = self.id[real]
        return pa.RecordBatch.from_pydict({
            "query_row": pa.array(np.repeat(self.rows, n), pa.int64()),
            "query_id": pa.array(np.repeat(self.ids, n), pa.int64()),
            "vec_id": pa.array(ids, pa.int64(), mask=ids == _NO_ID),
            "score": pa.array(self.score[real], pa.int64()),
        })


def _remaining(real: np.ndarray, step: int) -> np.ndarray:
    """Lengths of what is left of each vector before each run of dimensions."""
    runs = [np.square(real[low:low + step]).sum(axis=0) for low in range(0, len(real), step)]
    if not runs:
        return np.zeros((1, real.shape[1]))
    return np.sqrt(np.cumsum(np.array(runs)[::-1], axis=0)[::-1])


def _searched(k: int, step: int):
    """The best k of the query blocks of a cell over its candidate blocks.

    Rows arrive sorted by cell, query blocks first; candidate blocks pass one by one.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                if r["cell"] != cell:
                    yield from (best.table() for best in held)
                    cell, held = r["cell"], []
                block = (
                    np.frombuffer(r["rows"], np.int64), np.frombuffer(r["ids"], np.int64),
                    _unpacked(r["n"], r["dim"], r["wide"], r["data"]),
                )
                if r["candidate"]:
                    for best in held:
                        best.meet(*block)
                else:
                    held.append(_Best(*block, k, step))
        yield from (best.table() for best in held)

    return search


def _dealt(rows: DataFrame, name: str) -> DataFrame:
    """Blocks with a number ``no`` of their own, without gaps, in order of their length."""
    numbers = materialize(
        numbered(rows.select("block", "dim"), ["dim", "block"], "no").withColumn("one", F.lit(1)),
        name,
    )
    return lookup_join(rows, numbers.drop("dim"), "block", "one").drop("one")


def top_k_search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 64,
    query_rows: int = 128,
    block_rows: int = 1024,
    stripe_blocks: int = 16,
    step: int = 16,
    query_blocks: int = 32,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each query row.

    ``is_query`` is a condition on the column ``id``. Ties go to the smaller id; ranks
    start from 1; fewer rows come back if there are fewer. A unit of work is a stripe of at
    most ``stripe_blocks`` candidate blocks with ``query_blocks`` query blocks, so a block
    is sent once for each of its units, not for each block that it meets.
    """
    rows = materialize(quantised(vectors, key, vector, scale), "vectors")
    blocks = _dealt(materialize(rows.mapInArrow(_packed(block_rows), _BLOCK), "blocks"), "numbers")
    asked = _dealt(materialize(
        rows.filter(is_query).mapInArrow(_packed(query_rows), _BLOCK), "queries"
    ), "numbers")
    cores = rows.sparkSession.sparkContext.defaultParallelism
    # One row for each length of the vectors.
    many = blocks.groupBy("dim").agg(F.count("*").alias("n"), F.min("no").alias("first")).join(
        asked.groupBy("dim").agg(F.count("*").alias("queries"), F.min("no").alias("first_query")),
        "dim",
    ).orderBy("dim").collect()
    plan, cells = [], 0
    for r in many:
        groups = -(-r["queries"] // query_blocks)
        stripes = min(r["n"], max(-(-r["n"] // stripe_blocks), 3 * cores))
        plan.append((r["dim"], r["first"], r["first_query"], stripes, groups, cells))
        cells += stripes * groups
    if not cells:
        return rows.sparkSession.createDataFrame(
            [], "query_id long, rank int, vec_id long, score long"
        )
    units = F.broadcast(rows.sparkSession.createDataFrame(
        plan, "dim int, first long, first_query long, stripes int, groups int, base long"
    ))

    def parts(df: DataFrame, candidate: bool, number: Column) -> DataFrame:
        return df.join(units, "dim").withColumn("at", number).select(
            (F.col("base") + F.col("at")).alias("cell"), F.lit(candidate).alias("candidate"),
            "block", "dim", "n", "rows", "ids", "wide", "data",
        )

    stripe = (F.col("no") - F.col("first")) % F.col("stripes")
    group = F.floor((F.col("no") - F.col("first_query")) / query_blocks)
    work = parts(blocks, True, F.explode(F.transform(
        F.sequence(F.lit(0), F.col("groups") - 1), lambda g: stripe * F.col("groups") + g
    ))).unionByName(parts(asked, False, F.explode(F.transform(
        F.sequence(F.lit(0), F.col("stripes") - 1), lambda i: i * F.col("groups") + group
    ))))
    tasks = min(cells, max(3 * cores, 20_000))
    found = (
        work.repartitionById(tasks, (F.col("cell") % tasks).cast("int"))
        .sortWithinPartitions("cell", "candidate", "block")
        .mapInArrow(_searched(k, step), _FOUND)
    )
    order = Window.partitionBy("query_row").orderBy(
        F.desc("score"), F.asc_nulls_last("vec_id")
    )
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
