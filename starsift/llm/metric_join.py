"""Near duplicates of embeddings by an exact metric range join.

Vectors of one label are put on the unit sphere, where a cosine of at least ``cosine``
is a distance of at most ``r = sqrt(2 - 2 * cosine)``. Pivots split each label: a
vector lives in the cell of its nearest pivot. By the triangle inequality a partner in
the cell of pivot q can be no further than r, so a vector visits the cell of q only if
``d(x, q) - d(x, p) <= 2 r`` and its distance to the plane between p and q is at most
r. It visits cells of higher pivots only, which finds each pair in one cell. Cells
then join on their own: their rows come in blocks, home blocks meet home blocks and
visiting blocks, and each pair of blocks is one unit of work, so that a cell of any
size spreads over tasks. A unit returns link counts and a spanning forest of its
links, never the pairs. The cosine itself decides, in double precision.

Equal vectors are one class with a multiplicity, so copies cost nothing. Vectors that
are null, zero or hold null or non-finite components link with nothing, and neither
do rows with a null label. Vectors of different length never link. Repeated ids are
rows of their own; a null id never names a component unless no other id is in it.
Columns other than id, vector and label are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starsift.llm.groups import forest, grouped
from starsift.operators.skew import lookup_join
from starsift.sources.workspace import materialize

_SLACK = 1e-9


def unit_vectors(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by their largest component first."""
    rows = rows / np.abs(rows).max(axis=1, initial=0, keepdims=True)
    return rows / np.sqrt(np.square(rows).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equally long lists."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _placed(r: float):
    """Home and visited cells of each class, from its vector and its label's pivots."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = batch.column("space").to_numpy(zero_copy_only=False)
            rows, cells, home = [], [], []
            for space in np.unique(groups):
                at = np.flatnonzero(groups == space)
                part = batch.take(pa.array(at))
                x = unit_vectors(_matrix(part.column("v")))
                pivots = unit_vectors(_matrix(part.column("pivots")[0].values))
                to = np.sqrt(np.maximum(0, 2 - 2 * x @ pivots.T))
                between = np.sqrt(np.maximum(0, 2 - 2 * pivots @ pivots.T))
                own = to.argmin(axis=1)
                nearest = to[np.arange(len(x)), own][:, None]
                with np.errstate(divide="ignore", invalid="ignore"):
                    plane = (to**2 - nearest**2) / (2 * between[own])
                near = (to - nearest <= 2 * r + _SLACK) & ~(plane > r + _SLACK)
                near &= np.arange(len(pivots))[None, :] > own[:, None]
                i, q = np.nonzero(near)
                rows += [at, at[i]]
                cells += [own, q]
                home += [np.ones(len(at), bool), np.zeros(len(i), bool)]
            if rows:
                rows, cells = np.concatenate(rows), np.concatenate(cells)
                moved = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_pydict({
                    "space": moved.column("space"), "cell": pa.array(cells, pa.int32()),
                    "home": pa.array(np.concatenate(home)), "id": moved.column("id"),
                    "copies": moved.column("copies"), "v": moved.column("v"),
                })

    return place


def _linked(cosine: float):
    """Link counts and forest edges of each pair of blocks."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                left, right = batch.column("left")[k].values, batch.column("right")[k].values
                same = batch.column("same")[k].as_py()
                ids = [s.field("id").to_numpy(zero_copy_only=False) for s in (left, right)]
                n = [s.field("copies").to_numpy(zero_copy_only=False) for s in (left, right)]
                x, y = (unit_vectors(_matrix(s.field("v"))) for s in (left, right))
                near = x @ y.T >= cosine
                if same:
                    # The order of rows in a block differs between its two copies.
                    near &= ids[0][:, None] < ids[1][None, :]
                a, b = np.nonzero(near)
                if not len(a):
                    continue
                both, where = np.unique(np.concatenate([ids[0][a], ids[1][b]]),
                                        return_inverse=True)
                first, second = where[: len(a)], where[len(a):]
                links = np.zeros(len(both), np.int64)
                np.add.at(links, first, n[1][b])
                np.add.at(links, second, n[0][a])
                yield pa.RecordBatch.from_pydict({
                    "id": pa.array(both, pa.int64()),
                    "links": pa.array(links, pa.int64()),
                    "root": pa.array(both[forest(first, second, len(both))], pa.int64()),
                })

    return link


def near_vectors(
    vectors: DataFrame,
    cosine: float = 0.98,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    cell_rows: int = 2048,
    max_pivots: int = 64,
    block_rows: int = 1024,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row for each row of ``vectors``.

    A label gets a pivot for each ``cell_rows`` classes, at most ``max_pivots``: the
    classes with the smallest hashes. Only speed depends on them.
    """
    r = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    x = F.col(vector)
    sound = (
        F.col(label).isNotNull() & x.isNotNull()
        & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c)
                   & (F.abs(c.cast("double")) < F.lit(float("inf"))))
        & F.exists(x, lambda c: c != 0)
    )
    rows = materialize(
        vectors.select(
            F.col(key).alias("key"),
            F.when(F.coalesce(sound, F.lit(False)),
                   F.struct(F.col(label).alias("label"), F.size(x).alias("dim"))).alias("place"),
            F.when(F.coalesce(sound, F.lit(False)), x).alias("v"),
        ).withColumn("digest", F.when(
            F.col("v").isNotNull(), F.sha2(F.to_json(F.struct("place", "v")), 256)
        )),
        "rows",
    )
    classes = materialize(
        rows.filter(F.col("v").isNotNull()).groupBy("digest").agg(
            F.min("key").alias("key"), F.count("*").alias("copies"),
            F.first("place").alias("place"), F.first("v").alias("v"),
        ).withColumn("id", F.monotonically_increasing_id())
        .withColumn("space", F.xxhash64("place")),
        "classes",
    )
    spaces = classes.groupBy("space").agg(F.count("*").alias("n"))
    wanted = F.least(F.ceil(F.col("n") / cell_rows), F.lit(max_pivots)).cast("int")
    few = classes.groupBy("space").agg(F.min_by("v", "digest").alias("_one")).select(
        "space", F.array("_one").alias("_one")
    )
    picked = _smallest(classes, max_pivots)
    pivots = materialize(
        spaces.join(picked, "space", "left").join(few, "space").select(
            "space", "n",
            F.when(wanted > 1, F.slice("_many", F.lit(1), wanted)).otherwise(F.col("_one"))
            .alias("pivots"),
        ),
        "pivots",
    )
    laid = lookup_join(classes.select("space", "id", "copies", "v"), pivots, "space", "n")
    kind = classes.schema["v"].dataType.simpleString()
    members = materialize(
        laid.drop("n").mapInArrow(
            _placed(r), f"space long, cell int, home boolean, id long, copies long, v {kind}"
        ),
        "members",
    )
    blocks, sizes = _blocks(members, block_rows)
    joined = _block_pairs(blocks, sizes)
    links = materialize(
        joined.mapInArrow(_linked(cosine), "id long, links long, root long"), "links"
    )
    counts = links.groupBy("id").agg(F.sum("links").alias("links"))
    groups = grouped(
        classes,
        links.filter("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b")),
    )
    own = (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    named = materialize(
        classes.select("id", "digest", "copies").join(counts, "id", "left")
        .join(groups, "id")
        .select("digest", "component_id", "copies", own),
        "named",
    )
    out = lookup_join(rows.select("key", "digest"), named, "digest", "copies", how="left")
    return out.select(
        F.col("key").alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("digest").isNull(), F.col("key")).otherwise(F.col("component_id"))
        .cast("long").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _smallest(classes: DataFrame, k: int) -> DataFrame:
    """(space, _many): up to k vectors of a space with the smallest digests.

    Ranks are taken within slices of a space first, so that no task sorts a large one.
    """
    part = F.pmod(F.xxhash64("digest"), F.lit(64))
    first = Window.partitionBy("space", part).orderBy("digest")
    second = Window.partitionBy("space").orderBy("digest")
    kept = classes.select("space", "digest", "v", F.row_number().over(first).alias("_n"))
    kept = kept.filter(F.col("_n") <= k).withColumn("_n", F.row_number().over(second))
    return kept.filter(F.col("_n") <= k).groupBy("space").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_n", "v"))), lambda s: s["v"])
        .alias("_many")
    )


def _blocks(members: DataFrame, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """Blocks of about ``block_rows`` members, and how many blocks each cell has."""
    parts = F.ceil(F.col("n") / block_rows).cast("int")
    sizes = materialize(
        members.groupBy("space", "cell").agg(
            F.count_if("home").alias("n_home"), F.count_if(~F.col("home")).alias("n_away"),
            F.count("*").alias("n"),
        ).select(
            F.xxhash64("space", "cell").alias("cell_id"), "n",
            F.ceil(F.col("n_home") / block_rows).cast("int").alias("homes"),
            F.ceil(F.col("n_away") / block_rows).cast("int").alias("aways"),
        ),
        "sizes",
    )
    member = F.struct("id", "copies", "v").alias("member")
    placed = lookup_join(
        members.select(F.xxhash64("space", "cell").alias("cell_id"), "home", member),
        sizes, "cell_id", "n",
    )
    parts = F.when(F.col("home"), F.col("homes")).otherwise(F.col("aways"))
    number = F.pmod(F.xxhash64("member.id"), parts.cast("long")).cast("int")
    blocks = materialize(
        placed.withColumn("number", number).groupBy("cell_id", "home", "number").agg(
            F.collect_list("member").alias("members"),
            F.first("homes").alias("homes"), F.first("aways").alias("aways"),
        ),
        "cells",
    )
    return blocks, sizes


def _block_pairs(blocks: DataFrame, sizes: DataFrame) -> DataFrame:
    """Each home block with itself, with later home blocks and with visiting blocks."""
    low = F.sequence(F.lit(0), F.col("number"))
    firsts = blocks.filter("home").select(
        "cell_id", F.col("number").alias("i"), F.col("members").alias("left"),
        F.explode(F.concat(
            F.transform(F.sequence(F.col("number"), F.col("homes") - 1),
                        lambda j: F.struct(F.lit(True).alias("home"), j.alias("j"))),
            F.when(F.col("aways") > 0, F.transform(
                F.sequence(F.lit(0), F.col("aways") - 1),
                lambda j: F.struct(F.lit(False).alias("home"), j.alias("j")),
            )).otherwise(F.array().cast("array<struct<home:boolean,j:int>>")),
        )).alias("to"),
    ).select("cell_id", "i", "left", "to.home", "to.j")
    home_side = blocks.filter("home").withColumn("i", F.explode(low))
    away_side = blocks.filter(~F.col("home") & (F.col("homes") > 0)).withColumn(
        "i", F.explode(F.sequence(F.lit(0), F.col("homes") - 1))
    )
    seconds = home_side.unionByName(away_side).select(
        "cell_id", "i", "home", F.col("number").alias("j"), F.col("members").alias("right")
    )
    return firsts.join(seconds, ["cell_id", "i", "home", "j"]).select(
        "left", "right", (F.col("home") & (F.col("i") == F.col("j"))).alias("same")
    )
