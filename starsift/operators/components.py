"""Connected components of an edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from starsift.operators.skew import BROADCAST_ROWS, lookup_join
from starsift.sources.workspace import discard, materialize


def _lowest(edges: DataFrame) -> DataFrame:
    """Per vertex ``a``: its lowest neighbour (or itself) and its edge count."""
    return edges.groupBy("a").agg(
        F.least(F.min("b"), F.first("a")).alias("low"), F.count("*").alias("n")
    )


def _hung(
    edges: DataFrame, lowest: DataFrame, small: bool, written: list[DataFrame]
) -> DataFrame:
    """Edges from the far end of each edge to the lowest vertex of its near end."""
    if small:
        joined = edges.join(F.broadcast(lowest), "a")
    else:
        table = materialize(lowest, "lowest")
        written.append(table)
        joined = lookup_join(edges, table, "a", "n")
    return joined.select(F.col("b").alias("a"), F.col("low").alias("b"))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(vertex, component) for the vertices of an edge list (a, b) of longs.

    A component is named by its lowest vertex; a vertex tied to no other one is
    absent. Rounds alternate between hanging larger neighbours under the lowest
    vertex in reach and pulling smaller ones together, after the two-phase star
    contraction of Kiveris et al. (2014); their number grows with the logarithm of
    the graph, not its diameter. Each round ends in a table on shared storage, so
    lineage stays short, and hub vertices are split by :func:`lookup_join`.
    """
    current, mark = _marked(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    for _ in range(max_rounds):
        # Each edge has two ends, so this bounds the rows of every table of vertices.
        small = 2 * mark[0] <= BROADCAST_ROWS
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        written = [current]
        large = _hung(both.filter("b > a"), _lowest(both), small, written).distinct()
        if not small:
            large = materialize(large, "edges")
            written.append(large)
        lowest = _lowest(large)
        pulled = _hung(large, lowest, small, written).filter("a <> b")
        kept = lowest.select("a", F.col("low").alias("b"))
        current, now = _marked(pulled.union(kept).distinct())
        for table in written:
            discard(table)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components still changing after {max_rounds} rounds")
    members = current.select(F.col("a").alias("vertex"), F.col("b").alias("component"))
    roots = current.select(F.col("b").alias("vertex"), F.col("b").alias("component"))
    return members.union(roots.distinct())


def _marked(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """Edges as a table, with their count and two order-free digests, taken as it is written.

    The digests tell when a round changed nothing.
    """
    mixed, seen = F.xxhash64("a", "b"), Observation()
    table = materialize(
        edges.observe(
            seen,
            F.count(F.lit(1)).alias("edges"),
            F.bit_xor(mixed).alias("xor"),
            F.sum(mixed % 1_000_003).alias("sum"),
        ),
        "edges",
    )
    return table, tuple(seen.get[name] for name in ("edges", "xor", "sum"))
