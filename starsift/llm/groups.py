"""Groups of linked classes, named by the smallest key among their members."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.operators.components import connected_components
from starsift.operators.skew import lookup_join
from starsift.sources.workspace import materialize


def forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The lowest of ``n`` nodes that each one reaches over the links (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        for ends in (root[a], root[b], a, b):
            np.minimum.at(new, ends, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def grouped(classes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, root, component_id) for the classes (id, key) and edges (a, b) of their ids.

    ``root`` is the smallest id in reach, ``component_id`` the smallest key, null keys
    aside. ``classes`` should be a written table with one row for each id.
    """
    roots = connected_components(edges)
    known = materialize(
        classes.select("id", "key")
        .join(roots.select(F.col("vertex").alias("id"), "component"), "id", "left")
        .select("id", "key", F.coalesce("component", "id").alias("root")),
        "known",
    )
    lowest = materialize(
        known.groupBy("root").agg(
            F.min("key").alias("component_id"), F.count("*").alias("classes")
        ),
        "lowest",
    )
    return lookup_join(known, lowest, "root", "classes").select("id", "root", "component_id")
