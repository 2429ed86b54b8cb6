"""Consecutive numbers in a global order without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starsift.sources.workspace import materialize

_LOW_BITS = (1 << 33) - 1


def numbered(df: DataFrame, order_by: Sequence[str | Column], name: str) -> DataFrame:
    """Add ``name`` = 0, 1, 2, ... in the given order.

    A range sort spreads the rows; each task numbers its own, and the only window
    runs over one row for each task to find where its numbers start.
    """
    placed = df.orderBy(*order_by).withColumns(
        {
            "_part": F.spark_partition_id(),
            "_place": F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW_BITS)),
        }
    )
    kept = materialize(placed, "numbered")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        kept.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    return (
        kept.join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_place"))
        .drop("_part", "_place", "_start")
    )
