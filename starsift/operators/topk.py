"""The first rows of a large relation in a global order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Tasks are dealt to this many groups, about the root of the tasks of a large scan,
# so that no step merges the candidates of more than a thousand tasks or groups.
GROUPS = 1024

# A column and whether it goes from high to low; such a column is a number.
Order = tuple[str | Column, bool]


def order_key(order_by: Sequence[Order]) -> Column:
    """One sortable value for an order; nulls first where it rises, last where it falls."""
    parts = []
    for place, (column, falls) in enumerate(order_by):
        c = F.col(column) if isinstance(column, str) else column
        parts.append((c.isNull() if falls else c.isNotNull()).alias(f"n{place}"))
        parts.append((F.negative(c) if falls else c).alias(f"v{place}"))
    return F.struct(*parts)


def top_k(
    df: DataFrame, order_by: Sequence[Order], k: int, by: Sequence[str] = ()
) -> DataFrame:
    """The first ``k`` rows by ``order_by``, which should break all ties; per ``by`` if given.

    The k-th place is found on the order columns alone: groups of tasks are cut to
    ``k`` keys each, then one task merges the groups. Whole rows come from a second
    reading that keeps those up to that place, so no other row or column moves.
    """
    names = [f"_by{i}" for i in range(len(by))]
    keys = df.select(
        *[F.col(c).alias(n) for c, n in zip(by, names, strict=True)],
        order_key(order_by).alias("_key"),
        F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("_group"),
    )
    first = F.row_number().over(Window.partitionBy(*names, "_group").orderBy("_key"))
    cut = keys.withColumn("_place", first).filter(F.col("_place") <= k).drop("_place", "_group")
    marked = df.withColumn("_key", order_key(order_by))
    if not by:
        last = cut.orderBy("_key").limit(k).agg(F.max("_key").alias("_key")).scalar()
        return marked.filter(F.col("_key") <= last).orderBy("_key").limit(k).drop("_key")
    place = F.row_number().over(Window.partitionBy(*names).orderBy("_key"))
    ends = cut.withColumn("_place", place).filter(F.col("_place") <= k).groupBy(*names).agg(
        F.max("_key").alias("_last")
    )
    same = [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(by, names, strict=True)]
    near = marked.join(ends, same).filter(F.col("_key") <= F.col("_last"))
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("_key"))
    return near.withColumn("_place", rank).filter(F.col("_place") <= k).drop(
        "_place", "_key", "_last", *names
    )
