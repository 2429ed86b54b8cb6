"""Joining a large relation to one row per key when some keys are hot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# At most this many rows, and about this many bytes, of a lookup table are broadcast.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 16 << 20


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    weight: str,
    how: str = "inner",
    copies: int = 1,
) -> DataFrame:
    """Join ``rows`` to ``table``, which has one row for each ``key``.

    ``table`` should be a written table: it is counted, then read. ``weight`` is its
    column that counts the rows of its key. A table of checked size, in rows and bytes,
    is broadcast whole. Of a larger one the heaviest keys are, up to the same size, and the rows
    they match do not move. Only rows of the other keys are shuffled; each of those
    keys holds at most 2 / BROADCAST_ROWS of all rows, so none is hot.

    Where ``rows`` may repeat keys the table does not count well, ``copies`` of the
    shuffled part of the table let each such key spread over as many partitions.
    """
    if how not in ("inner", "left"):
        raise ValueError("how is inner or left")
    fields = [c for c in table.columns if c != key]
    cut = _heavy_from(table, weight)
    if cut is None:
        joined = rows.join(F.broadcast(table), key, how)
        return joined.select(*rows.columns, *fields)

    hot = table.filter(F.col(weight) >= cut).select(key, F.struct(*fields).alias("_hot"))
    marked = rows.join(F.broadcast(hot), key, "left")
    stay = F.col("_hot").isNotNull()
    if how == "left":
        stay = stay | F.col(key).isNull()
    placed = marked.filter(stay).select(*rows.columns, *[F.col(f"_hot.{c}") for c in fields])

    moved = marked.filter(F.col("_hot").isNull() & F.col(key).isNotNull()).select(*rows.columns)
    cold = table.filter(F.col(weight) < cut)
    on = [key]
    if copies > 1:
        on = [key, "_copy"]
        spread = F.pmod(F.xxhash64(*rows.columns), F.lit(copies)).cast("int")
        moved = moved.withColumn("_copy", spread)
        cold = cold.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    met = moved.join(cold, on, how).select(*rows.columns, *fields)
    return placed.unionByName(met)


def _row_bytes(table: DataFrame) -> Column:
    """About how many bytes a row of a table takes."""
    total = F.lit(16 + 8 * len(table.columns))
    for field in table.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType | T.BinaryType):
            total = total + F.coalesce(F.octet_length(c), F.lit(0))
        elif not isinstance(field.dataType, T.AtomicType):
            held = F.to_json(F.struct(c.alias("c")))
            total = total + F.coalesce(F.octet_length(held), F.lit(0))
    return total


def _heavy_from(table: DataFrame, weight: str) -> float | None:
    """Weight from which on keys are broadcast; None when all of them can be.

    Keys are counted and measured by power of two of their weight, a few dozen rows,
    and as many of the upper powers are taken as fit in rows and bytes.
    """
    power = F.floor(F.log2(F.col(weight))).alias("power")
    sizes = table.groupBy(power).agg(
        F.count("*").alias("keys"), F.sum(_row_bytes(table)).alias("bytes")
    )
    counts = sizes.collect()
    keys, size = sum(r["keys"] for r in counts), sum(r["bytes"] for r in counts)
    if keys <= BROADCAST_ROWS and size <= BROADCAST_BYTES:
        return None
    keys, size, cut = 0, 0, float("inf")
    for row in sorted(counts, key=lambda r: -r["power"]):
        keys, size = keys + row["keys"], size + row["bytes"]
        if keys > BROADCAST_ROWS or size > BROADCAST_BYTES:
            break
        cut = 2.0 ** row["power"]
    return cut
