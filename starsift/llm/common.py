"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: a word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: str | Column) -> Column:
    """Words of a text as a long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def remainder(key: str | Column, by: int = 5) -> Column:
    """crc32 of a key written as text, modulo ``by``; null for a null key."""
    key = F.col(key) if isinstance(key, str) else key
    return F.crc32(key.cast("string").cast("binary")) % by


def held_out(key: str | Column, fold: int) -> Column:
    """Whether a row belongs to the fold left out of training; null keys train."""
    return F.coalesce(remainder(key) == fold, F.lit(False))


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, for work that makes much of each row.

    After each given batch, memory that Arrow keeps for later goes back to the system.
    """
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
        pa.default_memory_pool().release_unused()


def by_bytes(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of a text column, one row at least.

    After each given batch, memory that Arrow keeps for later goes back to the system.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(
            zero_copy_only=False
        )
        part = np.cumsum(sizes, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for low, high in pairwise(cuts):
            yield batch.slice(low, high - low)
        pa.default_memory_pool().release_unused()


def text_batch(column) -> list[str]:
    """An Arrow column of texts as a list, null as the empty text."""
    return [t if t is not None else "" for t in column.to_pylist()]
