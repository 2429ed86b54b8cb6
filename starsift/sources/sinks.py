"""Writing stages and reports."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Files that a task holds open at once, and bytes of a row group of each.
WRITERS, _GROUP_BYTES = 64, 8 << 20
# Lines of one compressed file, which no two tasks can read.
_LINES = 200_000
_SETTING = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def _side_by_side(spark: SparkSession) -> Iterator[None]:
    """Tasks write up to ``WRITERS`` partition values at once, so rows are not sorted first.

    A task with more values sorts what is left. The setting is put back after the write.
    """
    before = spark.conf.get(_SETTING)
    spark.conf.set(_SETTING, str(WRITERS))
    try:
        yield
    finally:
        spark.conf.set(_SETTING, before)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a stage, laid out by ``partition_by`` where given.

    Every task writes the values it has, side by side: no row is shuffled or sorted, so a
    hot category is written by all tasks, and there are at most as many files as tasks
    times values. Texts are most of a stage, so it is compressed by zstd.
    """
    with _side_by_side(df.sparkSession):
        writer = df.write.mode("overwrite").option("compression", "zstd")
        writer.option("parquet.block.size", _GROUP_BYTES).partitionBy(*partition_by).parquet(path)


def write_lines(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write lines of text by gzip, laid out by ``partition_by``, neither shuffled nor sorted."""
    with _side_by_side(df.sparkSession):
        writer = df.write.options(compression="gzip", maxRecordsPerFile=_LINES)
        writer = writer.option("zlib.compress.level", "BEST_SPEED")
        writer.partitionBy(*partition_by).text(path)


def write_report(
    df: DataFrame,
    path: str,
    order_by: Sequence[str | Column] = (),
    single_file: bool = False,
) -> None:
    """Overwrite a CSV report with headers, rows in the order given.

    As many files as there are tasks, each with a header, in the order of their names.
    ``single_file`` is for reports of bounded size: one file is made by an exchange
    after the work, and the rows are put in order behind it.
    """
    if single_file:
        out = df.repartition(1)
        out = out.sortWithinPartitions(*order_by) if order_by else out
    else:
        out = df.orderBy(*order_by) if order_by else df
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_topics(df: DataFrame, path: str) -> None:
    """Overwrite a topic table with its arrays kept as arrays."""
    df.write.mode("overwrite").parquet(path)


def write_topics_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Overwrite a topic table as CSV, arrays rendered as JSON text."""
    flat = [
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
        for f in df.schema.fields
    ]
    write_report(df.select(*flat), path, order_by=["Topic"], single_file=single_file)
