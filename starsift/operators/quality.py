"""Profiles of the stages: rows, bytes, gaps and what each stage kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starsift.functions.stats import percent


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """One row: data files under ``path`` and their size, contents unread."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    )
    return files.agg(
        F.count("*").alias("files"),
        F.round(F.coalesce(F.sum("length"), F.lit(0)) / (1024.0 * 1024.0), 2).alias("size_mb"),
    )


def stage_profile(spark: SparkSession, stages: dict[str, str]) -> DataFrame:
    """Rows, files, megabytes and scan partitions of each Parquet stage.

    ``stages`` maps a stage name to its path. The row count comes from the file
    footers; partitions are those a scan has, empty ones too. Session facts stand
    beside every stage.
    """
    context = spark.sparkContext
    out = None
    for name, path in stages.items():
        scan = spark.read.parquet(path)
        sizes = file_sizes(spark, path)
        one = scan.agg(F.count("*").alias("count")).withColumn(
            "partitions", F.lit(scan.rdd.getNumPartitions()).cast("long")
        ).select(
            F.lit(name).alias("stage"),
            "count",
            "partitions",
            sizes.select("files").scalar().alias("files"),
            sizes.select("size_mb").scalar().alias("size_mb"),
            F.lit(context.appName).alias("app_name"),
            F.lit(context.version).alias("spark_version"),
            F.lit(context.defaultParallelism).alias("default_parallelism"),
        )
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no stage given")
    return out


def inspect(df: DataFrame) -> DataFrame:
    """One row for each column: position, name, type, rows and nulls, in one pass."""
    columns = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.count("*").alias("rows"),
            F.count_if(F.col(f"`{f.name}`").isNull()).alias("nulls"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return df.agg(F.array(*columns).alias("c")).select(F.inline("c"))


def completeness(
    df: DataFrame, columns: Sequence[str] = ("text", "rating"), by: tuple[str, ...] = ()
) -> DataFrame:
    """Nulls of the quality columns present, and the share of filled cells."""
    present = [c for c in columns if c in df.columns]
    if not present:
        raise ValueError(f"none of {list(columns)} in the input")
    nulls = [F.count_if(F.col(c).isNull()) for c in present]
    total = nulls[0]
    for n in nulls[1:]:
        total = total + n
    cells = F.count("*") * len(present)
    return df.groupBy(*by).agg(
        F.count("*").alias("rows"),
        *[n.alias(f"null_{c}") for n, c in zip(nulls, present, strict=True)],
        F.round((1 - F.try_divide(total, cells)) * 100, 2).alias("completeness"),
    )


def stage_counts(stages: dict[str, DataFrame], by: tuple[str, ...] = ()) -> DataFrame:
    """The row count of each stage as ``<name>_count``, one row (per ``by``)."""
    names = list(stages)
    if by:
        marked = [
            stages[n].groupBy(*by).agg(F.count("*").alias("n")).select(
                *by, *[(F.col("n") if m == n else F.lit(0).cast("long")).alias(f"{m}_count")
                       for m in names]
            )
            for n in names
        ]
        union = marked[0]
        for part in marked[1:]:
            union = union.unionByName(part)
        return union.groupBy(*by).agg(*[F.sum(f"{n}_count").alias(f"{n}_count") for n in names])
    first = stages[names[0]].agg(F.count("*").alias(f"{names[0]}_count"))
    rest = [stages[n].agg(F.count("*").alias("n")).scalar().alias(f"{n}_count") for n in names[1:]]
    return first.select("*", *rest)


def retention(counts: DataFrame) -> DataFrame:
    """What cleaning and scoring kept of the raw rows, in percent."""
    raw, cleaned = F.col("raw_count"), F.col("cleaned_count")
    out = {
        "retention_rate": percent(cleaned, raw),
        "data_reduction": percent(raw - cleaned, raw),
    }
    if "sentiment_count" in counts.columns:
        out["sentiment_retention"] = percent(F.col("sentiment_count"), raw)
    return counts.withColumns(out)
