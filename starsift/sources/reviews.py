"""Reading review records and landing new ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starsift.schema import REVIEW_SCHEMA

CORRUPT = "_corrupt_record"


def read_reviews(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Read one stage: a Parquet directory, a single file or several of them."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.parquet(*paths)


def category_of(path):
    """Category named by a file path.

    ``.../Gift_Cards.jsonl[.gz]`` names it in the file, ``.../Gift_Cards_reviews/x``
    in the folder.
    """
    parts = F.split(path, "/")
    stem = F.regexp_extract(F.element_at(parts, -1), r"^(.+?)(?:_reviews)?\.jsonl(?:\.gz)?$", 1)
    folder = F.regexp_replace(F.element_at(parts, -2), "_reviews$", "")
    return F.when(stem != "", stem).otherwise(folder)


def ingest_jsonl(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType = REVIEW_SCHEMA,
) -> DataFrame:
    """Land JSON-lines reviews with a declared schema, so no pass infers one.

    A line that is not JSON, or whose value does not fit its type, keeps its raw
    text in ``_corrupt_record`` instead of failing the job or vanishing.
    """
    landed = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    lines = (
        spark.read.schema(landed)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(paths if isinstance(paths, str) else list(paths))
    )
    if "category" in lines.columns:  # folders named category=...
        return lines
    return lines.withColumn("category", category_of(F.col("_metadata.file_path")))
