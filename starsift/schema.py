"""Relations of the review model and the checks every operator shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

REVIEW_SCHEMA = T.StructType(
    [
        T.StructField("rating", T.DoubleType()),
        T.StructField("title", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("asin", T.StringType()),
        T.StructField("parent_asin", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("verified_purchase", T.BooleanType()),
        T.StructField("helpful_vote", T.IntegerType()),
    ]
)
REQUIRED_COLUMNS = ("rating", "text", "user_id", "timestamp", "asin")

SCORING_COLUMNS = (
    "asin",
    "review_time",
    "rating",
    "text",
    "year",
    "month",
    "user_id",
    "verified_purchase",
)
SCORING_REQUIRED = ("rating", "text", "user_id", "asin", "year")

SCORE_SCHEMA = T.StructType(
    [
        T.StructField("sentiment_star", T.IntegerType()),
        T.StructField("sentiment_conf", T.FloatType()),
    ]
)


class MissingColumns(ValueError):
    """An input lacks columns an operator cannot work without."""


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Return ``df`` unchanged, or raise when one of ``columns`` is absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumns(f"missing columns {missing}; the input has {df.columns}")
    return df


def with_review_id(df: DataFrame) -> DataFrame:
    """Give rows without ``review_id`` one derived from their content.

    Content hashing survives recomputation after a lost executor, which a
    counter over partitions does not. Rows that share an id are equal in every
    hashed column, so an order broken by it stays the same from run to run.
    """
    if "review_id" in df.columns:
        return df
    hashed = [f.name for f in df.schema.fields if isinstance(f.dataType, T.AtomicType)]
    return df.withColumn("review_id", F.xxhash64(*[F.col(c) for c in hashed]))
