"""Sentiment distributions by product, brand or category."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STARS = (1, 2, 3, 4, 5)


def _measures():
    star = F.col("sentiment_star")
    return [
        F.count("*").alias("review_count"),
        F.avg("sentiment_star").alias("avg_sentiment"),
        F.avg("rating").alias("avg_rating"),
        *[F.count_if(star == n).alias(f"star_{n}") for n in STARS],
    ]


def product_sentiment(
    df: DataFrame, min_reviews: int = 1, by: tuple[str, ...] = ()
) -> DataFrame:
    """Per product: reviews, averages and the count of every sentiment star."""
    return (
        df.filter(F.col("asin").isNotNull())
        .groupBy(*by, "asin")
        .agg(*_measures())
        .filter(F.col("review_count") >= min_reviews)
    )


def group_sentiment(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same figures over each of ``keys``, all keys in a single pass.

    One grouping set per key; ``key`` names it and ``value`` holds its value.
    """
    sets = [[F.col(k)] for k in keys]
    names = [F.when(F.grouping(k) == 0, F.lit(k)) for k in keys]
    values = [F.when(F.grouping(k) == 0, F.col(k).cast("string")) for k in keys]
    return (
        df.groupingSets(sets, *[F.col(k) for k in keys])
        .agg(F.coalesce(*names).alias("key"), F.coalesce(*values).alias("value"), *_measures())
        .drop(*keys)
    )
