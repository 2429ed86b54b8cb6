"""Aggregates over landing batches, merged from partial states.

The state of a batch is two narrow tables of counts: reviews by (user, year, rating,
score), and distinct (user, product) pairs. Counts add up and pairs unite, so any order
of batches gives the same figures as one pass over all reviews. A batch that lands again
replaces its own state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starsift.schema import require

_COUNTS = "user_id STRING, year INT, rating DOUBLE, sentiment_star INT, n BIGINT"
_PAIRS = "user_id STRING, asin STRING"


def add_batch(df: DataFrame, path: str, batch: int) -> None:
    """Write the state of the reviews of one batch under ``path``.

    A crash between the two tables is mended by landing the batch again.
    """
    require(df, ("user_id", "year", "rating", "sentiment_star", "asin"))
    keyed = df.select(
        F.col("user_id").cast("string"),
        F.col("year").cast("int"),
        F.col("rating").cast("double"),
        F.col("sentiment_star").cast("int"),
        F.col("asin").cast("string"),
    )
    counts = keyed.groupBy("user_id", "year", "rating", "sentiment_star").agg(F.count("*").alias("n"))
    pairs = keyed.select("user_id", "asin").filter(F.col("asin").isNotNull()).distinct()
    counts.write.mode("overwrite").parquet(f"{path}/counts/batch={int(batch)}")
    pairs.write.mode("overwrite").parquet(f"{path}/pairs/batch={int(batch)}")


def _state(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, batch INT").parquet(f"{path}/{name}").drop("batch")


def _sums() -> dict[str, Column]:
    n, rating, star = F.col("n"), F.col("rating"), F.col("sentiment_star")
    return {
        "_rated": F.when(rating.isNotNull(), n),
        "_rating": n * rating,
        "_square": n * rating * rating,
        "_scored": F.when(star.isNotNull(), n),
        "_star": n * star,
    }


def merged_user_stats(spark: SparkSession, path: str) -> DataFrame:
    """What ``user_stats`` gives over all reviews of all batches.

    Sums of ratings and of their squares are exact for ratings in halves or quarters of a
    star. Counts and pairs meet in one aggregate, with no join; a hot user's pairs are
    spread by product before they are counted.
    """
    sums = _sums()
    counts = _state(spark, path, "counts", _COUNTS).withColumns(sums)
    pairs = _state(spark, path, "pairs", _PAIRS).groupBy("user_id", "asin").agg(F.lit(1).alias("_product"))
    rows = counts.select("user_id", "n", *sums).unionByName(
        pairs.select("user_id", "_product"), allowMissingColumns=True
    )
    total = rows.groupBy("user_id").agg(
        *[F.sum(c).alias(c) for c in ("n", *sums, "_product")]
    )
    rated = F.col("_rated")
    spread = (F.col("_square") - F.col("_rating") * F.col("_rating") / rated) / (rated - 1)
    return total.select(
        "user_id",
        F.col("n").alias("review_count"),
        F.try_divide("_rating", rated).alias("avg_rating"),
        F.when(rated > 1, F.sqrt(F.greatest(spread, F.lit(0.0)))).alias("rating_stddev"),
        F.try_divide("_star", "_scored").alias("avg_sentiment"),
        F.coalesce("_product", F.lit(0)).cast("bigint").alias("product_count"),
    )


def merged_yearly_trend(spark: SparkSession, path: str) -> DataFrame:
    """What ``yearly_trend`` gives over all reviews of all batches."""
    sums = _sums()
    total = (
        _state(spark, path, "counts", _COUNTS)
        .withColumns(sums)
        .groupBy("year")
        .agg(*[F.sum(c).alias(c) for c in ("n", "_rated", "_rating", "_scored", "_star")])
    )
    return total.select(
        "year",
        F.try_divide("_star", "_scored").alias("avg_sentiment"),
        F.try_divide("_rating", "_rated").alias("avg_rating"),
        F.col("n").alias("review_count"),
    ).orderBy("year")
