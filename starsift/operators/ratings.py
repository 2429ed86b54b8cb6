"""How well scores follow the star ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starsift.functions.grades import mae_grade
from starsift.schema import require

NEEDED = ("rating", "sentiment_star")
REPORT_COLUMNS = ("rating", "avg_sentiment_star", "avg_abs_diff", "count")


def _error():
    return F.abs(F.col("rating") - F.col("sentiment_star"))


def _measures():
    return [
        F.avg("sentiment_star").alias("avg_sentiment_star"),
        F.avg(_error()).alias("avg_abs_diff"),
        F.count("*").alias("count"),
        F.count(_error()).alias("scored_count"),
    ]


def global_mae(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The mean absolute error between rating and sentiment star, one row (per ``by``)."""
    require(df, ("rating", "sentiment_star"))
    return df.groupBy(*by).agg(F.avg(_error()).alias("mae"))


def rating_summary(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Per rating: average star, average error, reviews, reviews with an error.

    Reviews without a rating form a group of their own.
    """
    require(df, NEEDED)
    return df.groupBy(*by, "rating").agg(*_measures()).orderBy(*by, "rating")


def rating_report(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Per-rating rows and the total (of each ``by``) in one pass.

    ``level`` tells the total from the group of reviews without a rating.
    """
    require(df, NEEDED)
    level = F.when(F.grouping("rating") == 1, "total").otherwise("rating")
    keys = [F.col(c) for c in by]
    sets = [[*keys, F.col("rating")], keys]
    grouped = df.groupingSets(sets, *keys, F.col("rating"))
    return grouped.agg(level.alias("level"), *_measures()).orderBy(*by, "level", "rating")


def weighted_mae(summary: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Mean error from a rating summary (per ``by``), weighted two ways; 0 without rows.

    ``avg_mae`` weights by all reviews, as the overview shows it.
    ``exact_mae`` weights by reviews that have an error and so equals the
    global figure also when ratings or scores are missing.
    """

    def mean(weight):
        weighted = F.sum(F.col("avg_abs_diff") * F.col(weight))
        return F.coalesce(F.try_divide(weighted, F.sum(weight)), F.lit(0.0))

    return summary.groupBy(*by).agg(
        mean("count").alias("avg_mae"),
        mean("scored_count").alias("exact_mae"),
    )


def rating_distribution(summary: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Reviews, share of all (of a ``by``) and error of each rating, from a rating summary.

    The window runs over the summary, one row for each step of the rating scale.
    """
    total = F.sum("count").over(Window.partitionBy(*by))
    return summary.select(
        *by,
        "rating",
        "count",
        F.try_divide(F.col("count"), total).alias("share"),
        F.col("avg_abs_diff").alias("mae"),
        mae_grade(F.col("avg_abs_diff")).alias("grade"),
    ).orderBy(*by, "rating")


def overview(
    scored: DataFrame, topics: DataFrame, threshold: float = 3.0, by: tuple[str, ...] = ()
) -> DataFrame:
    """One row of headline figures (per ``by``), from one pass over the scored reviews.

    Mismatches are counted in full. ``topics`` is a topic table, with the columns of
    ``by`` if given, whose outlier row does not count. ``avg_mae`` is the mean error
    weighted by reviews per rating.
    """
    summary = scored.groupBy(*by, "rating").agg(
        *_measures(), F.count_if(_error() >= threshold).alias("mismatched")
    )
    weighted = F.sum(F.col("avg_abs_diff") * F.col("count"))
    figures = summary.groupBy(*by).agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total_ratings"),
        F.coalesce(F.sum("mismatched"), F.lit(0)).alias("mismatched_count"),
        F.coalesce(F.try_divide(weighted, F.sum("count")), F.lit(0.0)).alias("avg_mae"),
    )
    shown = topics.filter("Topic <> -1")
    if not by:
        topic_count = shown.agg(F.count("*").alias("n")).scalar()
    else:
        counted = shown.groupBy(*[F.col(c).alias(f"_{c}") for c in by]).agg(
            F.count("*").alias("_topics")
        )
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
        figures = figures.join(counted, same, "left")
        topic_count = F.coalesce("_topics", F.lit(0))
    return figures.select(
        *by, "total_ratings", "mismatched_count", topic_count.alias("topic_count"), "avg_mae"
    )
