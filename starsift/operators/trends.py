"""Sentiment over time and beside an economic indicator."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starsift.functions.stats import guarded_corr


def _measures():
    return [
        F.avg("sentiment_star").alias("avg_sentiment"),
        F.avg("rating").alias("avg_rating"),
        F.count("*").alias("review_count"),
    ]


def yearly_trend(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Average score, average rating and reviews of each year.

    Reviews without a date form a group of their own.
    """
    return df.groupBy(*by, "year").agg(*_measures()).orderBy(*by, "year")


def with_indicator(yearly: DataFrame, indicator: DataFrame) -> DataFrame:
    """Add ``inflation_rate`` by year, null for years the indicator lacks.

    Both sides are small aggregates; which of them is broadcast, if any, is left to
    the optimizer, who knows their sizes.
    """
    rates = indicator.select("year", F.col("rate").alias("inflation_rate"))
    return yearly.join(rates, "year", "left")


def chart_years(yearly: DataFrame) -> DataFrame:
    """Years fit for a time axis: neither unknown nor 0."""
    return yearly.filter(F.col("year").isNotNull() & (F.col("year") != 0))


def macro_corr(
    yearly: DataFrame,
    indicator: DataFrame,
    min_years: int = 3,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Correlation of yearly sentiment and rating with the indicator.

    Years with any missing figure do not count; fewer than ``min_years`` left, or
    a constant series, give nulls.
    """
    joined = with_indicator(yearly, indicator).dropna(
        "any", subset=["year", "avg_sentiment", "avg_rating", "review_count", "inflation_rate"]
    )
    return joined.groupBy(*by).agg(
        F.count("*").alias("years"),
        guarded_corr("avg_sentiment", "inflation_rate", min_years).alias("corr_sentiment"),
        guarded_corr("avg_rating", "inflation_rate", min_years).alias("corr_rating"),
    )


def lagged_corr(
    yearly: DataFrame,
    indicator: DataFrame,
    lags: Sequence[int] = (0, 1, 2),
    min_years: int = 3,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Correlation of this year's reviews with the indicator ``lag`` years before.

    The indicator is copied once for each lag, and the yearly table is read once.
    """
    shifts = F.explode(F.array(*[F.lit(int(n)) for n in lags]))
    shifted = indicator.select("year", F.col("rate").alias("inflation_rate"), shifts.alias("lag"))
    shifted = shifted.withColumn("year", F.col("year") + F.col("lag"))
    joined = yearly.join(shifted, "year").dropna(
        "any", subset=["avg_sentiment", "avg_rating", "inflation_rate"]
    )
    return joined.groupBy(*by, "lag").agg(
        F.count("*").alias("years"),
        guarded_corr("avg_sentiment", "inflation_rate", min_years).alias("corr_sentiment"),
        guarded_corr("avg_rating", "inflation_rate", min_years).alias("corr_rating"),
    )


def monthly_trend(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Monthly averages with the change against the calendar month before.

    The change is null where that month has no reviews; reviews without a date are a
    row of their own, without a change. The window runs over the aggregate, one row
    for each calendar month of a group, never over reviews.
    """
    monthly = df.groupBy(*by, "year", "month").agg(*_measures())
    spec = Window.partitionBy(*by).orderBy("year", "month")
    month = F.col("year") * 12 + F.col("month")
    follows = F.lag(month).over(spec) == month - 1

    def change(column: str):
        return F.when(follows, F.col(column) - F.lag(column).over(spec))

    return monthly.withColumns(
        {"sentiment_change": change("avg_sentiment"), "rating_change": change("avg_rating")}
    )
