"""Bursts of reviews that do not stop at a calendar edge.

Each user's time is cut into periods, and the reviews of the last ``reach`` of a period
go to the next one as well. A period is then judged alone, so a user with a third of all
reviews is worked on by many tasks. Equal times of a user are folded before they move.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_DAY = 86_400
_MICRO = 1_000_000


def _periods(
    df: DataFrame, user: str, time: str, by: tuple[str, ...], reach: int, period: int
) -> DataFrame:
    """(by, user_id, period, at, n, own): times in microseconds, in each period that needs them."""
    if not 0 < reach <= period:
        raise ValueError("a period must be at least as long as what reaches over its edge")
    reach, period = reach * _MICRO, period * _MICRO
    at = F.unix_micros(F.col(time).cast("timestamp"))
    folded = (
        df.filter(F.col(time).isNotNull())
        .groupBy(*by, F.col(user).alias("user_id"), at.alias("at"))
        .agg(F.count("*").alias("n"))
    )
    home = F.floor(F.col("at") / F.lit(period))
    homes = folded.withColumn("_home", home)
    reached = F.floor((F.col("at") + F.lit(reach)) / F.lit(period))
    return homes.select(
        *by, "user_id", "at", "n", "_home", F.explode(F.sequence("_home", reached)).alias("period")
    ).select(*by, "user_id", "period", "at", "n", (F.col("period") == F.col("_home")).alias("own"))


def burst_windows(
    df: DataFrame,
    seconds: int = _DAY,
    min_reviews: int = 3,
    user: str = "user_id",
    time: str = "review_time",
    by: tuple[str, ...] = (),
    period: int = 30 * _DAY,
) -> DataFrame:
    """Users with at least ``min_reviews`` reviews within any ``seconds``, both ends included.

    Gives the fullest such window by its count and its last review (the earliest of
    equals), and how many reviews end a window that is full enough. Every review adds
    one at its time and takes one off when it leaves the window, so a running sum gives
    the count in one sorted pass however full a window is. Reviews without a time are
    in no window; a null user is a user of its own.
    """
    placed = _periods(df, user, time, by, seconds, period)
    add = F.struct(F.col("at").alias("at"), F.lit(0).alias("kind"), F.col("n").alias("change"))
    leave = F.struct(
        (F.col("at") + F.lit(seconds * _MICRO)).alias("at"), F.lit(1).alias("kind"), (-F.col("n")).alias("change")
    )
    moves = placed.select(
        *by, "user_id", "period", "n", "own", F.explode(F.array(add, leave)).alias("_m")
    ).select(*by, "user_id", "period", "n", "own", "_m.*")
    sweep = (
        Window.partitionBy(*by, "user_id", "period")
        .orderBy("at", "kind")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    ends = (
        moves.withColumn("_held", F.sum("change").over(sweep))
        .filter((F.col("kind") == 0) & F.col("own") & (F.col("_held") >= min_reviews))
    )
    fullest = F.min(F.struct((-F.col("_held")).alias("less"), F.col("at").alias("at")))
    return ends.groupBy(*by, "user_id").agg(
        F.max("_held").alias("peak_count"),
        F.timestamp_micros(fullest["at"]).alias("peak_end"),
        F.sum("n").alias("burst_ends"),
    )


def burst_sessions(
    df: DataFrame,
    gap: int = 3600,
    min_reviews: int = 3,
    user: str = "user_id",
    time: str = "review_time",
    by: tuple[str, ...] = (),
    period: int = 30 * _DAY,
) -> DataFrame:
    """Sessions of at least ``min_reviews``: runs of a user's reviews at most ``gap`` seconds apart.

    A run over the edge of periods is one session. Each period gives its runs, and the
    runs of a user, at most one for each ``gap`` and period that the data span, are
    put together. Reviews without a time are in no session.
    """
    placed = _periods(df, user, time, by, gap, period)
    within = Window.partitionBy(*by, "user_id", "period").orderBy("at")
    before = F.lag("at").over(within)
    opens = before.isNull() | (F.col("at") - before > gap * _MICRO)
    runs = (
        placed.withColumn("_opens", opens)
        .filter("own")
        .withColumn("_run", F.sum(F.col("_opens").cast("int")).over(
            within.rowsBetween(Window.unboundedPreceding, 0)
        ))
        .groupBy(*by, "user_id", "period", "_run")
        .agg(
            F.min("at").alias("first"),
            F.max("at").alias("last"),
            F.sum("n").alias("n"),
            F.bool_or("_opens").alias("opens"),
        )
    )
    order = Window.partitionBy(*by, "user_id").orderBy("first")
    session = F.sum(F.col("opens").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        runs.withColumn("_session", session)
        .groupBy(*by, "user_id", "_session")
        .agg(
            F.timestamp_micros(F.min("first")).alias("session_start"),
            F.timestamp_micros(F.max("last")).alias("session_end"),
            F.sum("n").alias("review_count"),
        )
        .filter(F.col("review_count") >= min_reviews)
        .drop("_session")
    )
