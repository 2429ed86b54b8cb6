"""Reviews whose stars and words disagree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.functions.grades import shown_fixed, shown_number
from starsift.operators.topk import top_k
from starsift.schema import require, with_review_id

NEEDED = ("rating", "text", "sentiment_star", "sentiment_conf")
THRESHOLD = 3.0
REPORT_COLUMNS = ("rating", "sentiment_star", "sentiment_conf", "diff", "abs_diff", "text")

# The sentences shown beside a mismatched review.
OVER_RATED = (
    "User gave %d stars but the text expresses %s sentiment (%.1f stars). "
    "This mismatch indicates potential fake review or rating error."
)
UNDER_RATED = (
    "User gave %d stars but the text expresses %s sentiment (%.1f stars). "
    "Rating may not reflect actual product sentiment."
)
ALIGNED = "Rating and sentiment are aligned, but this review was flagged for further analysis."


def with_diff(df: DataFrame) -> DataFrame:
    """``diff`` = sentiment star minus rating, and its size ``abs_diff``."""
    diff = F.col("sentiment_star") - F.col("rating")
    return df.withColumns({"diff": diff, "abs_diff": F.abs(diff)})


def mismatched(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Reviews whose difference reaches ``threshold``; an unknown one never does."""
    return with_diff(require(df, NEEDED)).filter(F.col("abs_diff") >= threshold)


def top_mismatches(
    df: DataFrame, k: int = 5000, threshold: float = THRESHOLD, by: tuple[str, ...] = ()
) -> DataFrame:
    """The ``k`` strongest mismatches (per ``by`` if given), surest score first, then by id."""
    found = with_review_id(mismatched(df, threshold))
    order = [("abs_diff", True), ("sentiment_conf", True), ("review_id", False)]
    return top_k(found, order, k, by)


def top_examples(df: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` mismatches of greatest size to show in full, texts of mere space left out."""
    size = F.coalesce(F.abs("abs_diff"), F.abs("diff"), F.lit(0.0))
    shown = with_review_id(df).filter(F.col("text").rlike(r"[^\s\p{Z}]"))
    return top_k(shown, [(size, True), ("review_id", False)], k)


def explain_mismatch(df: DataFrame) -> DataFrame:
    """Add ``direction``, ``polarity`` and the sentence that explains a mismatch.

    Over-rated reviews call a score under 2.5 negative and under 3.5 neutral;
    under-rated ones call it positive above 3.5 and neutral above 2.5. The two
    differ at the limits themselves.
    """
    stars = F.coalesce(F.col("rating").cast("int"), F.lit(0))
    score = F.coalesce(F.col("sentiment_star").cast("double"), F.lit(0.0))
    direction = (
        F.when(stars > score, "over-rated").when(stars < score, "under-rated").otherwise("aligned")
    )
    over = F.when(score < 2.5, "negative").when(score < 3.5, "neutral").otherwise("positive")
    under = F.when(score > 3.5, "positive").when(score > 2.5, "neutral").otherwise("negative")
    polarity = F.when(stars > score, over).when(stars < score, under)
    sentence = (
        F.when(stars > score, F.format_string(OVER_RATED, stars, over, score))
        .when(stars < score, F.format_string(UNDER_RATED, stars, under, score))
        .otherwise(ALIGNED)
    )
    return df.withColumns({"direction": direction, "polarity": polarity, "explanation": sentence})


def search_reviews(df: DataFrame, term: str) -> DataFrame:
    """Rows whose text, rating, star or difference, as shown, contains ``term``.

    Case and outer spacing of the term do not matter; an empty term keeps all.
    """
    needle = term.lower().strip()
    if not needle:
        return df
    diff = F.coalesce(F.nullif(F.col("diff"), F.lit(0.0)), F.col("abs_diff"), F.lit(0.0))
    text = F.lower(F.coalesce(F.nullif(F.col("text"), F.lit("")), F.lit("N/A")))
    shown = [
        text,
        F.coalesce(shown_number(F.col("rating")), F.lit("")),
        F.coalesce(shown_number(F.col("sentiment_star")), F.lit("")),
        shown_fixed(diff),
    ]
    hit = F.lit(False)
    for field in shown:
        hit = hit | field.contains(needle)
    return df.filter(hit)


SORTABLE = ("rating", "sentiment_star", "sentiment_conf", "diff")


def sort_reviews(df: DataFrame, column: str, descending: bool = False) -> DataFrame:
    """Order reviews by one numeric column; differences by size, non-numbers as 0."""
    if column not in SORTABLE:
        raise ValueError(f"sort by one of {SORTABLE}, not {column!r}")
    key = F.coalesce(F.col(column).try_cast("double"), F.lit(0.0))
    if column == "diff":
        key = F.abs(key)
    return with_review_id(df).orderBy(key.desc() if descending else key.asc(), "review_id")


def mismatch_histogram(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Count of reviews by size of difference, smallest first."""
    return df.groupBy(*by, F.abs("diff").alias("size")).agg(F.count("*").alias("count")).orderBy(
        *by, "size"
    )
