"""Raw reviews to clean reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starsift.operators.topk import top_k
from starsift.schema import (
    REQUIRED_COLUMNS,
    REVIEW_SCHEMA,
    SCORING_COLUMNS,
    SCORING_REQUIRED,
    require,
    with_review_id,
)

_DAY_MS = 86_400_000
# Epoch milliseconds of the years 1 to 9999, the span Spark dates cover.
_FIRST_MS, _LAST_MS = -62_135_596_800_000, 253_402_300_799_999


def standardize(df: DataFrame) -> DataFrame:
    """Standard review columns first, then whatever else the input carries.

    Required columns must exist; an absent optional one becomes a typed null.
    """
    require(df, REQUIRED_COLUMNS)
    standard = [
        F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in REVIEW_SCHEMA.fields
    ]
    extra = [F.col(c) for c in df.columns if c not in REVIEW_SCHEMA.names]
    return df.select(*standard, *extra)


def scoring_columns(df: DataFrame) -> DataFrame:
    """Columns the scorer passes on, with every further column kept."""
    require(df, SCORING_REQUIRED)
    first = [c for c in SCORING_COLUMNS if c in df.columns]
    return df.select(*first, *[c for c in df.columns if c not in first])


def filter_nonblank(df: DataFrame, strict: bool = False) -> DataFrame:
    """Keep rows whose text is more than spaces.

    Only the space character counts as blank; ``strict`` also drops texts of
    tabs and line breaks.
    """
    text = F.col("text")
    kept = text.rlike(r"\S") if strict else F.length(F.trim(text)) > 0
    return df.filter(text.isNotNull() & kept)


def filter_nonempty(df: DataFrame) -> DataFrame:
    """Keep rows whose text is neither null nor empty."""
    return df.filter(F.col("text").isNotNull() & (F.col("text") != ""))


def add_review_time(df: DataFrame) -> DataFrame:
    """``review_time`` to the second, and its UTC ``year`` and ``month``.

    Year and month come from the count of days, so they do not depend on the
    session time zone. Values no calendar date can hold give nulls.
    """
    ms = F.col("timestamp")
    ms = F.when(ms.between(_FIRST_MS, _LAST_MS), ms)
    day = F.date_from_unix_date(F.floor(ms / _DAY_MS).cast("int"))
    return df.withColumns(
        {
            "review_time": F.date_trunc("second", F.timestamp_millis(ms)),
            "year": F.year(day),
            "month": F.month(day),
        }
    )


def with_text_length(df: DataFrame) -> DataFrame:
    """Add ``text_length`` in untrimmed characters unless it is there already."""
    if "text_length" in df.columns:
        return df
    return df.withColumn("text_length", F.length("text"))


def clean_reviews(df: DataFrame, strict: bool = False) -> DataFrame:
    """The cleaning stage: project, drop blank texts, derive time and length.

    Narrow from end to end, so it runs at scan speed with no shuffle.
    """
    return with_text_length(
        add_review_time(filter_nonblank(with_review_id(standardize(df)), strict))
    )


def sample_rows(df: DataFrame, n: int = 1000, partitions: int | None = None) -> DataFrame:
    """A repeatable pseudo-random sample of ``n`` reviews for trial runs.

    The first rows by a hash of the id, spread over the cluster again so that
    scoring them is parallel.
    """
    out = with_review_id(df)
    key = F.col("review_id").cast("string")
    picked = top_k(out, [(F.md5(key), False), (key, False)], n)
    return picked.repartition(partitions or df.sparkSession.sparkContext.defaultParallelism)


def preview(df: DataFrame, n: int = 5, columns: list[str] | None = None) -> DataFrame:
    """The first ``n`` rows, of the named columns that exist (all if none do)."""
    names = [c for c in (columns or []) if c in df.columns]
    return df.select(*(names or df.columns)).limit(n)
