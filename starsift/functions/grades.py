"""Bands, grades and display forms of review figures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _written(value: Column) -> Column:
    """The double a reader gets from the number as written: 0.7 for the float 0.7."""
    return value.cast("string").cast("double")


def conf_badge(conf: Column) -> Column:
    """low under 0.4, medium under 0.7, else high."""
    conf = _written(conf)
    return F.when(conf < 0.4, "low").when(conf < 0.7, "medium").when(conf.isNotNull(), "high")


def conf_band(conf: Column) -> Column:
    """Four bands 0-0.4, 0.4-0.6, 0.6-0.8, 0.8-1; the last one includes 1."""
    conf = _written(conf)
    return (
        F.when(conf < 0.4, "0.0-0.4")
        .when(conf < 0.6, "0.4-0.6")
        .when(conf < 0.8, "0.6-0.8")
        .when(conf.isNotNull(), "0.8-1.0")
    )


def mae_grade(mae: Column) -> Column:
    """Word for a mean absolute error on the five-star scale."""
    return (
        F.when(mae < 0.5, "excellent")
        .when(mae < 1.0, "good")
        .when(mae < 2.0, "moderate")
        .when(mae < 3.0, "significant")
        .when(mae.isNotNull(), "severe")
    )


def shown_number(value: Column) -> Column:
    """A number as a page shows it: whole numbers without a fraction."""
    number = value.cast("double")
    whole = F.floor(number)
    return F.when(number == whole, whole.cast("string")).otherwise(number.cast("string"))


def shown_fixed(value: Column, places: int = 1) -> Column:
    """A number with a fixed count of decimals."""
    return F.format_string(f"%.{places}f", value.cast("double"))
