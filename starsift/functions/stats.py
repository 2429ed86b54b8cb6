"""Aggregate expressions with their guards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def guarded_corr(x: str, y: str, min_rows: int = 3) -> Column:
    """Pearson correlation; null for few rows or a constant series.

    ``corr`` divides by the deviations and fails on a constant series under ANSI
    rules, so the quotient is formed here. Only rows with both values count.
    """
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    px = F.when(both, F.col(x).cast("double"))
    py = F.when(both, F.col(y).cast("double"))
    spread = F.stddev_pop(px) * F.stddev_pop(py)
    return F.when(F.count(px) >= min_rows, F.try_divide(F.covar_pop(px, py), spread))


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """part / whole in percent, null for an empty whole."""
    return F.round(F.try_divide(part * 100.0, whole), places)
