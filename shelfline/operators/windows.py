"""Trailing-period and latest-period filters.

The anchor (MAX of the period column) is either an uncorrelated scalar
subquery — evaluated once per query inside the plan — or, when the caller
already knows it (the model records it once per table), a literal date.  A
literal is pushed into the parquet scan, so files and row groups of a
week-ordered fact outside the window are skipped.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.functions.columns import col_


def period_max(df: DataFrame, col: str) -> Column:
    """Scalar subquery ``(SELECT MAX(col) FROM df)``."""
    return df.select(F.max(col)).scalar()


def trailing_cutoff(df: DataFrame, col: str, weeks: int) -> Column:
    """``MAX(col) - INTERVAL weeks WEEKS`` as a date."""
    return F.date_sub(period_max(df, col), 7 * weeks)


Anchor = DataFrame | dt.date | None


def trailing_weeks(df: DataFrame, col: str, weeks: int, anchor: Anchor = None) -> DataFrame:
    """Rows with ``col >= MAX(col) - weeks`` (inclusive: 13 weeks keeps 14
    weekly dates).  ``anchor``: None (MAX over ``df``), a DataFrame (MAX of
    ``col`` over it), or the known MAX as a date."""
    if isinstance(anchor, dt.date):
        cutoff = F.lit(anchor - dt.timedelta(days=7 * weeks))
    else:
        cutoff = trailing_cutoff(anchor if anchor is not None else df, col, weeks)
    return df.filter(col_(col) >= cutoff)


def latest_period(df: DataFrame, col: str, anchor: dt.date | None = None) -> DataFrame:
    """Rows of the most recent period, ``col = MAX(col)`` (``anchor`` is
    the known MAX, if any)."""
    value = F.lit(anchor) if isinstance(anchor, dt.date) else period_max(df, col)
    return df.filter(col_(col) == value)
