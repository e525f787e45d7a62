"""Date arithmetic on columns and on the run's ``as_of`` instant."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def plus_interval(col: str | Column, interval: str) -> Column:
    """``col + INTERVAL <interval>`` (e.g. ``"2 weeks"``)."""
    c = F.col(col) if isinstance(col, str) else col
    return c + F.expr(f"INTERVAL {interval}")


def days_before(as_of: dt.date | dt.datetime, days: int) -> dt.date:
    """Start of a look-back window, as a date literal."""
    day = as_of.date() if isinstance(as_of, dt.datetime) else as_of
    return day - dt.timedelta(days=days)


def year_range(as_of: dt.date | dt.datetime, num_years: int) -> tuple[int, int]:
    """``(first, last)`` calendar years of a window that includes ``as_of``'s year."""
    return as_of.year - num_years + 1, as_of.year
