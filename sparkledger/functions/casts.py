"""Strict and lenient casts, as JVM-side expressions.

Lenient casts turn unparseable text into null instead of failing the job
(``try_cast``); strict casts are plain ``cast`` under ANSI mode and raise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def lenient_long(col: str | Column) -> Column:
    """Text to bigint; ``2024.7``, ``1e3``, blanks and junk become null."""
    return _c(col).try_cast("bigint")


def lenient_double(col: str | Column) -> Column:
    return _c(col).try_cast("double")


def lenient_date(col: str | Column) -> Column:
    """Text to date; a trailing time part is ignored, junk becomes null."""
    return _c(col).try_cast("date")


def lenient_utc_timestamp(col: str | Column) -> Column:
    """Text to a UTC timestamp (session zone is UTC); date-only text is midnight."""
    return F.try_to_timestamp(_c(col))


def strip_chars(col: str | Column, chars: str) -> Column:
    """Remove any of ``chars`` from both ends (``M12`` -> ``12``)."""
    return F.btrim(_c(col), F.lit(chars))


def ref_date_text(year: str | Column, month: str | Column, day: int) -> Column:
    """``"{year}-{month}-{day}"`` with no zero padding; null in, null out."""
    return F.concat(_c(year).cast("string"), F.lit("-"), _c(month).cast("string"), F.lit(f"-{day}"))
