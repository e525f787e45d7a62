"""Column-level helpers: name conversion, strict and lenient casts, dates."""

from sparkledger.functions.casts import (
    lenient_date,
    lenient_double,
    lenient_long,
    lenient_utc_timestamp,
    ref_date_text,
    strip_chars,
)
from sparkledger.functions.dates import days_before, plus_interval, year_range
from sparkledger.functions.names import snake_case, snake_columns

__all__ = [
    "days_before",
    "lenient_date",
    "lenient_double",
    "lenient_long",
    "lenient_utc_timestamp",
    "plus_interval",
    "ref_date_text",
    "snake_case",
    "snake_columns",
    "strip_chars",
    "year_range",
]
