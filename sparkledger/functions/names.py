"""Column-name conversion (camelCase payload names to snake_case)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

# Only a lower-case letter followed by an upper-case one is split, so runs of
# capitals stay together: ``epsTTM`` -> ``eps_ttm``, ``year1High`` -> ``year1high``.
_LOWER_UPPER = re.compile(r"([a-z])([A-Z])")


def snake_case(name: str) -> str:
    return _LOWER_UPPER.sub(r"\1_\2", name).lower()


def snake_columns(df: DataFrame) -> DataFrame:
    """Rename every top-level column to snake_case.

    Spark happily carries duplicate column names, which would make later
    projections ambiguous, so two names that collapse to one raise here.
    """
    mapping = {c: snake_case(c) for c in df.columns}
    seen: dict[str, str] = {}
    for src, dst in mapping.items():
        if dst in seen:
            raise ValueError(f"columns {seen[dst]!r} and {src!r} both become {dst!r}")
        seen[dst] = src
    renames = {s: d for s, d in mapping.items() if s != d}
    return df.withColumnsRenamed(renames) if renames else df
