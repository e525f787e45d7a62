"""Diffing a payload against a stored table on a natural key.

Both operators are one join each.  Spark plans a sort-merge (or, when AQE
measures a small side at runtime, broadcast) join; skewed key partitions are
split by AQE's skew-join handling, which supports left semi and anti joins.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from sparkledger.operators.shape import apply_schema


def _keys(keys: Iterable[str] | str) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def new_rows(stored: DataFrame, incoming: DataFrame, keys: Iterable[str] | str) -> DataFrame:
    """Payload rows whose key is absent from the stored table (to insert).

    The payload is cast to the stored types first.  Null keys never match, so
    they come out as new; pipelines route them to rejects beforehand.
    """
    k = _keys(keys)
    typed = apply_schema(incoming, stored)
    return typed.join(stored.select(*k), on=k, how="left_anti")


def updated_rows(stored: DataFrame, incoming: DataFrame, keys: Iterable[str] | str) -> DataFrame:
    """Payload rows whose key exists in the stored table (to update).

    No value comparison: unchanged rows are returned too; duplicates in the
    payload are kept (a semi join never multiplies rows).
    """
    k = _keys(keys)
    typed = apply_schema(incoming, stored)
    return typed.join(stored.select(*k), on=k, how="left_semi")
