"""Stored tables bucketed by their natural key, for upserts that move the payload only.

A table is written through the catalog with ``bucketBy(n, keys)`` and sorted by the
keys inside each bucket.  A join on the keys then needs no exchange above the stored
scan: Spark shuffles the payload into the same buckets, and each task merges one
bucket with its share.  The merged rows already lie in their buckets, so the next
table is written without a shuffle too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkledger.operators.upsert import next_id, upsert


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str, dealt: bool = False) -> DataFrame:
    """Save ``df`` as the catalog table ``table`` (files below ``path``); ``dealt``: its rows
    already lie by bucket, one bucket a task.  Raises where the table exists."""
    keys = list(keys)
    placed = df if dealt else df.repartition(buckets, *keys)  # one file a bucket
    placed.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").mode("error").saveAsTable(table)
    return df.sparkSession.table(table)


def merged_buckets(table: DataFrame, incoming: DataFrame, keys: Sequence[str], pk: str | None = None) -> DataFrame:
    """Next rows of a bucketed ``table`` after ``incoming`` (one row a key); see ``upsert``."""
    first = next_id(table, pk) if pk else None
    return upsert(table, incoming.where(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))), keys, pk=pk, first_id=first)
