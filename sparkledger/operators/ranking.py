"""Ordering operators: n-th latest, top-k and keep-one per key, row indexes.

Orders are given as ``(column, direction)`` pairs, direction one of ``asc``,
``desc``, ``asc_nulls_first``, ``asc_nulls_last``, ``desc_nulls_first``,
``desc_nulls_last`` (``asc`` puts nulls first, ``desc`` last, as in Spark).

Skew: top-k / keep-one use ``row_number() <= k``, which Spark plans as a
``WindowGroupLimit`` applied *before* the shuffle as well as after it, so a
hot key ships at most ``k`` rows per map task.  A full per-key sequence
(``sequence_within``) cannot be cut like that; it range-partitions on
``(key, order)`` so a hot key is spread over many tasks, numbers rows per
task and adds per-task offsets from a table of at most two rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkledger.session import staged

Order = Sequence[tuple[str, str]]

_REVERSED = {
    "asc": "desc",
    "desc": "asc",
    "asc_nulls_first": "desc_nulls_last",
    "asc_nulls_last": "desc_nulls_first",
    "desc_nulls_first": "asc_nulls_last",
    "desc_nulls_last": "asc_nulls_first",
}


def sort_cols(order: Order) -> list[Column]:
    return [getattr(F.col(c), d)() for c, d in order]


def reverse(order: Order) -> list[tuple[str, str]]:
    return [(c, _REVERSED[d]) for c, d in order]


def _keys(keys: Sequence[str] | str) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def top_k_per_key(df: DataFrame, keys: Sequence[str] | str, order: Order, k: int, rank_col: str | None = None) -> DataFrame:
    """At most ``k`` rows per key, first in ``order``; ``order`` must end unique."""
    w = Window.partitionBy(*_keys(keys)).orderBy(*sort_cols(order))
    name = rank_col or "_rank"
    out = df.withColumn(name, F.row_number().over(w).cast("bigint")).filter(F.col(name) <= k)
    return out if rank_col else out.drop(name)


def keep_first(df: DataFrame, keys: Sequence[str] | str, order: Order) -> DataFrame:
    """One row per key: the first in ``order``.  Null keys form one group."""
    return top_k_per_key(df, keys, order, 1)


def keep_last(df: DataFrame, keys: Sequence[str] | str, order: Order) -> DataFrame:
    """One row per key: the last when rows are sorted by ``order``."""
    return top_k_per_key(df, keys, reverse(order), 1)


def nth_latest(
    df: DataFrame,
    key: str,
    order: Order,
    n: int,
    value: str,
    out: str = "nth_value",
) -> DataFrame:
    """Per key, ``value`` of the n-th row in ``order`` plus the key's row count
    capped at ``n`` (``_have``).  The caller substitutes a default where
    ``_have < n``.  Only ``n`` rows per key leave each map task.
    """
    top = top_k_per_key(df, key, order, n, rank_col="_rank")
    return top.groupBy(key).agg(
        F.first(F.when(F.col("_rank") == n, F.col(value)), ignorenulls=True).alias(out),
        F.count(F.lit(1)).alias("_have"),
    )


def _range_placed(df: DataFrame, order_cols: list[Column], parts: int | None) -> DataFrame:
    """Range-partition and sort; tag each row with its task and position.

    Without ``parts`` the number of tasks is left to the session
    (``spark.sql.shuffle.partitions``, coalesced by AQE where tasks are small).
    """
    placed = df.repartitionByRange(*([parts] if parts else []), *order_cols).sortWithinPartitions(*order_cols)
    placed = placed.withColumn("_sl_part", F.spark_partition_id()).withColumn("_sl_pos", F.monotonically_increasing_id())
    # Both passes below must see the same placement, also after a lost
    # executor re-runs tasks: materialise it in the shared folder.
    return staged(placed)


def with_row_index(df: DataFrame, order: Order, name: str = "row_idx", start: int = 0, parts: int | None = None) -> DataFrame:
    """Global dense index in ``order`` (unique order required), from ``start``.

    The rows are range-partitioned, numbered per task and shifted by the row
    counts of the preceding tasks (a table with one row per task).
    """
    placed = _range_placed(df, sort_cols(order), parts)
    counts = placed.groupBy("_sl_part").agg(F.count(F.lit(1)).alias("_sl_n"))
    before = Window.orderBy("_sl_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_sl_part", F.coalesce(F.sum("_sl_n").over(before), F.lit(0)).alias("_sl_off"))
    local = F.col("_sl_pos") - F.shiftleft(F.col("_sl_part").cast("bigint"), 33)
    return (
        placed.join(F.broadcast(offsets), "_sl_part", "left")
        .withColumn(name, (F.col("_sl_off") + local + F.lit(start)).cast("bigint"))
        .drop("_sl_part", "_sl_pos", "_sl_off")
    )


def sequence_in_small_groups(df: DataFrame, keys: Sequence[str] | str, order: Order, name: str = "seq") -> DataFrame:
    """1-based ``row_number()`` per key by a plain window, for callers whose
    groups are bounded by construction (e.g. after ``top_k_per_key``)."""
    w = Window.partitionBy(*_keys(keys)).orderBy(*sort_cols(order))
    return df.withColumn(name, F.row_number().over(w).cast("bigint"))


def sequence_within(df: DataFrame, keys: Sequence[str] | str, order: Order, name: str = "seq", parts: int | None = None) -> DataFrame:
    """1-based ``row_number()`` per key in ``order`` that stays balanced when one
    key holds a large share of the rows.

    1. range-partition on ``(keys, order)``: sampling splits a hot key over
       many tasks; rows are sorted inside each task;
    2. number rows per (task, key) -- groups are bounded by a task's share;
    3. a key continues from an earlier task only as that task's first key, so
       offsets form a table of at most two rows per task; it is broadcast.
    """
    k = _keys(keys)
    order_cols = [F.col(c).asc_nulls_first() for c in k] + sort_cols(order)
    placed = _range_placed(df, order_cols, parts)
    local = placed.withColumn(
        "_sl_local",
        F.row_number().over(Window.partitionBy("_sl_part", *k).orderBy("_sl_pos")).cast("bigint"),
    )
    counts = placed.groupBy("_sl_part", *k).agg(F.count(F.lit(1)).alias("_sl_n"))
    per_key = Window.partitionBy(*k)
    before = per_key.orderBy("_sl_part").rowsBetween(Window.unboundedPreceding, -1)
    # Keys spread over several tasks; each task holds at most two of them (its
    # first and last key), so this table has at most 2 x tasks rows.
    offsets = counts.select(
        F.col("_sl_part").alias("_o_part"),
        *[F.col(c).alias(f"_o_{c}") for c in k],
        F.coalesce(F.sum("_sl_n").over(before), F.lit(0)).alias("_sl_off"),
        F.count(F.lit(1)).over(per_key).alias("_sl_tasks"),
    ).filter(F.col("_sl_tasks") > 1).drop("_sl_tasks")
    cond = local["_sl_part"] == offsets["_o_part"]
    for c in k:
        cond = cond & local[c].eqNullSafe(offsets[f"_o_{c}"])
    return (
        local.join(F.broadcast(offsets), cond, "left")
        .withColumn(name, F.col("_sl_local") + F.coalesce(F.col("_sl_off"), F.lit(0)))
        .drop("_sl_part", "_sl_pos", "_sl_local", "_sl_off", "_o_part", *[f"_o_{c}" for c in k])
    )
