"""Stacking frames: relaxed (types widened) and diagonal (missing columns null).

Both are plan-level unions: no shuffle, partitions are simply concatenated.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)
_RANK = {T.ByteType: 0, T.ShortType: 1, T.IntegerType: 2, T.LongType: 3}


def supertype(a: T.DataType, b: T.DataType) -> T.DataType:
    """Common type of two columns being stacked.

    equal -> same; null -> the other; integers -> the wider; integer with
    fractional -> double; anything with string -> string; date with timestamp
    -> timestamp; otherwise an error (e.g. boolean with a number).
    """
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    if isinstance(a, _INTEGRAL) and isinstance(b, _INTEGRAL):
        return a if _RANK[type(a)] >= _RANK[type(b)] else b
    if isinstance(a, _INTEGRAL + _FRACTIONAL) and isinstance(b, _INTEGRAL + _FRACTIONAL):
        return T.DoubleType()
    if isinstance(a, T.StringType) or isinstance(b, T.StringType):
        return T.StringType()
    dates = (T.DateType, T.TimestampType, T.TimestampNTZType)
    if isinstance(a, dates) and isinstance(b, dates):
        return T.TimestampType() if T.TimestampType() in (a, b) else T.TimestampNTZType()
    raise TypeError(f"cannot stack {a.simpleString()} with {b.simpleString()}")


def _column_types(dfs: Sequence[DataFrame]) -> dict[str, T.DataType]:
    types: dict[str, T.DataType] = {}
    for df in dfs:
        for f in df.schema.fields:
            types[f.name] = supertype(types[f.name], f.dataType) if f.name in types else f.dataType
    return types


def _conform(df: DataFrame, types: dict[str, T.DataType], order: list[str]) -> DataFrame:
    have = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for name in order:
        if name not in have:
            cols.append(F.lit(None).cast(types[name]).alias(name))
        elif have[name] != types[name]:
            cols.append(F.col(name).cast(types[name]).alias(name))
        else:
            cols.append(F.col(name))
    return df.select(*cols)


def stack(dfs: Sequence[DataFrame], relaxed: bool = True) -> DataFrame:
    """Vertical union of frames with the same column names (any order)."""
    if not dfs:
        raise ValueError("nothing to stack")
    names = list(dfs[0].columns)
    for df in dfs[1:]:
        if set(df.columns) != set(names):
            raise ValueError(f"column sets differ: {sorted(names)} vs {sorted(df.columns)}")
    if not relaxed:
        return reduce(DataFrame.unionByName, dfs)
    types = _column_types(dfs)
    return reduce(DataFrame.union, [_conform(df, types, names) for df in dfs])


def stack_diagonal(dfs: Sequence[DataFrame]) -> DataFrame:
    """Union of all columns (first-seen order); a frame lacking one gets nulls."""
    if not dfs:
        raise ValueError("nothing to stack")
    order: list[str] = []
    for df in dfs:
        order += [c for c in df.columns if c not in order]
    types = _column_types(dfs)
    return reduce(DataFrame.union, [_conform(df, types, order) for df in dfs])
