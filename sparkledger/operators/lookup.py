"""Key translation: natural keys to surrogate ids, key subsets, scalar lookups.

No join carries a hint: the planner, and AQE from measured bytes at runtime,
turn a small side into a broadcast or split skewed partitions.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkledger.operators.ranking import keep_first

def map_values(
    df: DataFrame,
    col: str,
    mapping: DataFrame,
    key: str,
    value: str,
    out: str | None = None,
    value_type: str = "bigint",
) -> DataFrame:
    """Replace ``col`` by ``mapping[key] -> value``; unmapped values become null.

    A left join on the key (never by row position), so a missing key cannot
    shift ids onto the wrong rows.
    """
    out = out or col
    m = mapping.select(F.col(key).alias("_map_key"), F.col(value).cast(value_type).alias("_map_val"))
    joined = df.join(m, df[col] == F.col("_map_key"), "left").drop("_map_key")
    if out == col:
        return joined.withColumn(col, F.col("_map_val")).drop("_map_val")
    return joined.withColumnRenamed("_map_val", out)


def reattach_key(updates: DataFrame, stored: DataFrame, keys: Iterable[str] | str, pk: str = "id") -> DataFrame:
    """Add the stored primary key to update rows (left join on the natural key)."""
    k = [keys] if isinstance(keys, str) else list(keys)
    return updates.join(stored.select(*k, pk), on=k, how="left")


def to_period_id(
    df: DataFrame,
    periods: DataFrame,
    keys: Sequence[str] = ("asset_id", "fiscal_year", "period"),
    id_col: str = "id",
    out: str = "reporting_period_id",
) -> DataFrame:
    """Translate a composite natural key to the period id; unmatched rows vanish."""
    k = list(keys)
    m = periods.select(*k, F.col(id_col).alias(out))
    return df.join(m, on=k, how="inner").drop(*k)


def asset_map(
    assets: DataFrame,
    cats: DataFrame,
    flag: str | None = "has_financials",
    cat: str = "Equity",
    symbols: DataFrame | Sequence[str] | None = None,
) -> DataFrame:
    """``(symbol, id)`` of assets in category ``cat`` with ``flag`` set.

    One row per symbol; for duplicated symbols the highest id wins (explicit
    instead of arbitrary).  With ``symbols`` the map is restricted to them and
    any unknown symbol raises.
    """
    c = cats.filter(F.col("cat") == cat).select(F.col("id").alias("_cat_id"))
    a = assets if flag is None else assets.filter(F.col(flag))
    m = a.join(c, a["asset_cat_id"] == F.col("_cat_id"), "inner").select("symbol", "id")
    m = keep_first(m, ["symbol"], [("id", "desc")])
    if symbols is not None:
        m = key_subset(m, symbols, "symbol")
    return m


def key_subset(df: DataFrame, keys: DataFrame | Sequence[str], col: str) -> DataFrame:
    """Keep rows whose ``col`` is listed; raise ``ValueError`` on unknown keys.

    The list is a DataFrame (it may be long), joined rather than inlined.
    """
    if not isinstance(keys, DataFrame):
        spark = df.sparkSession
        keys = spark.createDataFrame([(k,) for k in keys], T.StructType([T.StructField(col, T.StringType())]))
    wanted = keys.select(F.col(keys.columns[0]).alias(col)).distinct()
    unknown = wanted.join(df.select(col), on=col, how="left_anti").limit(21).collect()
    if unknown:
        shown = ", ".join(str(r[0]) for r in unknown[:20])
        raise ValueError(f"unknown {col} value(s): {shown}{' ...' if len(unknown) > 20 else ''}")
    return df.join(wanted, on=col, how="left_semi")


def lookup_scalar(df: DataFrame, col: str) -> object:
    """First value of ``col``; raises when the lookup finds nothing."""
    rows = df.select(col).limit(1).collect()
    if not rows:
        raise LookupError(f"lookup of {col!r} returned no rows")
    return rows[0][0]


def symbols_frame(spark: SparkSession, symbols: Sequence[str], col: str = "symbol") -> DataFrame:
    return spark.createDataFrame([(s,) for s in symbols], T.StructType([T.StructField(col, T.StringType())]))
